"""Near duplicates by DartMinHash signatures, banded joining and exact verification.

A text is the set of its five-word shingles. Each shingle is a region of the
plane (weight, rank) in which hashed darts lie as a Poisson process; a text
sees the darts in its own regions up to a rank that leaves about
K (ln K + 2) of them, however long it is. Every dart belongs to one of K
coordinates and the earliest of each is the signature: two texts agree in a
coordinate with probability equal to their weighted Jaccard similarity.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.llm.common import small_batches, stage, tie_order, whole
from tidewatch.llm.tokens import chained, mixed, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
#: A pair at the threshold shares no band with probability (1 - 0.8^5)^25 < 5e-5.
ROWS, BANDS = 5, 25
#: Bytes of text worked on at once in a task.
BLOCK_BYTES = 4 << 20


def shingles(texts: list[bytes], width: int = SHINGLE):
    """(hashes of shingles in order, their text's number, digest of each text's words, words of each text).

    A text of fewer words than ``width`` is one shingle; one without words has none.
    """
    h, n = word_hashes(texts)
    words = n
    starts = np.cumsum(n) - n
    digests = [hashlib.md5(h[s : s + k].tobytes()).digest() for s, k in zip(starts, n, strict=True)]
    # room of width - 1 zeros behind each short text, so that all windows exist
    short = (n > 0) & (n < width)
    doc = np.repeat(np.arange(len(n)), n)
    if short.any():
        pad = np.where(short, width - n, 0)
        filled = np.zeros(len(h) + int(pad.sum()), np.uint64)
        shift = np.cumsum(pad) - pad
        filled[np.arange(len(h)) + np.repeat(shift, n)] = h
        h, n = filled, n + pad
        doc = np.repeat(np.arange(len(n)), n)
    if len(h) < width:
        return np.empty(0, np.uint64), np.empty(0, np.int64), digests, words
    windows = chained(*[h[i : len(h) - width + 1 + i] for i in range(width)])
    inside = doc[: len(windows)] == doc[width - 1 :]
    return windows[inside], doc[: len(windows)][inside], digests, words


def distinct_shingles(texts: list[bytes], width: int = SHINGLE):
    """As :func:`shingles`, each shingle once per text and sorted in it, with how often it occurs there."""
    h, doc, digests, words = shingles(texts, width)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return h[at], doc[at], np.diff(np.append(at, len(h))), digests, words


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(float) + 0.5) / 2.0**53


def dart_signatures(h: np.ndarray, doc: np.ndarray, weights: np.ndarray, n_docs: int, k: int) -> np.ndarray:
    """Signatures (n_docs x k) of the weighted sets (doc, element hash, weight); sets without weight stay 0.

    The weight axis is cut into unit cells, so equal elements of different
    weights share the darts of their common part. The ranks of a cell's
    darts are sums of exponential steps hashed from the element, the cell and
    the step. A set that left a coordinate without a dart sees twice as many.
    """
    cells = np.ceil(weights).astype(np.int64)
    cell = np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
    ch = mixed(np.repeat(h, cells) + cell.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    top = np.minimum(np.repeat(weights, cells) - cell, 1.0)
    cdoc = np.repeat(doc, cells)
    total = np.bincount(doc, weights, n_docs)
    signature = np.zeros((n_docs, k), np.uint64)
    todo, darts = total > 0, k * (np.log(k) + 2.0)
    while todo.any():
        reach = np.divide(darts, total, out=np.zeros(n_docs), where=todo)
        on = np.flatnonzero(todo[cdoc])
        rank, step = np.zeros(len(on)), 0
        best = np.full(n_docs * k, np.inf)
        seen = []
        while len(on):
            step += 1
            dart = mixed(ch[on] ^ np.uint64(step * 0xA0761D6478BD642F % (1 << 64)))
            rank = rank - np.log(_uniform(dart))
            near = rank < reach[cdoc[on]]
            on, rank, dart = on[near], rank[near], mixed(dart[near])
            hit = _uniform(dart) < top[on]
            d = mixed(dart[hit])
            slot = cdoc[on[hit]] * k + (d % np.uint64(k)).astype(np.int64)
            np.minimum.at(best, slot, rank[hit])
            seen.append((slot, rank[hit], d))
        for slot, r, d in seen:
            first = r == best[slot]
            signature.ravel()[slot[first]] = d[first]
        todo = todo & np.isinf(best.reshape(n_docs, k)).any(1)
        darts *= 2
    return signature


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    texts = batch["text"].to_pylist()
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= BLOCK_BYTES):
            size += len(texts[j])
            j += 1
        yield batch.slice(i, j - i), texts[i:j]
        i = j


def signer(rows: int, bands: int, width: int, weighted: bool, carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _blocks(batch):
                h, doc, times, digests, words = distinct_shingles(texts, width)
                weights = times.astype(float) if weighted else np.ones(len(h))
                s = dart_signatures(h, doc, weights, len(texts), rows * bands)
                keys = chained(
                    np.tile(np.arange(bands, dtype=np.uint64), len(texts)),
                    *s.reshape(-1, rows).T,
                ).view(np.int64)
                sizes = np.bincount(doc, minlength=len(texts))
                has = sizes > 0
                offsets = np.append(0, np.cumsum(np.where(has, bands, 0)))
                flat = keys.reshape(-1, bands)[has].ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        part["raw"],
                        pa.array(digests, pa.binary()),
                        pa.array(sizes.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64())),
                        pa.array(words.astype(np.int64)),
                        *[part[c] for c in carried],
                    ],
                    names=["doc_id", "raw", "digest", "n_shingles", "bands", "words", *carried],
                )

    return run


def shingler(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _blocks(batch):
                h, doc, times, _, _ = distinct_shingles(texts, width)
                offsets = np.searchsorted(doc, np.arange(len(texts) + 1))
                lists = lambda v: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(v, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part["node"], lists(h.view(np.int64)), lists(times)], names=["node", "shingles", "times"]
                )

    return run


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable over ``links`` (a, b); nodes without links don't appear.

    Labels shrink to the smallest among the neighbours' and then follow their own label;
    every round is written down, so lineage stays short.
    """
    both = stage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("comp")), "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("comp").alias("near"))
        )
        step = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("comp").alias("next"))
        step = step.join(jump, "new").select("node", "comp", "next")
        step = stage(step, "labels")
        changed = step.where("comp <> next").limit(1).count()
        labels = step.select("node", F.col("next").alias("comp"))
        if not changed:
            return labels


def classes(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    rows: int = ROWS,
    bands: int = BANDS,
    width: int = SHINGLE,
    weighted: bool = False,
    carry: Column | None = None,
) -> DataFrame:
    """One row per document: doc_id, class_id, kept, raw (md5 of its text), class_no, uid, words and, if given, carry (as ``carried``).

    Classes are the connected components of similarity >= ``threshold``, over
    sets of word shingles (``weighted``: over multisets). class_id is the
    smallest non-null doc_id of a class (null if there is none). One row of a
    class is kept: the smallest doc_id, null last, then the smallest raw.
    Words are lower-cased (A-Z). A text of fewer than ``width`` words is one
    shingle; all texts without words, null ones too, are copies of each other.
    Repeated rows are copies; which of several equal rows is kept doesn't
    matter, but ``kept`` is set on one of them only. class_no is one number per class, never null;
    uid numbers the rows, words is the number of a text's words. Other columns are not read.

    Copies are one node each. Every node is compared with the first one of a band bucket, the
    one it meets most often; in buckets that still hold several components, with the next in an order
    that puts like signatures together (:func:`next_in_bucket`); for what then still lies in different components of
    the same bucket an exact prefix filter finds the pairs to compare (:func:`prefix_pairs`).
    All decisions rest on exact similarity.
    """
    small_batches(docs.sparkSession)
    d = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.md5(whole("text").cast("binary")).alias("raw"),
        whole("text").cast("binary").alias("text"),
        *([] if carry is None else [carry.alias("carried")]),
    )
    carried = [f.name for f in d.schema if f.name == "carried"]
    signed = d.mapInArrow(
        signer(rows, bands, width, weighted, carried),
        "doc_id bigint, raw string, digest binary, n_shingles bigint, bands array<bigint>, words bigint"
        + "".join(f", {c} {d.schema[c].dataType.simpleString()}" for c in carried),
    )
    signed = stage(signed.withColumn("uid", F.monotonically_increasing_id()), "darts")
    first = F.row_number().over(W.partitionBy("digest").orderBy(F.col("doc_id").asc_nulls_last(), "raw", "uid"))
    nodes = signed.drop("words", *carried).withColumn("nr", first).where("nr = 1").drop("nr")
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "texts")
    banded = nodes.select("node", F.explode("bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.min("node").alias("hub"), F.count("*").alias("size")).where("size > 1")
    members = stage(banded.join(hubs.drop("size"), "band"), "buckets")
    # per node and hub, in how many buckets they meet
    pairs = members.where("node <> hub").groupBy("node", "hub").agg(F.count("*").alias("met"))
    best = F.row_number().over(W.partitionBy("node").orderBy(F.col("met").desc(), "hub"))
    pairs = stage(pairs.withColumn("choice", best), "pairs")

    wanted = members.select("node").distinct()
    # rows equal in id and text give one text, so no pair is compared twice
    key = F.concat_ws("/", "raw", F.col("doc_id").cast("string")).alias("key")
    source = nodes.join(wanted, "node", "left_semi").select("node", key)
    texts = d.select(key, "text").dropDuplicates(["key"]).join(source, "key").select("node", "text")
    sets = stage(
        texts.mapInArrow(shingler(width), "node bigint, shingles array<bigint>, times array<bigint>"), "shingles"
    )

    def similar(found: DataFrame) -> DataFrame:
        """Of pairs (a, b) those at or above the threshold."""
        cols = ["node", "shingles", *(["times"] if weighted else [])]
        left = sets.select(*[F.col(c).alias(f"{c}_a") for c in cols])
        right = sets.select(*[F.col(c).alias(f"{c}_b") for c in cols])
        both = found.join(left, F.col("a") == F.col("node_a")).join(right, F.col("b") == F.col("node_b"))
        if weighted:
            lookup = F.map_from_arrays("shingles_b", "times_b")
            common = F.aggregate(
                F.zip_with("shingles_a", "times_a", lambda s, t: F.least(t, F.coalesce(F.element_at(lookup, s), F.lit(0)))),
                F.lit(0).cast("bigint"),
                lambda x, y: x + y,
            )
            size = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda x, y: x + y)
            total = size("times_a") + size("times_b")
        else:
            common = F.size(F.array_intersect("shingles_a", "shingles_b"))
            total = F.size("shingles_a") + F.size("shingles_b")
        # j = common / (total - common) >= threshold
        return both.where(common >= F.lit(threshold) * (total - common)).select("a", "b").distinct()

    order = lambda x, y: [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]
    links = stage(similar(pairs.where("choice = 1").select(*order("node", "hub")).distinct()), "links-1")
    comp = components(links)

    def labelled(rows: DataFrame) -> DataFrame:
        """(band, node) with the component so far, of buckets whose members are in several."""
        c = comp.select(F.col("node").alias("n_"), "comp")
        rows = rows.join(c, F.col("node") == F.col("n_"), "left").withColumn("comp", F.coalesce("comp", "node"))
        rows = stage(rows.select("band", "node", "comp"), "open")
        split = rows.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"))
        return rows.join(split.where("lo <> hi").select("band", "size"), "band")

    open_ = labelled(members)
    more = stage(similar(next_in_bucket(open_, nodes)), "links-2")
    if more.limit(1).count():
        links = links.unionByName(more)
        comp = components(links)
        open_ = labelled(open_.select("band", "node"))

    # the two of a bucket of two have been compared
    pool = open_.where("size > 2").select("node", "comp").distinct()
    found = stage(prefix_pairs(sets.join(pool, "node"), threshold, weighted), "prefix-pairs")
    more = stage(similar(found), "links-3")
    if more.limit(1).count():
        comp = components(links.unionByName(more))

    c = comp.select(F.col("node").alias("n_"), "comp")
    placed = nodes.join(c, F.col("node") == F.col("n_"), "left").select(
        F.col("digest").alias("d_"), F.col("uid").alias("u_"), "doc_id", "raw", F.coalesce("comp", "node").alias("comp")
    )
    head = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "raw", "u_")
    heads = placed.groupBy("comp").agg(F.min(head).alias("head"), F.count("*").alias("texts"))
    placed = placed.select("d_", "comp").join(heads, "comp")
    return signed.join(placed, F.col("digest") == F.col("d_")).select(
        "doc_id",
        F.col("head.doc_id").alias("class_id"),
        (F.col("uid") == F.col("head.u_")).alias("kept"),
        F.col("texts").alias("class_texts"),
        "raw",
        F.col("comp").alias("class_no"),
        "uid",
        "words",
        *carried,
    )


def next_in_bucket(open_: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components that follow each other in a bucket of ``open_`` (band, node, comp).

    A bucket is ordered by the two bands behind its own, so texts that share them too are neighbours. There are no more
    pairs than rows, and a member that is similar to many of a family mostly finds one of them here.
    """
    at = F.array_position("bands", F.col("band"))
    behind = [F.element_at("bands", ((at + i) % F.size("bands") + 1).cast("int")).alias(f"behind_{i}") for i in (0, 1)]
    rows = open_.join(nodes.select("node", "bands"), "node").select("band", "node", "comp", *behind)
    order = W.partitionBy("band").orderBy("behind_0", "behind_1", "node")
    before = rows.withColumn("b_", F.lag("node").over(order)).withColumn("c_", F.lag("comp").over(order)).where("comp <> c_")
    return before.select(F.least("node", "b_").alias("a"), F.greatest("node", "b_").alias("b")).distinct()


def prefix_pairs(sets: DataFrame, threshold: float, weighted: bool) -> DataFrame:
    """Pairs (a, b) of different components that may reach the threshold, from sets (node, comp, shingles, times); none that does is left out.

    Two sets as similar as the threshold have at least that share of either in
    common. So only shingles found in several components count, a set of which too
    few count is done, and of the others each is listed under its rarest ones,
    up to the one from which on too little is left: similar sets have the first of
    their common shingles in both lists. What many texts share is in none as long as it is less
    than the threshold asks for. Shingles that lists of one component only hold are dropped,
    and members of the component that holds most of a shingle's lists aren't compared with each other.
    """
    t, room = F.lit(threshold), F.lit(1e-6)  # for rounding
    sizes = sets.withColumn("total", F.size("shingles").cast("bigint"))
    if weighted:
        sizes = sizes.withColumn("total", F.aggregate("times", F.lit(0).cast("bigint"), lambda x, y: x + y))
    if weighted:
        listed = sizes.select("node", "comp", "total", F.explode(F.arrays_zip("shingles", "times")).alias("s"))
        listed = listed.select("node", "comp", "total", F.col("s.shingles").alias("shingle"), F.col("s.times").alias("n"))
    else:
        listed = sizes.select("node", "comp", "total", F.explode("shingles").alias("shingle"), F.lit(1).cast("bigint").alias("n"))

    texts = F.count("*").alias("texts")
    often = listed.groupBy("shingle").agg(texts, F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    shared = listed.join(often.where("lo <> hi").select("shingle", "texts"), "shingle")
    rest = F.sum("n").over(W.partitionBy("node").orderBy(F.col("texts").desc(), F.col("shingle").desc()))
    lists = shared.withColumn("rest", rest).where(F.col("rest") >= t * F.col("total") - room)
    lists = stage(lists.select("shingle", "node", "comp", "total", "rest"), "prefixes")
    most = lists.groupBy("shingle", "comp").agg(texts).groupBy("shingle")
    most = most.agg(F.max_by("comp", F.struct("texts", "comp")).alias("most"), F.count("*").alias("comps"))
    lists = stage(lists.join(most.where("comps > 1").drop("comps"), "shingle"), "lists")
    left = lists.select("shingle", *[F.col(c).alias(f"{c}_a") for c in ("node", "comp", "total", "rest", "most")])
    right = lists.where("comp <> most").select("shingle", *[F.col(c).alias(f"{c}_b") for c in ("node", "comp", "total", "rest")])
    apart = (F.col("comp_a") == F.col("most_a")) | (F.col("comp_a") < F.col("comp_b"))
    # common >= threshold * (total_a + total_b - common), and what is common lies in both rests
    enough = F.least("rest_a", "rest_b") * (1 + t) >= t * (F.col("total_a") + F.col("total_b")) - room
    pairs = left.join(right, "shingle").where(apart & (F.col("comp_a") != F.col("comp_b")) & enough)
    return pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The kept document of each class, with the columns of ``docs``."""
    kept = classes(docs, **options).where("kept").select(F.col("doc_id").alias("_i"), F.col("raw").alias("_r"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    d = docs.select(row.alias("row"), F.col("doc_id").cast("bigint").alias("id"), F.md5(whole("text").cast("binary")).alias("raw"))
    d = d.join(kept, F.col("raw") == F.col("_r")).where(F.col("id").eqNullSafe(F.col("_i")))
    # rows equal in id and text: one of them
    nr = F.row_number().over(W.partitionBy("raw").orderBy(*tie_order(docs)))
    return d.withColumn("nr", nr).where("nr = 1").select("row.*")

"""Conflict-constrained best-fit packing of documents into sequences.

Documents are packed in blocks of bounded size, each inside one task. A block
keeps its open bins ordered by residual; every bin carries one bitmap with a
bit for each source and each duplicate cluster in it. A piece goes to the
successor of its size among the residuals, and on to the next one as long as
the bitmaps meet, so it ends in the tightest compatible bin or opens one.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import near_duplicates
from tidewatch.llm.common import n_words, whole

#: Sequence length in words.
CAPACITY = 2_048
#: Documents packed together. Blocks are independent, so memory and the
#: length of a successor search stay bounded; loss of fit is one part-filled tail of bins per block.
BLOCK_ROWS = 8_192

#: Rests of one source a sequence may hold. With 1, a source with a third of the documents
#: would set the number of sequences and leave them half empty.
PER_SOURCE = 4

#: A task has room for 2^40 bins, some 10^15 words.
PART_SHIFT = 40

SCHEMA = "bin_id bigint, doc_id bigint, piece int, start bigint, n_words bigint, position int, bin_words bigint"


def best_fit(sizes, conflicts, capacity: int):
    """Bins (lists of item numbers) for items of at most ``capacity``, largest first, equal sizes in given order.

    ``conflicts`` has per item (full, low, field): a bin whose bitmap meets
    ``full`` is not compatible; joining sets ``low`` and moves what is set in ``field`` up by one.
    Items of size 0 get no bin.
    """
    order = sorted((i for i in range(len(sizes)) if sizes[i] > 0), key=lambda i: -sizes[i])
    bins: list[list[int]] = []
    carried: list[int] = []
    residuals: list[tuple[int, int]] = []  # (residual, bin), ascending
    for i in order:
        size, (full, low, field) = sizes[i], conflicts[i]
        at = bisect_left(residuals, (size, -1))
        while at < len(residuals) and carried[residuals[at][1]] & full:
            at += 1
        if at < len(residuals):
            left, b = residuals.pop(at)
            bins[b].append(i)
            carried[b] |= low | ((carried[b] & field) << 1 & field)
            left -= size
        else:
            b, left = len(bins), capacity - size
            bins.append([i])
            carried.append(low)
        if left:
            insort(residuals, (left, b))
    return bins


def conflict_bits(keys: list[list], limits: list[int]) -> list[tuple[int, int, int]]:
    """Per item the bits :func:`best_fit` works with.

    Each key that occurs more often than its column's limit owns ``limit`` bits; k of them
    are set in a bin that holds k items with the key, and the last one closes the bin for it.
    Null keys have no bits.
    """
    masks = [(0, 0, 0)] * (len(keys[0]) if keys else 0)
    bit = 0
    for column, limit in zip(keys, limits, strict=True):
        first: dict = {}
        counts = Counter(column)
        for i, k in enumerate(column):
            if k is None or counts[k] <= limit:
                continue
            if k not in first:
                first[k] = bit
                bit += limit
            f = first[k]
            full, low, field = masks[i]
            masks[i] = (full | 1 << f + limit - 1, low | 1 << f, field | ((1 << limit) - 1) << f)
    return masks


def pack_block(sizes: list[int], keys: list[list], limits: list[int], capacity: int):
    """Arrays (bin, item, piece, start, words, position, bin words); bin -1 holds items without words."""
    out = []
    n_bins = 0
    rest = []
    for i, n in enumerate(sizes):
        full = n // capacity
        for p in range(full):
            out.append((n_bins, i, p, p * capacity, capacity, 0, capacity))
            n_bins += 1
        rest.append(n - full * capacity)
        if n == 0:
            out.append((-1, i, 0, 0, 0, 0, 0))
    for members in best_fit(rest, conflict_bits(keys, limits), capacity):
        filled = sum(rest[i] for i in members)
        for at, i in enumerate(members):
            out.append((n_bins, i, sizes[i] // capacity, sizes[i] - rest[i], rest[i], at, filled))
        n_bins += 1
    return np.array(out, np.int64).reshape(-1, 7).T


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    size: Column | None = None,
    cluster: Column | None = None,
    per_source: int = PER_SOURCE,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per piece: bin_id, doc_id, piece, start, n_words, position, bin_words.

    A document longer than ``capacity`` is cut into full pieces, each a bin of
    its own, and one rest that is packed. No bin holds more than ``per_source``
    rests of one source, or two of one cluster (default: texts equal but for case and spacing). Null
    sources and clusters conflict with nothing. Documents without words (null
    or blank text) come out once with null bin_id. Null and repeated doc_ids
    are packed like any row. Bins are numbered from task number times 2^40 on, through all blocks of a task, so a
    repeated task gives the same bins.
    """
    words = n_words("text") if size is None else size
    digest = F.md5(F.lower(F.regexp_replace(F.trim(whole("text")), r"[\x20\x09-\x0D]+", " ")).cast("binary"))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        words.cast("bigint").alias("size"),
        F.col("source").cast("string").alias("source"),
        (digest if cluster is None else cluster).alias("cluster"),
        F.spark_partition_id().alias("part"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, first, part = [], 0, 0, 0

        def flush():
            nonlocal first
            t = pa.Table.from_batches(held)
            b, item, piece, start, n_w, pos, filled = pack_block(
                [x or 0 for x in t["size"].to_pylist()],
                [t["source"].to_pylist(), t["cluster"].to_pylist()],
                [per_source, 1],
                capacity,
            )
            ids = t["doc_id"].combine_chunks()
            packed = pa.RecordBatch.from_arrays(
                [
                    pa.array((part << PART_SHIFT) + first + b, mask=b < 0),
                    ids.take(pa.array(item)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(n_w),
                    pa.array(pos.astype(np.int32)),
                    pa.array(filled),
                ],
                names=["bin_id", "doc_id", "piece", "start", "n_words", "position", "bin_words"],
            )
            first += int(b.max(initial=-1)) + 1
            return packed

        for batch in batches:
            while batch.num_rows:
                part = batch["part"][0].as_py()
                head = batch.slice(0, block_rows - n)
                held.append(head)
                n += head.num_rows
                batch = batch.slice(head.num_rows)
                if n == block_rows:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()

    return rows.mapInArrow(run, SCHEMA)


def pack_apart(docs: DataFrame, **options) -> DataFrame:
    """As :func:`pack`, with at most one rest of each class of near duplicates in a bin.

    Rows are dealt to tasks by their number, so a large class is spread over all blocks;
    texts stay where they are read.
    """
    rows = near_duplicates.classes(docs, carry=F.col("source").cast("string"))
    rows = rows.select("doc_id", "class_no", "uid", F.col("words").alias("size"), F.col("carried").alias("source"))
    rows = rows.repartition("uid").sortWithinPartitions("uid")
    return pack(rows, size=F.col("size"), cluster=F.col("class_no"), **options)

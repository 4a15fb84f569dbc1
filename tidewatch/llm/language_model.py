"""Deleted interpolation: a bigram model mixed with unigrams and a uniform floor.

    P(w|v) = l2(b) c(v,w)/c(v) + l1(b) c(w)/N + l0(b) / (V+1)

b is the bucket of the context's frequency c(v) by powers of two; the weights
of each bucket are learned by expectation-maximisation on documents deleted
from the counts. V+1 counts one class for all unknown words.

How the counts reach the words without a row per word: texts are cut into
chunks of some megabytes. A chunk asks for each of its distinct words and
bigrams once, by 64-bit hash and with its own counts; hash buckets add up the
counts of all chunks and answer every question. Each chunk then has the
corpus counts of its own n-grams and scores its documents. What is shuffled
is about ten bytes per distinct n-gram of a chunk, and no task holds more
than one chunk or one hash bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import crc_mod, small_batches, stage, whole
from tidewatch.llm.tokens import chained, word_hashes

CHUNK_BYTES = 6 << 20
#: Text per hash bucket, about; the number of buckets is a power of two.
BUCKET_BYTES = 8 << 20
MAX_BUCKETS = 1 << 16
START, END = 0x5354415254000001, 0x454E440000000001
N_BUCKETS_OF_CONTEXTS = 64
#: Weight of the pooled weights in a bucket's own, in events.
PRIOR = 10.0

CHUNK_SCHEMA = (
    "chunk bigint, dev boolean, ids array<bigint>, held array<boolean>, lens binary, words binary, seq binary"
)
ASK_SCHEMA = "bucket int, chunk bigint, dev boolean, uni binary, uni_n binary, bi binary, bi_n binary"
ANSWER_SCHEMA = (
    "chunk bigint, dev boolean, bucket int, uni binary, bi binary, uni_fit binary, bi_fit binary,"
    " n_all bigint, n_fit bigint, v bigint"
)


def squeeze(counts: np.ndarray) -> bytes:
    """Counts as one byte each; those of 255 and more follow in full."""
    big = counts[counts >= 255].astype(np.int64)
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + big.tobytes()


def unsqueeze(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(data, np.int64, offset=n)
    return out


def pressed(a: np.ndarray) -> bytes:
    """32-bit numbers, bytes of equal weight together, compressed."""
    planes = a.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.Codec("zstd").compress(planes, asbytes=True)


def unpressed(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = pa.Codec("zstd").decompress(data[8:], n, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def make_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents to chunks: sorted distinct word hashes and the sequence of their numbers."""
    number = {True: 0, False: 0}

    def chunk(dev, ids, held, texts, part):
        h, n = word_hashes(texts)
        seq = np.full(len(h) + len(n), END, np.uint64)
        seq[np.arange(len(h)) + np.repeat(np.arange(len(n)), n)] = h
        words, inverse, counts = np.unique(seq, return_inverse=True, return_counts=True)
        frequent = np.argsort(-counts, kind="stable")  # small numbers for frequent words
        place = np.empty(len(words), np.int64)
        place[frequent] = np.arange(len(words))
        no = number[dev]
        number[dev] += 1
        return pa.RecordBatch.from_arrays(
            [
                pa.array([(part << 24) + (no << 1) + dev], pa.int64()),
                pa.array([dev]),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([held], pa.list_(pa.bool_())),
                pa.array([pressed(n)]),
                pa.array([words[frequent].tobytes()]),
                pa.array([pressed(place[inverse])]),
            ],
            names=["chunk", "dev", "ids", "held", "lens", "words", "seq"],
        )

    waiting = {True: [[], [], [], 0], False: [[], [], [], 0]}
    part = 0
    for batch in batches:
        cols = [batch[c].to_pylist() for c in ("doc_id", "dev", "held", "text", "part")]
        for doc_id, dev, held, text, part in zip(*cols, strict=True):
            w = waiting[dev]
            size = len(text) + 16  # many empty texts fill a chunk as well
            if w[3] and w[3] + size > CHUNK_BYTES:
                yield chunk(dev, *w[:3], part)
                w = waiting[dev] = [[], [], [], 0]
            w[0].append(doc_id)
            w[1].append(held)
            w[2].append(text)
            w[3] += size
    for dev, w in waiting.items():
        if w[0]:
            yield chunk(dev, *w[:3], part)


def opened(row) -> tuple:
    """(lens, sorted words, word of each token, context of each token, sorted bigrams, bigram of each token).

    The last of the sorted words' numbers, len(words), stands for the start of a text.
    """
    lens, seq = unpressed(row["lens"]), unpressed(row["seq"])
    words = np.frombuffer(row["words"], np.uint64)
    order = np.argsort(words)
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    words, token = words[order], place[seq]
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[np.cumsum(lens + 1) - (lens + 1)] = len(words)
    hashes = np.append(words, np.uint64(START))
    bigrams, bi = np.unique(chained(hashes[context], hashes[token]), return_inverse=True)
    return lens, words, token, context, bigrams, bi


def make_questions(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lens, words, token, _, bigrams, bi = opened(row)
                held = np.array(row["held"], bool)
                learn = ~np.repeat(held, lens + 1)
                uni_n = np.bincount(token[learn], minlength=len(words))
                bi_n = np.bincount(bi[learn], minlength=len(bigrams))
                # the start of a text is asked for like a word; it belongs to the last bucket but for its count
                uni_at = np.searchsorted(words, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
                bi_at = np.searchsorted(bigrams, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
                uni_at, bi_at = np.append(uni_at, len(words)), np.append(bi_at, len(bigrams))
                cols = [[], [], [], [], []]
                for b in range(1 << bits):
                    u, x = slice(uni_at[b], uni_at[b + 1]), slice(bi_at[b], bi_at[b + 1])
                    if u.start < u.stop or x.start < x.stop:
                        for c, v in zip(
                            cols,
                            (b, words[u].tobytes(), squeeze(uni_n[u]), bigrams[x].tobytes(), squeeze(bi_n[x])),
                            strict=True,
                        ):
                            c.append(v)
                k = len(cols[0])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cols[0], pa.int32()),
                        pa.array([row["chunk"]] * k, pa.int64()),
                        pa.array([row["dev"]] * k),
                        *[pa.array(c, pa.binary()) for c in cols[1:]],
                    ],
                    names=["bucket", "chunk", "dev", "uni", "uni_n", "bi", "bi_n"],
                )

    return run


def answer(t):
    """All questions of one hash bucket: the corpus counts of each n-gram, with and without the deleted texts."""
    dev = np.array(t["dev"].to_pylist(), bool)
    out: dict[str, list] = {}
    sums = {}
    for kind in ("uni", "bi"):
        parts = [np.frombuffer(x, np.uint64) for x in t[kind].to_pylist()]
        sizes = np.array([len(x) for x in parts])
        counts = np.concatenate([unsqueeze(x, n) for x, n in zip(t[f"{kind}_n"].to_pylist(), sizes, strict=True)])
        distinct, inverse = np.unique(np.concatenate(parts), return_inverse=True)
        every = np.bincount(inverse, counts, len(distinct)).astype(np.int64)
        fit = every - np.bincount(inverse, counts * np.repeat(dev, sizes), len(distinct)).astype(np.int64)
        if kind == "uni":
            sums = {"n_all": int(every.sum()), "n_fit": int(fit.sum()), "v": int((every > 0).sum())}
        ends = np.cumsum(sizes)
        pieces = [inverse[e - n : e] for e, n in zip(ends, sizes, strict=True)]
        out[kind] = [squeeze(every[x]) for x in pieces] + [None]
        out[f"{kind}_fit"] = [squeeze(fit[x]) if d else None for x, d in zip(pieces, dev, strict=True)] + [None]
    k = t.num_rows
    return pa.table(
        {
            "chunk": pa.array([*t["chunk"].to_pylist(), None], pa.int64()),
            "dev": pa.array([*t["dev"].to_pylist(), None], pa.bool_()),
            "bucket": pa.array([t["bucket"][0].as_py()] * (k + 1), pa.int32()),
            **{c: pa.array(out[c], pa.binary()) for c in ("uni", "bi", "uni_fit", "bi_fit")},
            **{c: pa.array([None] * k + [v], pa.int64()) for c, v in sums.items()},
        }
    )


def gathered(t, starts: int, fit: bool):
    """The chunk of a group and the counts of its words (then the start), bigrams."""
    rows = t.to_pylist()
    row = next(r for r in rows if r["seq"] is not None)
    answers = sorted((r for r in rows if r["seq"] is None), key=lambda r: r["bucket"])
    o = opened(row)
    _, words, _, _, bigrams, _ = o
    shift = np.uint64(64 - (starts[1]))
    suffix = "_fit" if fit else ""
    of = lambda kind, keys: np.concatenate(
        [
            unsqueeze(r[kind + suffix], n)
            for r, n in zip(answers, np.bincount((keys >> shift).astype(np.int64), minlength=1 << starts[1])[[r["bucket"] for r in answers]], strict=True)
        ]
    )
    uni, bi = of("uni", words), of("bi", bigrams)
    if len(uni) != len(words) or len(bi) != len(bigrams):
        raise RuntimeError("answers don't fit the chunk")
    return row, o, np.append(uni, starts[0]), bi


def parts_of(o, uni, bi, n_tokens: int):
    """Per token: bucket of its context, bigram and unigram estimates."""
    _, _, token, context, _, at = o
    c = uni[context]
    b = np.where(c > 0, np.frexp(c.astype(float))[1], 0)
    p2 = np.divide(bi[at], c, out=np.zeros(len(c)), where=c > 0)
    return b, p2, uni[token] / max(n_tokens, 1)


def histogram(starts, n_fit: int):
    def run(t):
        _, o, uni, bi = gathered(t, starts, True)
        b, p2, p1 = parts_of(o, uni, bi, n_fit)
        level = lambda p: np.where(p > 0, 1 + np.floor(-2 * np.log2(np.where(p > 0, p, 1))), 0).astype(np.int64)
        cell, inverse = np.unique((b.astype(np.int64) << 20) + (level(p2) << 10) + level(p1), return_inverse=True)
        return pa.table(
            {
                "cell": pa.array(cell),
                "n": pa.array(np.bincount(inverse).astype(np.int64)),
                "p2": pa.array(np.bincount(inverse, p2)),
                "p1": pa.array(np.bincount(inverse, p1)),
            }
        )

    return run


def learn_weights(cells: list, v: int, steps: int = 60) -> np.ndarray:
    """Mixture weights (bigram, unigram, floor) for each context bucket by expectation-maximisation.

    ``cells`` are (cell, n, sum of p2, sum of p1): events alike to a factor of
    the square root of two in both estimates, at their mean. That bounds them by the
    number of cells, whatever the size of the corpus.
    """
    pooled = np.array([0.3, 0.6, 0.1])
    out = np.tile(pooled, (N_BUCKETS_OF_CONTEXTS, 1))
    if not cells:
        return out
    a = np.array([tuple(x) for x in cells], float)
    bucket, n = a[:, 0].astype(np.int64) >> 20, a[:, 1]
    p = np.stack([a[:, 2] / n, a[:, 3] / n, np.full(len(a), 1 / (v + 1))], 1)

    def em(p, n, weights, prior, strength):
        for _ in range(steps):
            share = p * weights
            share /= share.sum(1, keepdims=True)
            got = (share * n[:, None]).sum(0) + strength * prior
            weights = got / got.sum()
        return weights

    pooled = em(p, n, pooled, pooled, 1e-3)
    for b in range(N_BUCKETS_OF_CONTEXTS):
        own = bucket == b
        out[b] = em(p[own], n[own], pooled, pooled, PRIOR) if own.any() else pooled
    return out


def scorer(starts, n_all: int, v: int, weights: np.ndarray):
    def run(t):
        row, o, uni, bi = gathered(t, starts, False)
        lens, token = o[0], o[2]
        b, p2, p1 = parts_of(o, uni, bi, n_all)
        l2, l1, l0 = weights.T
        # an unseen context has no bigram estimate: its weight goes to the other two
        unseen = b == 0
        total = np.where(unseen, l1[b] + l0[b], 1.0)
        p = (l2[b] * p2 + l1[b] * p1 + l0[b] / (v + 1)) / total
        base = (uni[token] + 0.5) / (n_all + 0.5 * (v + 1))
        doc = np.repeat(np.arange(len(lens)), lens + 1)
        add = lambda x: np.bincount(doc, x, len(lens))
        return pa.table(
            {
                "doc_id": pa.array(row["ids"], pa.int64()),
                "held_out": pa.array(row["held"], pa.bool_()),
                "n_tokens": pa.array(lens + 1),
                "n_known": pa.array(add(uni[token] > 0).astype(np.int64)),
                "train_tokens": pa.array(np.full(len(lens), n_all, np.int64)),
                "base_score": pa.array(add(np.log10(base))),
                "score": pa.array(add(np.log10(p))),
            }
        )

    return run


SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint,"
    " base_score double, score double"
)


def score_documents(docs: DataFrame, held_out: Column | None = None, deleted: Column | None = None) -> DataFrame:
    """Scores of all documents under the model learned from those not held out.

    ``held_out`` defaults to crc32(doc_id) mod 5 = 1; of the rest, ``deleted``
    (crc32 mod 20 = 2) teach the weights before their counts join in. Null
    text is empty: one token, the end. Null ids count as "". Repeated rows are
    scored, and counted, each. An empty table gives no rows; with nothing to
    learn from every token has probability 1/(V+1) = 1. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    held = crc_mod("doc_id", 5) == 1 if held_out is None else held_out
    dev = (crc_mod("doc_id", 20) == 2 if deleted is None else deleted) & ~held
    d = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        held.alias("held"),
        dev.alias("dev"),
        whole("text").cast("binary").alias("text"),
        F.spark_partition_id().alias("part"),
    )
    size, starts = d.agg(
        F.sum(F.octet_length("text")), F.sum(F.when(~F.col("held"), 1))
    ).first()
    chunks = stage(d.mapInArrow(make_chunks, CHUNK_SCHEMA), "lm-chunks")
    bits = min(MAX_BUCKETS, max(16, (size or 0) // BUCKET_BYTES)).bit_length()
    asked = chunks.mapInArrow(make_questions(bits), ASK_SCHEMA)
    answers = stage(asked.groupBy("bucket").applyInArrow(answer, ANSWER_SCHEMA), "lm-counts")
    n_all, n_fit, v = answers.where("chunk is null").agg(F.sum("n_all"), F.sum("n_fit"), F.sum("v")).first()
    n_all, n_fit, v = n_all or 0, n_fit or 0, v or 0
    answers = answers.where("chunk is not null").drop("n_all", "n_fit", "v")

    def by_chunk(which):
        both = chunks.where(which).unionByName(answers.where(which), allowMissingColumns=True)
        return both.groupBy("chunk")

    dev_starts, = d.where("dev").agg(F.count("*")).first()
    cells = by_chunk("dev").applyInArrow(
        histogram(((starts or 0) - dev_starts, bits), n_fit), "cell bigint, n bigint, p2 double, p1 double"
    )
    cells = cells.groupBy("cell").agg(F.sum("n"), F.sum("p2"), F.sum("p1")).orderBy("cell").collect()
    weights = learn_weights(cells, v)
    return by_chunk("true").applyInArrow(scorer((starts or 0, bits), n_all, v, weights), SCORES)

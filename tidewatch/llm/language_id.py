"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +-1. A letter trigram is bound from the
vectors of its letters, rotated by their place: rot2(a) * rot(b) * c. A text
is the bundle (sum) of its trigrams, a language the bundle of its texts, and
the prediction is the language with the largest cosine.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import crc_mod, small_batches, whole
from tidewatch.llm.tokens import mixed

DIMENSIONS = 1_024
UNKNOWN = "und"
#: No text with a smaller cosine is kept, whatever the calibration says: one standard deviation of a chance cosine
#: (1 / sqrt(DIMENSIONS)). What decides for most texts are the cutoffs of :func:`learn_cutoffs`.
LEAST_COSINE = 0.03
#: Share of the training texts of a language and length that may fall below its cutoff.
LOST = 0.005
#: Fewest texts a cutoff is taken from: for the quantile, and for half of the smallest cosine.
ENOUGH, SOME = 200, 20
#: Length classes (binary digits of the number of letters) that beginnings of long texts are cut to.
FIRST_CLASS, CLASSES = 3, 5
#: Steps of a cosine in the histograms.
STEPS = 1_000
#: Cells of the count matrix (texts x trigrams) worked on at once, and characters.
CELLS, CHARS = 1 << 20, 1 << 19
#: Texts of a batch turned into Python strings at once.
SLICE = 512


def letters_only(text: str = "text") -> Column:
    """Lower-cased letters; all else becomes single spaces."""
    return F.lower(F.trim(F.regexp_replace(whole(text), r"\P{L}+", " ")))


def letter_vectors(codes: np.ndarray, dimensions: int) -> np.ndarray:
    """Vectors of +-1 that follow from the code points."""
    seeds = mixed(codes.astype(np.uint64) + np.uint64(0x1D))[:, None] ^ np.arange(dimensions, dtype=np.uint64) * np.uint64(
        0x9E3779B97F4A7C15
    )
    return ((mixed(seeds) >> np.uint64(63)).astype(np.int8) * 2 - 1).astype(np.float32)


def trigram_counts(texts: list[str]):
    """(text and trigram number of every occurrence, by trigram; first, second and third letters of the trigrams)."""
    codes = np.frombuffer(" ".join(["", *texts, ""]).encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts])
    present = np.zeros(0x110000, bool)
    present[codes] = True
    alphabet = np.flatnonzero(present)
    k = len(alphabet)
    place = np.zeros(0x110000, np.int64)
    place[alphabet] = np.arange(k)
    c = place[codes]
    grams = (c[:-2] * k + c[1:-1]) * k + c[2:]
    # texts share the space between them: a window that reaches past it belongs to neither
    doc = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))[: len(grams)]
    inside = np.arange(len(grams)) + 2 <= ends[doc]
    grams, doc = grams[inside], doc[inside]
    if k**3 <= 1 << 22:
        seen = np.flatnonzero(np.bincount(grams, minlength=k**3))
        number = np.zeros(k**3, np.int64)
        number[seen] = np.arange(len(seen))
        at = number[grams]
    else:
        seen, at = np.unique(grams, return_inverse=True)
    order = np.argsort(at, kind="stable")
    return doc[order], at[order], alphabet[seen // (k * k)], alphabet[seen // k % k], alphabet[seen % k]


def trigram_vectors(a, b, c, dimensions: int) -> np.ndarray:
    alphabet, at = np.unique(np.concatenate([a, b, c]), return_inverse=True)
    v = letter_vectors(alphabet, dimensions)
    n = len(a)
    return np.roll(v, 2, 1)[at[:n]] * np.roll(v, 1, 1)[at[n : 2 * n]] * v[at[2 * n :]]


def _groups(texts: list[str]) -> Iterator[slice]:
    """Slices of texts of about CHARS characters, at most 256 texts each."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and j - i < 256 and (j == i or size + len(texts[j]) <= CHARS):
            size += len(texts[j])
            j += 1
        yield slice(i, j)
        i = j


def bundles(texts: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """Vectors of the texts (each without letters: zeros)."""
    out = np.zeros((len(texts), dimensions), np.float32)
    for s in _groups(texts):
        doc, at, a, b, c = trigram_counts(texts[s])
        rows = len(texts[s])
        step = max(1, CELLS // max(rows, dimensions))
        # counts of some trigrams at a time, so that memory doesn't grow with the alphabet
        for j in range(0, len(a), step):
            t = slice(j, j + step)
            n = len(a[t])
            i, k = np.searchsorted(at, (j, j + n))
            x = np.bincount(doc[i:k] * n + at[i:k] - j, minlength=rows * n).reshape(rows, n).astype(np.float32)
            out[s] += x @ trigram_vectors(a[t], b[t], c[t], dimensions)
    return out


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, SLICE):
            yield batch.slice(i, SLICE)


def learner(dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in sliced(batches):
            langs, texts = np.array(batch["lang"].to_pylist(), object), batch["letters"].to_pylist()
            for lang in sorted(set(langs)):
                own = [texts[i] for i in np.flatnonzero(langs == lang)]
                total = sums.setdefault(lang, np.zeros(dimensions))
                for s in _groups(own):
                    _, at, a, b, c = trigram_counts(own[s])
                    counts = np.bincount(at, minlength=len(a)).astype(np.float64)
                    step = CELLS // dimensions
                    for j in range(0, len(a), step):
                        t = slice(j, j + step)
                        total += counts[t] @ trigram_vectors(a[t], b[t], c[t], dimensions)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
                names=["lang", "bundle"],
            )

    return run


def learn_sums(docs: DataFrame, training: Column | None = None, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """(languages, their bundles) from the texts with letters and a language in ``training``.

    Bundles are sums of whole numbers, so they don't depend on the order of
    rows. What reaches the driver is one vector per language.
    """
    small_batches(docs.sparkSession)
    parts = training_texts(docs, training).mapInArrow(learner(dimensions), "lang string, bundle array<double>")
    cells = parts.select("lang", F.posexplode("bundle").alias("i", "v")).groupBy("lang", "i").agg(F.sum("v").alias("v"))
    rows = cells.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("v")).orderBy("lang").collect()
    return [r["lang"] for r in rows], np.array([[x["v"] for x in r["v"]] for r in rows]).reshape(len(rows), dimensions)


def training_texts(docs: DataFrame, training: Column | None) -> DataFrame:
    train = crc_mod("doc_id", 3) != 1 if training is None else training
    t = docs.where(train & F.col("lang").isNotNull()).select(F.col("lang"), letters_only().alias("letters"))
    return t.where("letters <> ''")


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def learn_profiles(
    docs: DataFrame, training: Column | None = None, dimensions: int = DIMENSIONS
) -> tuple[list[str], np.ndarray]:
    """(languages, their unit vectors), see :func:`learn_sums`."""
    langs, sums = learn_sums(docs, training, dimensions)
    return langs, unit(sums)


def length_class(texts: list[str]) -> np.ndarray:
    return np.array([len(t).bit_length() - 1 for t in texts], np.int64)


def calibrator(langs: list[str], sums: np.ndarray):
    """Counts of training texts by predicted language, length class and cosine; each text is first taken out of its language's bundle.

    Of a long text its beginning counts as well, cut to a length that follows from the
    text's own, so that short lengths are learned from all texts.
    """
    number = {x: i for i, x in enumerate(langs)}
    profiles = unit(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in sliced(batches):
            texts = batch["letters"].to_pylist()
            own = np.array([number[x] for x in batch["lang"].to_pylist()], np.int64)
            v = bundles(texts, sums.shape[1]).astype(float)
            others = sums[own] - v
            alone = np.linalg.norm(others, axis=1) < 1e-6
            others = unit(others)
            cuts = [1 << FIRST_CLASS + len(t) % CLASSES for t in texts]
            long = np.flatnonzero([len(t) >= 2 * c for t, c in zip(texts, cuts, strict=True)])
            starts = [texts[i][: cuts[i]] for i in long]
            for part, at, x in (
                (texts, np.arange(len(texts)), v),
                (starts, long, bundles(starts, sums.shape[1]).astype(float)),
            ):
                x = unit(x)
                cos = x @ profiles.T
                cos[np.arange(len(at)), own[at]] = (x * others[at]).sum(1)
                best, score = cos.argmax(1), np.clip(cos.max(1, initial=0.0), 0.0, 1.0)
                steps = (score * STEPS).astype(int)
                counts.update(
                    k for k, out in zip(zip(best.tolist(), length_class(part).tolist(), steps.tolist()), alone[at]) if not out
                )
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in [*zip(*counts, strict=True), list(counts.values())]],
                names=["lang", "length", "step", "n"],
            )

    return run


def learn_cutoffs(docs: DataFrame, langs: list[str], sums: np.ndarray, training: Column | None = None) -> dict[tuple[int, int], float]:
    """Least cosine by language number and length class, from all training texts; a class that is missing has none.

    It is the LOST-quantile of the cosines of such texts with profiles they are no part
    of. Where a language has fewer than ENOUGH of a length, all languages count together, then shorter
    lengths too (cosines rise with length). Where all these are too few, half of their smallest cosine is taken.
    Junk among the training texts can pull that quantile down to chance, so a cutoff is a third of the median at least.
    What reaches the driver is a histogram of bounded size.
    """
    if not langs:
        return {}
    found = training_texts(docs, training).mapInArrow(calibrator(langs, sums), "lang bigint, length bigint, step bigint, n bigint")
    found = found.groupBy("lang", "length", "step").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros((len(langs), 1 + max([r["length"] for r in found], default=0), STEPS + 1), np.int64)
    for r in found:
        counts[r["lang"], r["length"], r["step"]] = r["n"]
    out = {}
    for length in range(counts.shape[1]):
        for lang in range(len(langs)):
            c = counts[lang, length]
            from_ = length + 1
            while c.sum() < ENOUGH and from_ > 0:
                from_ -= 1
                c = counts[:, from_ : length + 1].sum((0, 1))
            if c.sum() >= SOME:
                least, middle = (float(np.flatnonzero(c.cumsum() > q * c.sum())[0]) / STEPS for q in (LOST, 0.5))
                out[lang, length] = max(least if c.sum() >= ENOUGH else least / 2, middle / 3)
    return out


def predictions(texts: list[str], langs: list[str], profiles: np.ndarray) -> tuple[list[str], np.ndarray]:
    """(language, cosine cut to 0..1) of each text of letters; the first language in order on a tie."""
    dims = profiles.shape[1]
    v = bundles(texts, dims).astype(float)
    some = np.array([bool(t) for t in texts], bool)
    if not langs:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    cos = v @ profiles.T / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    best = cos.argmax(1)
    score = np.where(some, np.clip(cos[np.arange(len(texts)), best], 0.0, 1.0), 0.0)
    return [langs[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)], score


def identify(docs: DataFrame, training: Column | None = None, dimensions: int = DIMENSIONS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Learns from the documents with a language whose crc32(doc_id) mod 3 is not
    1 (null ids count as ""). Texts that are null or have no letter are `und`
    with score 0; so are all if there is nothing to learn from. Texts of any
    length are read whole. Repeated rows are predicted alike. Only doc_id, text and, for
    learning, lang are read.
    """
    langs, profiles = learn_profiles(docs, training, dimensions)
    held = crc_mod("doc_id", 3) == 1 if training is None else ~training

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            pred, score = predictions(batch["letters"].to_pylist(), langs, profiles)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(pred, pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held.alias("held_out"), letters_only().alias("letters"))
    return d.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def in_a_language(
    docs: DataFrame, least: float = LEAST_COSINE, training: Column | None = None, dimensions: int = DIMENSIONS
) -> DataFrame:
    """The documents whose text looks like one of the learned languages, with the columns of ``docs``.

    Rejected are `und`, texts with a cosine below ``least``, and those below the cutoff
    of their predicted language and length (:func:`learn_cutoffs`). A text of a few letters
    can be as far from its language as chance; there the cutoff keeps the learned texts, and
    some others with them. With nothing to learn from, texts with letters stay.
    """
    langs, sums = learn_sums(docs, training, dimensions)
    profiles, cutoffs = unit(sums), learn_cutoffs(docs, langs, sums, training)
    number = {x: i for i, x in enumerate(langs)}
    longest = max((k for _, k in cutoffs), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch["letters"].to_pylist()
            pred, score = predictions(texts, langs, profiles)
            # longer than all of the training texts: as the longest of them
            lengths = np.minimum(length_class(texts), longest).tolist()
            good = [
                bool(t) and (not langs or s >= max(least, cutoffs.get((number[p], k), 0.0)))
                for t, p, s, k in zip(texts, pred, score, lengths, strict=True)
            ]
            yield pa.RecordBatch.from_struct_array(batch["row"].filter(pa.array(good, pa.bool_())))

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("row"), letters_only().alias("letters")).mapInArrow(run, docs.schema)

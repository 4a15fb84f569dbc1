"""Quality rules whose cutoffs come with a guarantee.

Each signal of a text rejects it above a cutoff. All cutoffs together are tightened along one fixed path, from
rejecting nothing on, one level of one signal at a time. Labelled good documents are the
holdout: in every stratum the vectors of cutoffs on the path are tested in order, by an exact binomial test of whether
they reject, jointly, less than ``ALPHA`` of the good documents. The first failure ends the sequence,
which needs no correction; the error ``DELTA`` is split over the strata (Bonferroni). So with
probability 1 - DELTA no stratum loses more than ALPHA of its good documents, whichever certified vector is chosen.

A stratum with too few good labels for any certificate (190 for four strata), or with none, certifies nothing, and only the base rule
rejects there. Good documents that the base rule fails are outside the guarantee.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import SPACE, stage, whole

#: Share of good documents a stratum may lose, and the probability that any loses more.
ALPHA, DELTA = 0.02, 0.05
#: A good document lost weighs as much as so many bad ones kept.
PENALTY = 20
#: Signals in percent of their base; the level is the whole part, 100 at most.
SIGNALS = ("symbols", "dup_lines", "repeats", "capitals")
LEVELS = 101
#: The path of cutoffs: each row says where the signals are tightened to, in turn, before the next row. Set by hand
#: from what the signals mean, without a look at the holdout.
STOPS = (
    (30, 60, 45, 70), (20, 50, 40, 60), (15, 40, 35, 50), (10, 30, 30, 40), (7, 20, 25, 30), (5, 15, 20, 25),
    (4, 10, 15, 20), (3, 7, 10, 15), (2, 5, 7, 10), (1, 3, 5, 5), (0, 0, 0, 0),
)
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def with_signals(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals.

    Repeated three-word windows are found inside the row: window hashes with
    the position in their low bits are sorted as numbers, equal neighbours are
    compared word by word, and the positions found are laid out again.
    Null text has no words. Linear but for the sort, whatever the text.
    """
    t = docs.withColumn("_t", whole("text"))
    blank = F.regexp_replace("_t", f"{SPACE}+", "")
    cut = F.btrim(F.col("_t"), F.lit(" \t\n\x0b\x0c\r"))
    t = t.select(
        "*",
        F.when(F.length(cut) == 0, F.array().cast("array<string>")).otherwise(F.split(cut, f"{SPACE}+")).alias("_w"),
        F.length(blank).cast("bigint").alias("word_chars"),
        (F.length(blank) - F.length(F.regexp_replace(blank, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.length(F.regexp_replace(blank, "[^A-Z]+", "")).cast("bigint").alias("n_capitals"),
        F.filter(F.split("_t", "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\x0c\r"))) > 0).alias("_l"),
    ).drop("_t")
    t = t.select(
        "*",
        F.size("_w").cast("bigint").alias("n_words"),
        F.size("_l").cast("bigint").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"),
        F.length(F.bin(F.size("_w").cast("bigint"))).alias("_s"),
    ).drop("_l")
    keys = F.expr(
        "sort_array(if(n_words < 3, cast(array() as array<bigint>), transform(sequence(0L, n_words - 3),"
        " i -> shiftleft(xxhash64(_w[i], _w[i + 1], _w[i + 2]), _s) | i)))"
    )
    t = t.withColumn("_k", keys)
    at = "cast({} & (shiftleft(1L, _s) - 1) as int)"
    same = (
        "shiftright(x, _s) = shiftright({y}, _s)"
        + "".join(f" and _w[{at.format('x')} + {j}] = _w[{at.format('{y}')} + {j}]" for j in range(3))
    )
    found = F.expr(
        f"sort_array(transform(filter(_k, (x, i) -> (i > 0 and {same.format(y='_k[i - 1]')})"
        f" or (i < size(_k) - 1 and {same.format(y='_k[i + 1]')})), x -> {at.format('x')}))"
    )
    t = t.withColumn("_p", found).drop("_k", "_s", "_w")
    covered = F.expr(
        "aggregate(transform(_p, (p, i) -> if(i = size(_p) - 1, 3, least(3, _p[i + 1] - p))), 0L, (a, x) -> a + x)"
    )
    return t.withColumn("n_repeat_words", covered).drop("_p")


def base_failed() -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def levels() -> list[Column]:
    """Levels 0 to 100 of the signals, in the order of SIGNALS."""
    pairs = [
        ("n_symbols", "n_words"),
        ("n_dup_lines", "n_lines"),
        ("n_repeat_words", "n_words"),
        ("n_capitals", "word_chars"),
    ]
    return [
        F.when(F.col(b) > 0, F.least(F.lit(100), F.floor(100 * F.col(a) / F.col(b)))).otherwise(0).cast("int")
        for a, b in pairs
    ]


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Bin(n, p), summed downwards from its largest terms (k < n p in use)."""
    if k < 0:
        return 0.0
    if k >= n:
        return 1.0
    log = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    term = total = 1.0
    for j in range(k, 0, -1):
        term *= j / (n - j + 1) * (1 - p) / p
        total += term
        if term < 1e-17 * total:
            break
    return min(1.0, math.exp(log) * total)


def path() -> list[tuple[int, int]]:
    """(signal, new cutoff) of every step; a text is rejected above a cutoff, and all of them start at the highest level."""
    now, steps = [LEVELS - 1] * len(SIGNALS), []
    for stop in STOPS:
        for signal, level in enumerate(stop):
            steps += [(signal, c) for c in range(now[signal] - 1, level - 1, -1)]
            now[signal] = min(now[signal], level)
    return steps


def first_steps() -> list[list[int]]:
    """Per signal and level the step, from 1, that rejects the level first; one more than all steps if none does."""
    steps = path()
    out = [[len(steps) + 1] * LEVELS for _ in SIGNALS]
    for t, (signal, cutoff) in enumerate(steps, 1):
        out[signal][cutoff + 1] = t
    return out


def certified_step(good: dict[int, int], bad: dict[int, int], alpha: float, delta: float, penalty: float = PENALTY) -> int:
    """The certified step that is worth most, the loosest of equals; 0 rejects nothing.

    ``good`` and ``bad`` count labelled documents by the first step that rejects them.
    """
    n, last = sum(good.values()), len(path())
    lost = list(accumulate(good.get(t, 0) for t in range(1, last + 1)))
    caught = list(accumulate(bad.get(t, 0) for t in range(1, last + 1)))
    best, worth, tested = 0, 0, -1
    for t in range(last):
        if lost[t] != tested:  # else the test is that of the step before
            tested = lost[t]
            if n == 0 or tested >= n * alpha or binomial_cdf(tested, n, alpha) > delta:
                break
        if caught[t] - penalty * lost[t] > worth:
            best, worth = t + 1, caught[t] - penalty * lost[t]
    return best


def measured(docs: DataFrame, stratum: Column | None = None) -> DataFrame:
    """``docs`` with its signals, base_failed, and what :func:`verdict` reads: _step and _stratum."""
    of = F.coalesce(F.col("lang") if stratum is None else stratum, F.lit(""))
    signals = with_signals(docs).withColumn("base_failed", base_failed())
    steps = F.lit(first_steps())
    first = F.least(*[steps[i][level] for i, level in enumerate(levels())])
    return signals.withColumn("_step", first).withColumn("_stratum", of)


def verdict(signals: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> Column:
    """Over rows of :func:`measured`: true where no certified cutoff rejects.

    Labelled good documents that the base rule fails are not counted. Several
    labels of one id: good only if all are.
    """
    mark = labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("_label_id"))
    mark = mark.agg(F.min("quality").alias("_quality"))
    seen = (
        signals.select("doc_id", "_stratum", "_step", "base_failed")
        .join(mark, F.col("doc_id") == F.col("_label_id"))
        .where("not base_failed")
        .groupBy("_stratum", "_step", (F.col("_quality") > 0).alias("good"))
        .agg(F.count("*").alias("n"))
    )
    table: dict = {}
    for r in seen.collect():  # strata x steps rows
        table.setdefault(r["_stratum"], {True: {}, False: {}})[r["good"]][r["_step"]] = r["n"]
    error = delta / max(1, len(table))
    limit = F.lit(0)
    for s, kinds in sorted(table.items()):
        if step := certified_step(kinds[True], kinds[False], alpha, error):
            limit = F.when(F.col("_stratum") == s, step).otherwise(limit)
    return F.col("_step") > limit


def assess(docs: DataFrame, labels: DataFrame, stratum: Column | None = None, **options) -> DataFrame:
    """One row per document: doc_id, the signals, base_failed and kept.

    Strata default to lang, null its own. Null and blank texts have no words
    and fail the base rule. Null ids have no label. Repeated rows count each.
    An empty table gives no rows, and without labels nothing is certified:
    then only the base rule rejects. Other columns are not read.
    """
    signals = stage(measured(docs.select("doc_id", "text", "lang"), stratum).drop("text", "lang"), "quality-signals")
    keep = verdict(signals, labels, **options)
    return signals.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & keep).alias("kept"),
    )


def good_documents(docs: DataFrame, labels: DataFrame, stratum: Column | None = None, **options) -> DataFrame:
    """The documents that pass, with the columns of ``docs``."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    named = docs.select("doc_id", "text", "lang", F.struct(*own).alias("_row"))
    signals = measured(named, stratum)
    narrow = stage(signals.select("doc_id", "base_failed", "_step", "_stratum"), "quality-signals")
    keep = verdict(narrow, labels, **options)
    # the row number holds the filter above the signals; pushed below, it would work them out once per use
    rows = signals.select("_row", "base_failed", "_step", "_stratum", F.monotonically_increasing_id().alias("_nr"))
    return rows.where((F.col("_nr") >= 0) & ~F.col("base_failed") & keep).select("_row.*")

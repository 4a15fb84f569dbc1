"""Mixing sources to target weights by Pareto order sampling.

Each source has a target number of words. A document's expected number of
copies m follows from its source's target and its own inclusion weight; it
gets floor(m) copies for certain and takes part with inclusion probability
pi = m - floor(m) in a draw without replacement. The draw ranks documents by
Q = odds(u) / odds(pi) with u uniform, and takes them in that order while
they fit what the certain copies left of the target (the sample's size is
fixed in words). Past a document that doesn't fit the draw goes on with those that do,
until all free documents are larger than what is open. The smallest of them closes the gap if that brings
the source nearer to its target. So every source ends within half of its smallest free document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.llm.common import id_text, n_words, stage, tie_order, whole

#: Documents in one bin of the draw's histogram, about.
BIN_ROWS = 1_000
MAX_BINS = 1 << 20


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """Per source (source, source_size): its weight and target.

    Sources in code point order, null last, take the weights in turn and share
    the total size by them; targets stop at ``cap`` sizes and the excess is
    shared by weight again until none is above. In order of cap / weight the
    capped sources come first, so the end state is read off running sums.
    The input is one row per source.
    """
    pick = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("nr") % len(weights) + 1).cast("int"))
    s = sizes.withColumn("nr", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    s = s.withColumn("weight", pick.cast("bigint")).withColumn("most", F.col("source_size") * cap)
    line = W.orderBy(F.col("most") / F.col("weight"), "nr")
    before, after = line.rowsBetween(W.unboundedPreceding, -1), line.rowsBetween(0, W.unboundedFollowing)
    everything = W.orderBy("nr").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    level = (total - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.sum("weight").over(after)
    s = s.withColumn("level", level)
    s = s.withColumn("capped", F.col("most") <= F.col("level") * F.col("weight"))
    free = F.min(F.when(~F.col("capped"), F.struct(F.col("most") / F.col("weight"), "nr", "level"))).over(everything)
    return s.select(
        "source",
        "source_size",
        "weight",
        F.when(F.col("capped"), F.col("most").cast("double")).otherwise(free["level"] * F.col("weight")).alias("target"),
    )


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3, seed: str = "mix") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken, row_key.

    Size is the number of words (0 for null text; such documents are never
    copied). The inclusion weight of a document is the number of binary digits
    of its size: longer documents are somewhat likelier. u comes from md5 of
    seed, doc_id and text, so reruns agree on any layout. Sources are split by
    a histogram of the ranks; only the bin at the boundary, about BIN_ROWS
    documents, is sorted. Each pass past a document that doesn't fit leaves less open than that document has
    words. There is one row per source in a task of its own, which is meant for up to some millions of sources. Rows equal in doc_id and text are told apart by
    their place in the table; which of them is taken makes no difference.
    Null sources form one source; a null doc_id counts as "". An empty table
    gives no rows. Other columns are not read.
    """
    h = F.md5(F.concat(F.lit(f"{seed}/"), id_text("doc_id"), F.lit("/"), whole("text")).cast("binary"))
    rows = docs.select(F.col("doc_id"), F.col("source"), n_words("text").alias("size"), h.alias("row_key"))
    u = (F.conv(F.substring("row_key", 1, 12), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(2.0**48)
    rows = rows.select(
        "*",
        F.length(F.bin("size")).alias("digits"),
        u.alias("u"),
        F.monotonically_increasing_id().alias("uid"),
    )
    rows = stage(rows, "mix-rows")
    # one row per source and number of digits, at most 64 per source
    levels = rows.groupBy("source", "digits").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
    sizes = levels.groupBy("source").agg(F.sum("words").alias("source_size"), F.sum("n").alias("n_docs"))
    goals = source_targets(sizes.select("source", "source_size"), weights, cap)
    goals = goals.join(sizes.select(F.col("source").alias("s_"), "n_docs"), F.col("source").eqNullSafe(F.col("s_")))
    goals = goals.drop("s_")
    lv = levels.select(F.col("source").alias("s_"), "digits", "words").join(
        goals, F.col("s_").eqNullSafe(F.col("source"))
    )
    line = W.partitionBy("source").orderBy(F.col("digits").desc())
    capped = F.coalesce(F.sum("words").over(line.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) * cap
    open_ = F.sum(F.col("words") * F.col("digits")).over(line.rowsBetween(0, W.unboundedFollowing))
    alpha = F.when(open_ > 0, (F.col("target") - capped) / open_).otherwise(F.lit(0.0))
    lv = lv.withColumn("alpha", alpha).withColumn("full", F.col("alpha") * F.col("digits") >= cap)
    by_source = W.partitionBy("source")
    free = F.max(F.when(~F.col("full"), F.struct("digits", "alpha"))).over(by_source)
    lv = lv.withColumn(
        "m", F.when(F.col("full"), F.lit(float(cap))).otherwise(F.greatest(free["alpha"], F.lit(0.0)) * F.col("digits"))
    )
    lv = lv.withColumn("certain", F.floor("m").cast("bigint")).withColumn("pi", F.col("m") - F.floor("m"))
    left = F.col("target") - F.sum(F.col("certain") * F.col("words")).over(by_source)
    bins = F.least(F.lit(MAX_BINS), F.ceil(F.col("n_docs") / BIN_ROWS).cast("int"))
    plan = stage(
        lv.select("source", "digits", "source_size", "target", "certain", "pi", left.alias("left"), bins.alias("bins")),
        "mix-plan",
    )
    p = plan.select([F.col(c).alias(f"p_{c}" if c in ("source", "digits") else c) for c in plan.columns])
    d = rows.join(p, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("digits") == F.col("p_digits")))
    odds = F.col("u") * (1 - F.col("pi")) / ((1 - F.col("u")) * F.col("pi"))
    draws = (F.col("pi") > 0) & (F.col("size") > 0)
    d = d.withColumn("q", F.when(draws, odds))
    d = d.withColumn("bin", F.floor(F.col("q") / (1 + F.col("q")) * F.col("bins")).cast("bigint"))
    d = d.drop("p_source", "p_digits", "pi", "u", "digits")
    d = stage(d, "mix-draw")
    # what the draw still lacks of each source; it goes on in the order of ranks past documents that don't fit
    free = d.where("q is not null").select("source", "uid", "size", "q", "row_key", "bin")
    gaps = plan.groupBy("source").agg(F.max("left").alias("gap"))
    drawn = []
    while True:
        fitting = free.join(gaps.select(F.col("source").alias("g_source"), "gap"), F.col("source").eqNullSafe(F.col("g_source")))
        fitting = fitting.where("size <= gap")
        # the first bin that doesn't fit in whole; at most its documents and the gap's words are sorted
        h = fitting.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first("gap").alias("gap"))
        run = F.sum("words").over(W.partitionBy("source").orderBy("bin"))
        h = h.withColumn("run", run).groupBy("source").agg(
            F.min(F.when(F.col("run") > F.col("gap"), F.col("bin"))).alias("cut"),
            F.max(F.when(F.col("run") <= F.col("gap"), F.col("run"))).alias("before"),
        )
        h = stage(h, "mix-cuts").select(F.col("source").alias("h_source"), "cut", F.coalesce("before", F.lit(0)).alias("before"))
        fitting = fitting.join(h, F.col("source").eqNullSafe(F.col("h_source"))).drop("g_source", "h_source")
        whole_bins = fitting.where("cut is null or bin < cut").select("source", "uid", "size")
        run = F.col("before") + F.sum("size").over(W.partitionBy("source").orderBy("q", "row_key", "uid"))
        edge = fitting.where("bin = cut").withColumn("run", run).where("run <= gap").select("source", "uid", "size")
        taken = stage(whole_bins.unionByName(edge), "mix-taken")
        got = taken.groupBy("source").agg(F.sum("size").alias("got")).select(F.col("source").alias("g_source"), "got")
        if got.isEmpty():
            break
        drawn.append(taken)
        gaps = gaps.join(got, F.col("source").eqNullSafe(F.col("g_source")), "left")
        gaps = stage(gaps.select("source", (F.col("gap") - F.coalesce("got", F.lit(0))).alias("gap")), "mix-gaps")
        gone = taken.select(F.col("uid").alias("t_uid"))
        free = stage(free.join(gone, F.col("uid") == F.col("t_uid"), "left_anti"), "mix-free")
    # now every free document is larger than the gap; one closes it if that comes nearer
    close = free.join(gaps.select(F.col("source").alias("g_source"), "gap"), F.col("source").eqNullSafe(F.col("g_source")))
    close = close.where("size < 2 * gap").groupBy("source").agg(F.min(F.struct("size", "q", "row_key", "uid")).alias("best"))
    extra = close.select(F.col("best.uid").alias("e_uid"))
    for taken in drawn:
        extra = extra.unionByName(taken.select(F.col("uid").alias("e_uid")))
    d = d.join(extra.withColumn("drawn", F.lit(1)), F.col("uid") == F.col("e_uid"), "left")
    copies = F.when(F.col("size") == 0, F.lit(0)).otherwise(
        F.col("certain") + F.coalesce("drawn", F.lit(0))
    )
    d = d.withColumn("copies", copies.cast("bigint"))
    return d.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
        "row_key",
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves, each as often as :func:`mix` takes it, with the columns of ``docs``."""
    seed = options.get("seed", "mix")
    h = F.md5(F.concat(F.lit(f"{seed}/"), id_text("doc_id"), F.lit("/"), whole("text")).cast("binary"))
    per_key = mix(docs, **options).groupBy("row_key").agg(F.sum("copies").alias("_c"), F.count("*").alias("_k"))
    per_key = per_key.where("_c > 0").withColumnRenamed("row_key", "_h")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    full = docs.select(row.alias("row"), h.alias("h")).join(per_key, F.col("h") == F.col("_h"))
    # rows equal in id and text share their copies evenly
    nr = F.row_number().over(W.partitionBy("h").orderBy(*tie_order(docs)))
    times = (F.floor(F.col("_c") / F.col("_k")) + F.when(nr <= F.col("_c") % F.col("_k"), 1).otherwise(0)).cast("int")
    full = full.withColumn("n", times).where("n > 0")
    return full.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n")))).select("row.*")

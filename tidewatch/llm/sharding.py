"""Weighted rendezvous sharding.

Every record goes to the shard with the best score for its key. A shard's
score depends on the key and that shard alone, so a new shard takes records
only into itself, and removing one moves its own records only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.llm.common import id_text, stage, whole


def shard_of(key: Column, weights: Sequence[float], seed: str = "shard") -> Column:
    """Index of the winning shard for a string key.

    Shard i draws u = (h + 0.5) / 2^52 from 13 hex digits of md5(seed/i/key)
    and scores ln(u) / weight; the highest wins, the lower index on equality.
    The share of a shard is its weight over the sum. Weights of 0 or less
    take nothing.
    """
    live = [(i, w) for i, w in enumerate(weights) if w > 0]
    if not live:
        raise ValueError("no shard has a positive weight")
    equal = len({w for _, w in live}) == 1
    scores = []
    for i, w in live:
        h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/{i}/"), key)), 1, 13), 16, 10).cast("bigint")
        score = h.cast("double") if equal else F.log((h + F.lit(0.5)) / F.lit(2.0**52)) / F.lit(float(w))
        scores.append(F.struct(score.alias("score"), F.lit(-i).alias("neg")))
    return (-F.array_max(F.array(*scores))["neg"]).cast("int")


def shard_documents(
    docs: DataFrame,
    n_shards: int = 24,
    weights: Sequence[float] | None = None,
    new_weight: float = 1.0,
) -> DataFrame:
    """One row per document: its shard, its slot in the shard, and its shard if one more shard were added.

    Slots are 0, 1, ... within a shard, in order of doc_id (null first), crc
    and size. They come from one range sort and the row counts of its sorted
    partitions, so no task holds a shard; rows equal in all these are told
    apart by a salt, and it doesn't matter which of them gets which slot.

    Null text counts as empty (size 8, crc of nothing). Null ids share the
    key "" and so one shard; repeated ids share a shard by definition.
    Other columns of the input are not read.
    """
    weights = list(weights or [1.0] * n_shards)
    key = id_text("doc_id")
    text = whole("text").cast("binary")
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(text).cast("bigint") + 8).alias("size"),
        F.crc32(text).alias("text_crc32"),
        key.alias("key"),
    )
    rows = rows.select(
        "doc_id",
        "size",
        "text_crc32",
        shard_of(F.col("key"), weights).alias("shard"),
        shard_of(F.col("key"), [*weights, new_weight]).alias("grown_shard"),
        F.xxhash64(F.monotonically_increasing_id()).alias("salt"),
    )
    order = ["shard", "doc_id", "text_crc32", "size", "salt"]
    rows = stage(rows, "shards")
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(
        placed.withColumn("part", F.spark_partition_id()).withColumn("seq", F.monotonically_increasing_id()),
        "slots",
    )
    # one row per sorted partition and shard in it: at most partitions + shards rows
    runs = placed.groupBy("shard", "part").agg(F.min("seq").alias("first"), F.count("*").alias("n"))
    before = W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return placed.join(F.broadcast(runs), ["shard", "part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("before") + F.col("seq") - F.col("first")).alias("slot"),
        "grown_shard",
    )

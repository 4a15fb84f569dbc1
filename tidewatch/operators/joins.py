"""Equi-joins with dimensions, and the name-based port matching.

Nothing here runs before the caller's action, and each side is read once. The
side is not marked for broadcast: Spark broadcasts it where its statistics, or
at run time its measured shuffle size, stay below the session's thresholds, and
otherwise sorts and merges, splitting the partitions of hot keys (NULL
among them) that adaptive execution finds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions.text import name_key


def dimension_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: list[str],
    how: str = "left",
    residual: Column | None = None,
    hint: str | None = None,
) -> DataFrame:
    """Join facts to a dimension on equally named keys; the facts' keys are kept.

    ``how`` is inner, left, left_semi or left_anti, all of which can be split
    on the facts' side. ``hint`` names a join strategy for the dimension, such
    as ``merge``; without it Spark chooses.
    """
    side = dim.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    side = side.hint(hint) if hint else side
    condition = F.lit(True) if residual is None else residual
    for k in keys:
        condition = condition & (F.col(k) == F.col(f"_r_{k}"))
    return facts.join(side, condition, how).drop(*[f"_r_{k}" for k in keys])


# --- matching by port name ---------------------------------------------------


def map_alias(vessels: DataFrame, aliases: DataFrame, dedup_aliases: bool = False, **kw) -> DataFrame:
    """Add ``MAPPED_NAME`` for aliased destinations; repeated raw names multiply rows.

    ``dedup_aliases`` keeps one target (the first by name) per raw name.
    """
    seed = aliases.select(name_key("RAW_NAME").alias("_name"), "MAPPED_NAME")
    if dedup_aliases:
        seed = seed.groupBy("_name").agg(F.min("MAPPED_NAME").alias("MAPPED_NAME"))
    keyed = vessels.withColumn("_name", name_key("DESTINATION_PORT_NAME"))
    return dimension_join(keyed, seed, ["_name"], "left", **kw).drop("_name")


def match_port_by_name(vessels: DataFrame, ports: DataFrame, name: str = "MAIN_PORT_NAME", **kw) -> DataFrame:
    """Left join on the mapped (else raw) destination name; port columns must not clash."""
    keyed = vessels.withColumn("_name", name_key(F.coalesce("MAPPED_NAME", "DESTINATION_PORT_NAME")))
    side = ports.withColumn("_name", name_key(name)).drop(name)
    return dimension_join(keyed, side, ["_name"], "left", **kw).drop("_name")


def match_port_by_name_country(
    vessels: DataFrame, ports: DataFrame, name: str = "MAIN_PORT_NAME", country: str = "COUNTRY_CODE", **kw
) -> DataFrame:
    """As :func:`match_port_by_name`, but a stated country must agree as well."""
    side = ports.withColumn("_country", name_key(country)).drop(country)
    stated = F.col("DESTINATION_PORT_COUNTRY")
    agrees = stated.isNull() | (name_key(stated) == F.col("_country"))
    return match_port_by_name(vessels, side, name, residual=agrees, **kw).drop("_country")


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: list[str], **kw) -> DataFrame:
    """Target plus the rows whose key it lacks."""
    absent = dimension_join(rows, target.select(*keys).distinct(), keys, "left_anti", **kw)
    return target.unionByName(absent, allowMissingColumns=True)


def delete_by_key(target: DataFrame, doomed: DataFrame, keys: list[str], **kw) -> DataFrame:
    """Target without the rows of the given keys; a NULL key matches nothing."""
    return dimension_join(target, doomed.select(*keys).distinct(), keys, "left_anti", **kw)


def attach_risk(ports: DataFrame, risk: DataFrame, **kw) -> DataFrame:
    """Add ``MAX_RISK_SCORE`` by port name, 0 where no event was near.

    Risk is reduced to one row per normalised name first, so same-named rows
    share a risk and never multiply.
    """
    per_name = risk.groupBy(name_key("PORT_NAME").alias("_name")).agg(F.max("MAX_RISK_SCORE").alias("MAX_RISK_SCORE"))
    keyed = ports.withColumn("_name", name_key("MAIN_PORT_NAME"))
    joined = dimension_join(keyed, per_name, ["_name"], "left", **kw)
    return joined.withColumn("MAX_RISK_SCORE", F.coalesce("MAX_RISK_SCORE", F.lit(0.0))).drop("_name")


def lookup_sk(
    events: DataFrame, ports: DataFrame, event_dim: DataFrame, port_dim: DataFrame,
    pair: Callable[[DataFrame, DataFrame], DataFrame],
) -> DataFrame:
    """Event-port pairs as ``pair`` makes them from the two sides, with both surrogate keys; same-named ports fan out.

    Both keys are looked up on the sides, so the pairs, which are many times as many as events and
    ports, are neither shuffled nor sorted. A port takes the keys of its name along as lists, which become rows at the end.
    """
    keyed = events.join(event_dim.select("EVENT_ID", "SEISMIC_EVENT_SK"), "EVENT_ID", "left")
    named = ports.withColumn("_name", name_key("PORT_NAME"))
    listed = dimension_join(named, _keys_by_name(port_dim), ["_name"], "left").drop("_name")
    return pair(keyed, listed).withColumn("PORT_SK", F.explode_outer("_keys")).drop("_keys")


KEY_LIST = 100  # port keys in one list; a name of more ports has several


def _keys_by_name(port_dim: DataFrame) -> DataFrame:
    """The port keys of each name in lists of bounded length."""
    ports = port_dim.select(name_key("MAIN_PORT_NAME").alias("_name"), "PORT_SK").filter(F.col("_name").isNotNull())
    number = F.row_number().over(W.partitionBy("_name").orderBy("PORT_SK")) - 1
    part = ports.withColumn("_part", F.floor(number / KEY_LIST)).groupBy("_name", "_part")
    # collected as structs, as a list leaves NULL out
    return part.agg(F.collect_list(F.struct("PORT_SK")).alias("_keys")).select("_name", F.col("_keys.PORT_SK").alias("_keys"))

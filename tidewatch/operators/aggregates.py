"""Grouped statistics, rolling averages and scalar watermarks.

Group keys may be hot: every aggregate here has a partial step before the
shuffle, and the rolling window runs on rows already reduced to region-days.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.functions.seismic import intensity_bucket
from tidewatch.functions.text import parse_best_effort
from tidewatch.operators.filters import within_lookback
from tidewatch.operators.joins import dimension_join

C = F.col


def daily_region_stats(events: DataFrame) -> DataFrame:
    """Per day and region: events, mean and highest magnitude, intensity index.

    The index counts 2 for a major event and 1 for any other, so it is also a
    count: six events of any size exceed 5.
    """
    return events.groupBy(F.date_trunc("day", "EARTHQUAKE_TIME").alias("EVENT_DATE"), "REGION").agg(
        F.count("EVENT_ID").alias("TOTAL_EVENTS"),
        F.avg("MAGNITUDE").alias("AVG_MAGNITUDE"),
        F.max("MAGNITUDE").alias("MAX_MAGNITUDE"),
        F.sum(F.when(C("MAGNITUDE") >= 7, 2).otherwise(1)).alias("SEISMIC_INTENSITY_INDEX"),
    )


def rolling_rows_avg(stats: DataFrame, rows: int = fixed.ROLLING_ROWS, calendar: bool = False) -> DataFrame:
    """Mean event count over the region's last event days (days without events do not count).

    ``calendar`` averages over the same number of calendar days instead, again
    over the days that have events.
    """
    if calendar:
        day = F.unix_date(F.to_date("EVENT_DATE"))
        frame = Window.partitionBy("REGION").orderBy(day).rangeBetween(-(rows - 1), 0)
    else:
        frame = Window.partitionBy("REGION").orderBy("EVENT_DATE").rowsBetween(-(rows - 1), 0)
    return stats.withColumn("ROLLING_7D_AVG_EVENTS", F.avg("TOTAL_EVENTS").over(frame))


Pairs = DataFrame | Callable[[DataFrame], DataFrame]


def recent_pairs(proximity: Pairs, events: DataFrame, as_of: str, days: int = fixed.RISK_LOOKBACK_DAYS) -> DataFrame:
    """Event-port pairs joined by id with the events of the last days.

    ``proximity`` holds the pairs, or makes those of the events it is given. Then the events are joined before they are
    paired, which gives the same rows: pairs, which grow with the square of the size, are not shuffled.
    """
    recent = within_lookback(events.select("EVENT_ID", "EARTHQUAKE_TIME"), "EARTHQUAKE_TIME", as_of, days)
    if isinstance(proximity, DataFrame):
        return proximity.join(recent, "EVENT_ID", "inner")
    # merged, as both sides come sorted by id from the choice of the last versions
    return proximity(dimension_join(events, recent.select("EVENT_ID"), ["EVENT_ID"], "inner", hint="merge"))


def max_port_risk(proximity: Pairs, events: DataFrame, as_of: str, days: int = fixed.RISK_LOOKBACK_DAYS) -> DataFrame:
    """Highest risk per port name over the events of the last days."""
    return risk_by_port(recent_pairs(proximity, events, as_of, days))


def risk_by_port(proximity: DataFrame) -> DataFrame:
    return proximity.groupBy("PORT_NAME").agg(F.max("RISK_SCORE").alias("MAX_RISK_SCORE"))


def intensity_histogram(live: DataFrame) -> DataFrame:
    known = live.filter(C("mag").isNotNull())
    return known.groupBy(intensity_bucket(C("mag")).alias("category")).agg(F.count(F.lit(1)).alias("count"))


def events_per_day(live: DataFrame) -> DataFrame:
    dated = live.filter(C("event_time").isNotNull())
    day = F.to_date(parse_best_effort("event_time"))
    return dated.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("earthquakes"))


def magnitude_series(live: DataFrame, ordered: bool = False) -> DataFrame:
    """Time and magnitude of every dated version.

    ``ordered`` sorts by time and then source id, so that a second with very
    many rows can still be cut into several sort ranges.
    """
    dated = live.filter(C("event_time").isNotNull()).withColumn("time", parse_best_effort("event_time"))
    if ordered:
        dated = dated.orderBy(C("time").asc_nulls_last(), C("source_id").asc_nulls_last())
    return dated.select("time", C("mag").alias("magnitude"))


def strongest_events(live: DataFrame, n: int = fixed.STRONGEST_SHOWN) -> DataFrame:
    """The n strongest rows; unknown magnitudes last, source id breaks ties."""
    top = live.orderBy(C("mag").desc_nulls_last(), C("source_id").asc_nulls_last()).limit(n)
    return top.select(
        "source_id", parse_best_effort("event_time").alias("time"), C("flynn_region").alias("location"),
        C("mag").alias("magnitude"), "depth",
    )


def high_watermark(df: DataFrame, column: str) -> datetime | None:
    """Largest value as a driver scalar; None for an empty table."""
    return df.agg(F.max(column)).first()[0]


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing count and percentage per column, in one pass over the data."""
    missing = [F.count_if(C(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(columns)]
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *missing)
    entry = [F.struct(F.lit(c).alias("column"), C(f"n{i}").alias("missing")) for i, c in enumerate(columns)]
    return counted.select("rows", F.explode(F.array(*entry)).alias("e")).select(
        "e.column", "rows", "e.missing", (C("e.missing") * 100.0 / F.nullif(C("rows"), F.lit(0))).alias("missing_pct")
    )


def distinct_vessels(recommendations: DataFrame) -> DataFrame:
    return recommendations.agg(
        F.count(F.lit(1)).alias("recommendations"), F.countDistinct("VESSEL_NAME").alias("vessels")
    )


def date_spine(spark, start: str, end: str) -> DataFrame:
    """One row per day from start to the day before end."""
    days = F.sequence(F.lit(start).cast("date"), F.date_sub(F.lit(end).cast("date"), 1))
    return spark.range(1).select(F.explode(days).alias("FULL_DATE"))

"""Row filters and column selections of the cleaned and live tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.functions.dates import stamp
from tidewatch.functions.text import parse_best_effort

C = F.col


def named_only(df: DataFrame, name: str = "NAME") -> DataFrame:
    return df.filter(C(name).isNotNull())


def drop_soft_deleted(df: DataFrame) -> DataFrame:
    """Batch form: only rows marked ``false`` or not marked."""
    return df.filter(F.coalesce("__deleted", F.lit("false")) == "false")


def drop_soft_deleted_live(df: DataFrame) -> DataFrame:
    """Live form: every row but those marked ``true``."""
    return df.filter(C("__deleted").isNull() | (C("__deleted") != "true"))


def active_only(df: DataFrame) -> DataFrame:
    return df.filter(C("REPORTED_STATUS").isin(fixed.ACTIVE_STATUSES))


def valid_ports(df: DataFrame) -> DataFrame:
    return df.filter("IS_VALID_COORDINATES")


def mapped_points(live: DataFrame) -> DataFrame:
    """Points for a map: rows with both coordinates, under display names."""
    return live.filter(C("lat").isNotNull() & C("lon").isNotNull()).select(
        C("lat").alias("latitude"), C("lon").alias("longitude"), C("mag").alias("magnitude"),
        C("flynn_region").alias("title"),
    )


def strong_event_alerts(live: DataFrame, threshold: float = fixed.ALERT_MAGNITUDE) -> DataFrame:
    return mapped_points(live).filter(C("magnitude") >= threshold)


def within_lookback(df: DataFrame, when: str, as_of: str, days: int = fixed.RISK_LOOKBACK_DAYS) -> DataFrame:
    return df.filter(C(when) >= stamp(as_of) - F.expr(f"INTERVAL {int(days)} DAYS"))


def above_watermark(df: DataFrame, ingested: str, watermark: datetime | None) -> DataFrame:
    """Rows ingested after the watermark; with none (an empty target) all rows."""
    return df if watermark is None else df.filter(C(ingested) > F.lit(watermark))


def below_risk_cutoff(df: DataFrame, cutoff: float = fixed.RISK_CUTOFF) -> DataFrame:
    return df.filter(F.coalesce("MAX_RISK_SCORE", F.lit(0.0)) < cutoff)


def time_range(live: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Live rows of the last days, as a dashboard's time range selects them."""
    return within_lookback(live.withColumn("_at", parse_best_effort("event_time")), "_at", as_of, days).drop("_at")


def conform(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns in this order; absent ones as NULL text, others dropped."""
    have = set(df.columns)

    def pick(name: str) -> Column:
        return C(f"`{name}`") if name in have else F.lit(None).cast("string").alias(name)

    return df.select([pick(c) for c in columns])

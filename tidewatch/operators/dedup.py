"""Top rows per key.

All of them are a ``row_number() <= n`` filter, which Spark turns into a
partial group limit before the shuffle: a hot key sends at most n rows per
map task. Orders state their NULL placement and end in a unique column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch import fixed

C = F.col


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    position = rank or "_position"
    ranked = df.withColumn(position, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(C(position) <= n)
    return kept if rank else kept.drop(position)


def latest_vessel_reports(df: DataFrame) -> DataFrame:
    """One row per name and report time: last ingested, then smallest link."""
    order = [C("_INGESTED_AT").desc_nulls_last(), C("DETAIL_LINK").asc_nulls_last()]
    return top_per_key(df, ["NAME", "REPORT_DATE"], order)


def first_port_records(df: DataFrame) -> DataFrame:
    """One row per port index: lowest object id; the newest load breaks a tie."""
    order = [C("OID_").asc_nulls_last()]
    if "_LOADED_AT" in df.columns:
        order.append(C("_LOADED_AT").desc_nulls_last())
    return top_per_key(df, ["WORLD_PORT_INDEX_NUMBER"], order)


def latest_events(df: DataFrame, key: str = "EVENT_ID") -> DataFrame:
    """One row per event: last update (an unknown update time counts as newest)."""
    order = [C("LAST_UPDATED_AT").desc_nulls_first(), C("SOURCE_ID").desc_nulls_last()]
    return top_per_key(df, [key], order)


def one_voyage_per_report(df: DataFrame, then: list[Column] | None = None) -> DataFrame:
    """One row per name and report time: the largest port key, then the link, then ``then``."""
    order = [C("DESTINATION_PORT_SK").desc_nulls_last(), C("DETAIL_LINK").asc_nulls_last()]
    return top_per_key(df, ["NAME", "REPORT_DATE"], order + (then or []))


def active_vessels(df: DataFrame) -> DataFrame:
    """Latest report per vessel among those reported under way.

    The status filter comes first: an old report under way beats a newer
    moored one.
    """
    active = df.filter(C("REPORTED_STATUS").isin(fixed.ACTIVE_STATUSES) & C("NAME").isNotNull())
    return top_per_key(active, ["NAME"], [C("REPORT_DATE").desc_nulls_first(), C("DETAIL_LINK").asc_nulls_last()])


def top_n_per_vessel(df: DataFrame, n: int = fixed.TOP_PORTS) -> DataFrame:
    """Best n ports per vessel with their rank; the port index breaks ties."""
    order = [C("FINAL_SCORE").desc_nulls_last(), C("WORLD_PORT_INDEX_NUMBER").asc_nulls_last()]
    return top_per_key(df, ["NAME"], order, n, rank="RANK")

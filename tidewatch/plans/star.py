"""Star schema: dimensions and facts with hashed keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.functions import dates, keys, ports, seismic
from tidewatch.functions.text import name_key
from tidewatch.operators import dedup, joins
from tidewatch.operators.aggregates import date_spine
from tidewatch.plans.gold import keyed_proximity

C = F.col


def dim_date(spark: SparkSession, start: str = fixed.CALENDAR_START, end: str = fixed.CALENDAR_END) -> DataFrame:
    """One row per calendar day; the end day is not part of it."""
    day = C("FULL_DATE")
    return date_spine(spark, start, end).select(
        dates.date_sk(day).alias("DATE_SK"),
        day,
        F.year(day).alias("YEAR"),
        F.month(day).alias("MONTH"),
        F.dayofmonth(day).alias("DAY"),
        F.weekofyear(day).alias("WEEK_OF_YEAR"),
        F.quarter(day).alias("QUARTER"),
        F.dayname(day).alias("DAY_NAME"),
        F.monthname(day).alias("MONTH_NAME"),
        F.trunc(day, "month").alias("MONTH_START_DATE"),
        F.trunc(day, "year").alias("YEAR_START_DATE"),
    )


_DIM_PORT_BASE = [
    "UN_LOCODE", "MAIN_PORT_NAME", "ALTERNATE_PORT_NAME", "COUNTRY_CODE", "REGION_NAME", "WORLD_WATER_BODY",
    "LATITUDE", "LONGITUDE", "IS_VALID_COORDINATES", "HARBOR_SIZE", "HARBOR_TYPE", "HARBOR_USE", "SHELTER_AFFORDED",
    "PORT_DEPTH_CLASS", *fixed.GOLD_PORT_MEASURES, "ENTRANCE_RESTRICTION_TIDE", "ENTRANCE_RESTRICTION_HEAVY_SWELL",
    "ENTRANCE_RESTRICTION_ICE", "PORT_SECURITY", "FIRST_PORT_OF_ENTRY",
]
_DIM_PORT_FACILITIES = [
    "PORT_PRIMARY_TYPE", *fixed.FACILITY_FLAGS, "CRANES_CONTAINER", "DRY_DOCK_SIZE", "REPAIR_CAPABILITY",
]
_DIM_PORT_SUPPLY = [
    *fixed.SUPPLY_FLAGS, *fixed.COMMUNICATION_FLAGS, "SUPPLY_SCORE", "SUPPLY_RATING", "COMMUNICATION_SCORE",
    "COMMUNICATION_RATING", "OVERALL_PORT_SCORE",
]


def port_dimension(gold: DataFrame, facilities: DataFrame, supply: DataFrame) -> DataFrame:
    """Port attributes with facilities and supplies joined on the index number."""
    key = "WORLD_PORT_INDEX_NUMBER"
    return (
        gold.select(key, *_DIM_PORT_BASE)
        .join(facilities.select(key, *_DIM_PORT_FACILITIES), key, "left")
        .join(supply.select(key, *_DIM_PORT_SUPPLY), key, "left")
    )


def port_attributes(gold: DataFrame) -> DataFrame:
    """As :func:`port_dimension`, from the gold ports alone: facilities and supplies follow from the same row."""
    flags = {**ports.facility_bits(), **ports.supply_bits(), **ports.communication_bits()}
    one = gold.select(
        "WORLD_PORT_INDEX_NUMBER",
        *_DIM_PORT_BASE,
        *[c.alias(name) for name, c in flags.items()],
        "CRANES_CONTAINER",
        F.coalesce("DRY_DOCK", F.lit("None")).alias("DRY_DOCK_SIZE"),
        F.coalesce("REPAIRS", F.lit("None")).alias("REPAIR_CAPABILITY"),
        "SUPPLY_SCORE",
        "SUPPLY_RATING",
        "COMMUNICATION_SCORE",
        "COMMUNICATION_RATING",
        (C("SUPPLY_SCORE") + C("COMMUNICATION_SCORE")).alias("OVERALL_PORT_SCORE"),
    ).withColumn("PORT_PRIMARY_TYPE", ports.primary_type())
    return one.select("WORLD_PORT_INDEX_NUMBER", *_DIM_PORT_BASE, *_DIM_PORT_FACILITIES, *_DIM_PORT_SUPPLY)


def _port_keys(attributes: DataFrame, as_of: str) -> DataFrame:
    key = keys.surrogate_key(keys.index_text("WORLD_PORT_INDEX_NUMBER"))
    return attributes.withColumns({"PORT_SK": key, "DIM_LOADED_AT": dates.stamp(as_of)})


def dim_port_of(gold: DataFrame, as_of: str) -> DataFrame:
    """The port dimension in one pass over the gold ports."""
    return _port_keys(port_attributes(gold), as_of)


def dim_port(gold: DataFrame, facilities: DataFrame, supply: DataFrame, as_of: str) -> DataFrame:
    """The port dimension from the three stored tables."""
    return _port_keys(port_dimension(gold, facilities, supply), as_of)


def dim_seismic_event(events: DataFrame, as_of: str) -> DataFrame:
    when = C("EARTHQUAKE_TIME")
    return events.withColumns(
        {
            "SEISMIC_EVENT_SK": keys.surrogate_key(C("EVENT_ID")),
            "EVENT_DATE": F.date_trunc("day", when),
            "EVENT_MONTH": F.date_trunc("month", when),
            "EVENT_YEAR": F.year(when),
            "EVENT_HOUR": F.hour(when),
            "DIM_LOADED_AT": dates.stamp(as_of),
        }
    )


def fact_daily_seismic(daily: DataFrame, as_of: str) -> DataFrame:
    day = C("EVENT_DATE")
    return daily.withColumns(
        {
            "DAILY_SEISMIC_SK": keys.surrogate_key(keys.stamp_text(day), C("REGION")),
            "DATE_SK": dates.date_sk(F.to_date(day)),
            "EVENT_MONTH": F.date_trunc("month", day),
            "EVENT_YEAR": F.year(day),
            "EVENT_WEEK": F.weekofyear(day),
            "DAILY_RISK_SCORE": seismic.daily_risk_score(C("DAILY_RISK_LEVEL")),
            "FACT_LOADED_AT": dates.stamp(as_of),
        }
    )


def fact_seismic_port_proximity(
    events: DataFrame, silver_ports: DataFrame, event_dim: DataFrame, port_dim: DataFrame, as_of: str
) -> DataFrame:
    """Event-port pairs with both dimension keys; same-named ports fan out."""
    joined = keyed_proximity(events, silver_ports, event_dim, port_dim)
    metres = F.round(C("DISTANCE_KM") * 1000, 0).cast("bigint")  # text form of the distance in the key
    return joined.select(
        keys.surrogate_key(C("EVENT_ID"), C("PORT_SK"), metres).alias("PROXIMITY_SK"),
        "PROXIMITY_ID", "SEISMIC_EVENT_SK", "PORT_SK", "EVENT_ID", "PORT_NAME", "DISTANCE_KM", "RISK_SCORE",
        seismic.risk_band(C("RISK_SCORE")).alias("RISK_BAND"),
        dates.stamp(as_of).alias("FACT_LOADED_AT"),
    )


_VOYAGE_DROPPED = [
    "DEST_PORT_INDEX_NUMBER", "DEST_PORT_COUNTRY_CODE", "IS_ARRIVED", "IS_VALID_COORDINATES", "MAPPED_NAME",
]


def fact_vessel_voyage(details: DataFrame, port_dim: DataFrame, aliases: DataFrame, as_of: str) -> DataFrame:
    """One row per vessel name and report time with the destination port key.

    Of several matching ports the largest key wins, so the dimension is first
    reduced to that key per name and country. Where the details hold several
    rows for the report, those of the winning port come first.
    """
    side = (
        port_dim.groupBy(name_key("MAIN_PORT_NAME").alias("MAIN_PORT_NAME"), name_key("COUNTRY_CODE").alias("COUNTRY_CODE"))
        .agg(F.max(F.struct("PORT_SK", "WORLD_PORT_INDEX_NUMBER")).alias("_top"))
        .select(
            "MAIN_PORT_NAME", "COUNTRY_CODE", C("_top.PORT_SK").alias("DESTINATION_PORT_SK"),
            C("_top.WORLD_PORT_INDEX_NUMBER").alias("_index"),
        )
    )
    matched = joins.match_port_by_name_country(joins.map_alias(details, aliases), side)
    one = dedup.one_voyage_per_report(
        matched, [C("_index").eqNullSafe(C("DEST_PORT_INDEX_NUMBER")).desc(), C("DEST_PORT_INDEX_NUMBER").asc_nulls_last()]
    ).drop("_index", *_VOYAGE_DROPPED)
    return one.withColumns(
        {
            "VOYAGE_SK": keys.surrogate_key(C("NAME"), keys.stamp_text("REPORT_DATE")),
            "DATE_SK": dates.date_sk(F.to_date("REPORT_DATE")),
            "FACT_LOADED_AT": dates.stamp(as_of),
        }
    ).withColumnsRenamed({"NAME": "VESSEL_NAME", "TYPE": "VESSEL_TYPE"})

"""Enriched tables built on the cleaned ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.functions import dates, keys, ports, seismic, vessels
from tidewatch.operators import aggregates, joins
from tidewatch.operators.filters import valid_ports
from tidewatch.operators.proximity import proximity_join

C = F.col


def gold_vessels(silver: DataFrame, as_of: str) -> DataFrame:
    """Vessel reports with age, size, voyage status and status flags."""
    status = C("REPORTED_STATUS")
    passed_on = silver.drop("_INGESTED_AT").withColumnsRenamed(
        {"DESTINATION_LAT": "DESTINATION_PORT_LAT", "DESTINATION_LON": "DESTINATION_PORT_LON"}
    )
    return passed_on.withColumns(
        {
            "LATEST_ARRIVAL_DATE": F.coalesce("ACTUAL_ARRIVAL_DATE", "ESTIMATED_ARRIVAL_DATE"),
            "VESSEL_AGE": vessels.vessel_age(C("YEAR_BUILT"), as_of),
            "SIZE_CATEGORY": vessels.size_category(C("DEADWEIGHT")),
            "HAS_VALID_DESTINATION": C("DESTINATION_PORT_NAME").isNotNull(),
            "DAYS_SINCE_DEPARTURE": dates.days_between(C("DEPARTURE_DATE"), C("REPORT_DATE")),
            "VOYAGE_STATUS": vessels.voyage_status(as_of),
            "IS_ANCHORED": vessels.status_has("anchor", status),
            "IS_MOORED": vessels.status_has("moor", status),
            "IS_UNDERWAY": vessels.status_has("under way", status)
            | vessels.status_has("underway", status)
            | vessels.status_has("sailing", status),
        }
    ).withColumn("AGE_CATEGORY", vessels.age_category(C("VESSEL_AGE")))


def gold_ports(silver: DataFrame) -> DataFrame:
    """Ports with supply, communication and depth ratings."""
    kept = silver.select(
        "WORLD_PORT_INDEX_NUMBER", *fixed.PORT_TEXT_KEPT, "LATITUDE", "LONGITUDE", "IS_VALID_COORDINATES",
        *fixed.GOLD_PORT_MEASURES, *fixed.GOLD_PORT_CATEGORIES,
    )
    scored = kept.withColumns(
        {
            "SUPPLY_SCORE": ports.total(ports.supply_bits()),
            "COMMUNICATION_SCORE": ports.total(ports.communication_bits()),
        }
    )
    return scored.withColumns(
        {
            "SUPPLY_RATING": ports.rating(C("SUPPLY_SCORE"), 5, 3),
            "COMMUNICATION_RATING": ports.rating(C("COMMUNICATION_SCORE"), 4, 3),
            "PORT_DEPTH_CLASS": ports.depth_class(C("CARGO_PIER_DEPTH_M"), C("CHANNEL_DEPTH_M")),
        }
    )


_PORT_HEAD = [
    "WORLD_PORT_INDEX_NUMBER", "MAIN_PORT_NAME", "COUNTRY_CODE", "REGION_NAME", "HARBOR_SIZE", "PORT_DEPTH_CLASS",
    "IS_VALID_COORDINATES", "LATITUDE", "LONGITUDE",
]
_SCORES = ["SUPPLY_SCORE", "SUPPLY_RATING", "COMMUNICATION_SCORE", "COMMUNICATION_RATING"]


def gold_port_supply_details(gold: DataFrame) -> DataFrame:
    """Supply and communication flags per port with their sums."""
    flags = {**ports.supply_bits(), **ports.communication_bits()}
    return gold.select(
        *_PORT_HEAD,
        *[c.alias(name) for name, c in flags.items()],
        *_SCORES,
        (C("SUPPLY_SCORE") + C("COMMUNICATION_SCORE")).alias("OVERALL_PORT_SCORE"),
    )


def gold_port_infrastructure_facilities(gold: DataFrame) -> DataFrame:
    """Facility flags per port and the kind of port they make."""
    flagged = gold.select(
        *_PORT_HEAD,
        *[c.alias(name) for name, c in ports.facility_bits().items()],
        "CRANES_CONTAINER",
        F.coalesce("DRY_DOCK", F.lit("None")).alias("DRY_DOCK_SIZE"),
        F.coalesce("REPAIRS", F.lit("None")).alias("REPAIR_CAPABILITY"),
    )
    return flagged.withColumn("PORT_PRIMARY_TYPE", ports.primary_type())


# name in the enriched table -> gold port column
_DESTINATION = {
    "DEST_PORT_INDEX_NUMBER": "WORLD_PORT_INDEX_NUMBER",
    "DEST_PORT_COUNTRY_CODE": "COUNTRY_CODE",
    "DEST_HARBOR_SIZE": "HARBOR_SIZE",
    "DEST_PORT_DEPTH_CLASS": "PORT_DEPTH_CLASS",
    "DEST_CARGO_PIER_DEPTH_M": "CARGO_PIER_DEPTH_M",
    "DEST_MAX_VESSEL_LENGTH_M": "MAXIMUM_VESSEL_LENGTH_M",
    "DEST_MAX_VESSEL_DRAFT_M": "MAXIMUM_VESSEL_DRAFT_M",
    "DEST_SUPPLY_RATING": "SUPPLY_RATING",
    "DEST_SUPPLY_SCORE": "SUPPLY_SCORE",
    "DEST_COMMUNICATION_RATING": "COMMUNICATION_RATING",
    "DEST_CONTAINER_FACILITY": "FACILITIES_CONTAINER",
    "DEST_OIL_TERMINAL": "FACILITIES_OIL_TERMINAL",
    "DEST_LIQUID_BULK": "FACILITIES_LIQUID_BULK",
}


def gold_vessels_with_port_details(
    gold_vessels_: DataFrame, gold_ports_: DataFrame, aliases: DataFrame, as_of: str, dedup_aliases: bool = False
) -> DataFrame:
    """Vessel reports with the matched destination port.

    Repeated aliases and same-named ports give one row each; the voyage fact
    reduces them again.
    """
    side = gold_ports_.select(
        "MAIN_PORT_NAME", C("LATITUDE").alias("_lat"), C("LONGITUDE").alias("_lon"),
        *[C(source).alias(name) for name, source in _DESTINATION.items()],
    )
    mapped = joins.map_alias(gold_vessels_, aliases, dedup_aliases)
    matched = joins.match_port_by_name(mapped, side).drop("MAPPED_NAME")
    found = C("DEST_PORT_INDEX_NUMBER").isNotNull()
    at_rest = C("IS_MOORED") | C("IS_ANCHORED")
    arrived_label = vessels.flag(C("VOYAGE_STATUS").isin("Arrived / At Berth", "At Port"))
    own_lat = C("DESTINATION_PORT_LAT").isNotNull()
    return (
        matched.withColumns(
            {
                "HAS_VALID_DESTINATION": C("DESTINATION_PORT_NAME").isNotNull() & (found | own_lat),
                "IS_ARRIVED": C("ACTUAL_ARRIVAL_DATE").isNotNull() | (found & at_rest) | arrived_label,
                "DESTINATION_PORT_FOUND": found,
                "VESSEL_STATUS": vessels.activity(C("REPORT_DATE"), as_of),
                "DESTINATION_PORT_LAT": F.coalesce("DESTINATION_PORT_LAT", "_lat"),
                "DESTINATION_PORT_LON": F.coalesce("DESTINATION_PORT_LON", "_lon"),
            }
        )
        .withColumn(
            "IS_VALID_COORDINATES", C("DESTINATION_PORT_LAT").isNotNull() & C("DESTINATION_PORT_LON").isNotNull()
        )
        .drop("_lat", "_lon")
    )


def gold_seismic_events(silver: DataFrame) -> DataFrame:
    return silver.select(
        "EVENT_ID", "REGION", "MAGNITUDE", "DEPTH_KM", "EARTHQUAKE_TIME", "LATITUDE", "LONGITUDE",
        seismic.magnitude_class(C("MAGNITUDE")).alias("MAGNITUDE_CLASS"),
    )


def proximity_sides(events: DataFrame, silver_ports_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What the pairs need of the events and of the ports."""
    side = valid_ports(silver_ports_).select(
        "WORLD_PORT_INDEX_NUMBER", C("MAIN_PORT_NAME").alias("PORT_NAME"),
        C("LATITUDE").alias("PORT_LATITUDE"), C("LONGITUDE").alias("PORT_LONGITUDE"),
    )
    return events.select("EVENT_ID", "MAGNITUDE", "DEPTH_KM", "LATITUDE", "LONGITUDE"), side


def pair_up(events: DataFrame, ports_: DataFrame, **kw) -> DataFrame:
    """Pairs within 500 km of the two sides, with their id, distance and risk."""
    return proximity_join(events, ports_, **kw).withColumns(
        {
            "PROXIMITY_ID": keys.pair_id("EVENT_ID", "WORLD_PORT_INDEX_NUMBER"),
            "RISK_SCORE": seismic.risk_score(C("MAGNITUDE"), C("DEPTH_KM"), C("DISTANCE_KM")),
        }
    )


def gold_seismic_port_proximity(events: DataFrame, silver_ports_: DataFrame, **kw) -> DataFrame:
    """Event-port pairs within 500 km with distance and risk."""
    return pair_up(*proximity_sides(events, silver_ports_), **kw).select(
        "PROXIMITY_ID", "EVENT_ID", "MAGNITUDE", "PORT_NAME", "DISTANCE_KM", "RISK_SCORE"
    )


def keyed_proximity(events: DataFrame, silver_ports_: DataFrame, event_dim: DataFrame, port_dim: DataFrame, **kw) -> DataFrame:
    """The same pairs with the surrogate keys of both dimensions; same-named ports fan out."""
    sides = proximity_sides(events, silver_ports_)
    return joins.lookup_sk(*sides, event_dim, port_dim, lambda e, p: pair_up(e, p, **kw)).select(
        "PROXIMITY_ID", "SEISMIC_EVENT_SK", "PORT_SK", "EVENT_ID", "PORT_NAME", "DISTANCE_KM", "RISK_SCORE"
    )


def daily_aggregated_seismic_events(events: DataFrame, ordered: bool = False) -> DataFrame:
    """Per day and region: counts, magnitudes, rolling mean and risk level.

    The risk level uses the unrounded means. ``ordered`` sorts newest first,
    which a stored table does not keep.
    """
    daily = daily_of(aggregates.rolling_rows_avg(aggregates.daily_region_stats(events)))
    return newest_first(daily) if ordered else daily


def daily_of(rolled: DataFrame) -> DataFrame:
    """Daily rows of region-days with their rolling mean."""
    level = seismic.daily_risk_level(
        C("MAX_MAGNITUDE"), C("SEISMIC_INTENSITY_INDEX"), C("TOTAL_EVENTS"), C("ROLLING_7D_AVG_EVENTS")
    )
    return rolled.select(
        "EVENT_DATE", "REGION", "TOTAL_EVENTS",
        F.round("AVG_MAGNITUDE", 2).alias("AVG_MAGNITUDE"),
        "MAX_MAGNITUDE",
        F.round("ROLLING_7D_AVG_EVENTS", 1).alias("ROLLING_7D_AVG_EVENTS"),
        level.alias("DAILY_RISK_LEVEL"),
    )


def newest_first(daily: DataFrame) -> DataFrame:
    return daily.orderBy(C("EVENT_DATE").desc(), C("REGION").asc_nulls_last())

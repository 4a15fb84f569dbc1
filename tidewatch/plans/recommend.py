"""Port recommendations for the vessels under way."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.functions import dates, geo, ports, vessels
from tidewatch.operators import aggregates, joins
from tidewatch.operators.compatible import top_compatible
from tidewatch.operators.dedup import active_vessels
from tidewatch.operators.filters import below_risk_cutoff, valid_ports, within_lookback
from tidewatch.plans import gold
from tidewatch.sources.writers import staged

C = F.col


def scoring_ports(gold_ports: DataFrame, facilities: DataFrame) -> DataFrame:
    """Ports with valid coordinates and their facility flags; absent values get neutral defaults."""
    side = facilities.select("WORLD_PORT_INDEX_NUMBER", *fixed.FACILITY_FLAGS, "PORT_PRIMARY_TYPE")
    return _with_defaults(valid_ports(gold_ports).join(side, "WORLD_PORT_INDEX_NUMBER", "left"))


def scoring_ports_of(gold_ports: DataFrame) -> DataFrame:
    """As :func:`scoring_ports`, from the gold ports alone: the flags follow from the same row."""
    flags = [c.alias(name) for name, c in ports.facility_bits().items()]
    sizes = {"DRY_DOCK_SIZE": "DRY_DOCK", "REPAIR_CAPABILITY": "REPAIRS"}
    kinds = [F.coalesce(c, F.lit("None")).alias(name) for name, c in sizes.items()]
    flagged = valid_ports(gold_ports).select("*", *flags, *kinds).withColumn("PORT_PRIMARY_TYPE", ports.primary_type())
    return _with_defaults(flagged.drop(*sizes))


def _with_defaults(joined: DataFrame) -> DataFrame:
    defaults = {
        "MAXIMUM_VESSEL_LENGTH_M": fixed.NO_LENGTH_LIMIT,
        "MAXIMUM_VESSEL_BEAM_M": fixed.NO_BEAM_LIMIT,
        "SUPPLY_SCORE": 0,
        "COMMUNICATION_SCORE": 0,
        **dict.fromkeys(fixed.FACILITY_FLAGS, 0),
    }
    return joined.fillna(defaults)


def prepare_ports(scoring: DataFrame, risk: DataFrame, weights: dict | None = None, cutoff: float = fixed.RISK_CUTOFF) -> DataFrame:
    """Attach risk, drop ports at or above the cutoff, and add every score.

    No score depends on a vessel, so all are computed once per port.
    """
    safe = below_risk_cutoff(joins.attach_risk(scoring, risk), cutoff)
    parts = safe.withColumns(
        {
            "SAFETY_SCORE": ports.safety_score(C("SHELTER_AFFORDED"), C("PORT_SECURITY")),
            "DEPTH_SCORE": ports.depth_score(C("PORT_DEPTH_CLASS")),
            "SEISMIC_SAFETY_SCORE": ports.seismic_safety_score(C("MAX_RISK_SCORE")),
        }
    ).withColumn(
        "INFRASTRUCTURE_SCORE", ports.infrastructure_score(C("DEPTH_SCORE"), ports.harbor_size_score(C("HARBOR_SIZE")))
    )
    return parts.withColumn(
        "FINAL_SCORE",
        ports.final_score(
            C("SUPPLY_SCORE"), C("INFRASTRUCTURE_SCORE"), C("SEISMIC_SAFETY_SCORE"), C("COMMUNICATION_SCORE"), weights
        ),
    )


_PORT_OUTPUT = [
    "COUNTRY_CODE", "REGION_NAME", "HARBOR_SIZE", "PORT_DEPTH_CLASS", "LATITUDE", "LONGITUDE", "FINAL_SCORE",
    "INFRASTRUCTURE_SCORE", "SEISMIC_SAFETY_SCORE", "SUPPLY_SCORE", "COMMUNICATION_SCORE", "SAFETY_SCORE",
    "DEPTH_SCORE",
]
_ROUNDED = [
    "FINAL_SCORE", "DISTANCE_KM", "DISTANCE_SCORE", "INFRASTRUCTURE_SCORE", "SEISMIC_SAFETY_SCORE", "SUPPLY_SCORE",
    "COMMUNICATION_SCORE", "SAFETY_SCORE", "DEPTH_SCORE", "SEISMIC_RISK_SCORE",
]


def recommend(active: DataFrame, prepared: DataFrame, as_of: str, n: int = fixed.TOP_PORTS) -> DataFrame:
    """Ranked ports per vessel; vessels no port can take have no row.

    Distance runs from the vessel's destination and is reported only.
    """
    asked = active.select(
        "NAME", "TYPE", "LENGTH_M", "BEAM_M", "REPORTED_STATUS", "DESTINATION_PORT_LAT", "DESTINATION_PORT_LON",
        vessels.required_facility(C("TYPE")).alias("REQUIRED_FACILITY"),
    )
    ranked = top_compatible(asked, prepared, n)
    attributes = prepared.select(
        C("WORLD_PORT_INDEX_NUMBER").alias("PORT"), C("MAIN_PORT_NAME").alias("RECOMMENDED_PORT_NAME"),
        C("MAX_RISK_SCORE").alias("SEISMIC_RISK_SCORE"), *_PORT_OUTPUT,
    )
    joined = joins.dimension_join(ranked, attributes, ["PORT"], "inner")
    distance = geo.haversine_km(C("DESTINATION_PORT_LAT"), C("DESTINATION_PORT_LON"), C("LATITUDE"), C("LONGITUDE"))
    scored = joined.withColumn("DISTANCE_KM", distance).withColumn(
        "DISTANCE_SCORE", ports.distance_score(C("DISTANCE_KM"))
    )
    out = {c: F.round(C(c).cast("double"), 2) for c in _ROUNDED}
    return scored.withColumns(out).select(
        F.to_date(dates.stamp(as_of)).alias("RUN_DATE"),
        C("NAME").alias("VESSEL_NAME"),
        C("TYPE").alias("VESSEL_TYPE"),
        C("LENGTH").alias("VESSEL_LENGTH_M"),
        C("BEAM").alias("VESSEL_BEAM_M"),
        "REPORTED_STATUS", "RANK", "RECOMMENDED_PORT_NAME",
        C("PORT").alias("WORLD_PORT_INDEX_NUMBER"),
        "COUNTRY_CODE", "REGION_NAME", "HARBOR_SIZE", "PORT_DEPTH_CLASS", "LATITUDE", "LONGITUDE", *_ROUNDED,
    )


def port_recommendations(
    gold_vessels: DataFrame, gold_ports: DataFrame, facilities: DataFrame, proximity: DataFrame, events: DataFrame,
    as_of: str, n: int = fixed.TOP_PORTS,
) -> DataFrame:
    """Recommendations from the stored gold tables.

    The three inputs of the ranking are read several times and are staged.
    """
    risk = staged(aggregates.max_port_risk(proximity, events, as_of), "port-risk")
    prepared = staged(prepare_ports(scoring_ports(gold_ports, facilities), risk), "scored-ports")
    return recommend(staged(active_vessels(gold_vessels), "active-vessels"), prepared, as_of, n)


def recent_port_risk(events: DataFrame, silver_ports: DataFrame, as_of: str) -> DataFrame:
    """As :func:`aggregates.max_port_risk`, from events and ports.

    Old events are dropped before the distance join instead of after it.
    """
    recent = within_lookback(events, "EARTHQUAKE_TIME", as_of)
    return aggregates.risk_by_port(gold.gold_seismic_port_proximity(recent, silver_ports))

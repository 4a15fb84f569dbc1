"""Cleaned tables: typed, normalised, one row per key."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.functions import dates, geo, seismic, text, vessels
from tidewatch.operators import dedup
from tidewatch.operators.filters import above_watermark, drop_soft_deleted, named_only

C = F.col


def vessel_rows(bronze: DataFrame, strict_past: bool = False) -> DataFrame:
    """Typed vessel reports from the all-text snapshot rows, before deduplication."""
    base = bronze.select(
        F.trim("name").alias("NAME"),
        F.trim("type").alias("TYPE"),
        text.try_number("year_built").alias("YEAR_BUILT"),
        text.try_number("gross_tonnage").alias("GROSS_TONNAGE"),
        text.try_number("deadweight").alias("DEADWEIGHT"),
        text.try_double(C("`length(m)`")).alias("LENGTH_M"),
        text.try_double(C("`beam(m)`")).alias("BEAM_M"),
        text.try_timestamp("report_date").alias("REPORT_DATE"),
        C("last_port_name").alias("LAST_PORT_NAME"),
        C("last_port_country").alias("LAST_PORT_COUNTRY"),
        C("destination_port_name").alias("DESTINATION_PORT_NAME"),
        C("destination_port_country").alias("DESTINATION_PORT_COUNTRY"),
        text.try_coordinate("destination_port_lat").alias("DESTINATION_LAT"),
        text.try_coordinate("destination_port_lon").alias("DESTINATION_LON"),
        text.clean_status("reported_status").alias("REPORTED_STATUS"),
        C("detail_link").alias("DETAIL_LINK"),
        C("_INGESTED_AT"),
        dates.extract_month_day("departure_date", "ATD:").alias("_atd"),
        dates.extract_month_day("arrival_date", "ATA:").alias("_ata"),
        dates.extract_month_day("arrival_date", "ETA:").alias("_eta"),
    )
    year, report = F.year("REPORT_DATE"), C("REPORT_DATE")
    limit = report if strict_past else None
    dated = base.withColumns(
        {
            "DEPARTURE_DATE": dates.resolve_past_date(C("_atd"), year, limit),
            "ACTUAL_ARRIVAL_DATE": dates.resolve_past_date(C("_ata"), year, limit),
            "ESTIMATED_ARRIVAL_DATE": dates.resolve_eta(C("_eta"), year, report),
        }
    )
    departed, arrived, expected = C("DEPARTURE_DATE"), C("ACTUAL_ARRIVAL_DATE"), C("ESTIMATED_ARRIVAL_DATE")
    return dated.drop("_atd", "_ata", "_eta").withColumns(
        {
            "IS_VALID_COORDINATES": geo.valid_coordinates(C("DESTINATION_LAT"), C("DESTINATION_LON")),
            "IS_TEMPORAL_ANOMALY": vessels.temporal_anomaly(arrived, departed),
            "IS_MISSING_TIMES": vessels.missing_times(departed, arrived, expected),
        }
    )


def _first_reports(bronze: DataFrame) -> DataFrame:
    """Raw rows, one per (trimmed name, report time): last ingested wins.

    Run on the raw rows so that only the surviving ones are parsed.
    """
    keyed = bronze.withColumns({"_name": F.trim("name"), "_report": text.try_timestamp("report_date")})
    order = [C("_INGESTED_AT").desc_nulls_last(), C("detail_link").asc_nulls_last()]
    return dedup.top_per_key(keyed, ["_name", "_report"], order).drop("_name", "_report")


def silver_vessels(bronze: DataFrame, watermark: datetime | None = None, strict_past: bool = False) -> DataFrame:
    """One row per vessel name and report minute.

    ``watermark`` is the newest ingest time already in the target (None for a
    full load); merge the result on (NAME, REPORT_DATE).
    """
    fresh = above_watermark(named_only(bronze, "name"), "_INGESTED_AT", watermark)
    return vessel_rows(_first_reports(fresh), strict_past)


def prune_ports(bronze: DataFrame) -> DataFrame:
    """The kept port columns, cleaned, with the coordinate flag; plus the ordering columns."""
    names = {c.upper(): c for c in bronze.columns}

    def raw(column: str):
        return C(f"`{names[column]}`")

    kept = [
        raw("WORLD_PORT_INDEX_NUMBER").alias("WORLD_PORT_INDEX_NUMBER"),
        *[text.blank_to_null(names[c]).alias(c) for c in fixed.PORT_TEXT_KEPT],
        raw("LATITUDE").alias("LATITUDE"),
        raw("LONGITUDE").alias("LONGITUDE"),
        geo.valid_coordinates(raw("LATITUDE"), raw("LONGITUDE")).alias("IS_VALID_COORDINATES"),
        *[text.zero_to_null(names[source]).alias(c) for c, source in fixed.PORT_MEASURE_KEPT.items()],
        *[text.clean_categorical(names[c]).alias(c) for c in fixed.PORT_CATEGORY_KEPT],
    ]
    order = [raw(c).alias(c) for c in ("OID_", "_LOADED_AT") if c in names]
    return bronze.select(*kept, *order)


def silver_ports(bronze: DataFrame, as_of: str) -> DataFrame:
    """One cleaned row per port index number."""
    first = dedup.first_port_records(prune_ports(bronze))
    return first.drop("OID_", "_LOADED_AT").withColumn("LOADED_AT", dates.stamp(as_of))


def seismic_rows(bronze: DataFrame) -> DataFrame:
    """Named, labelled and typed event versions."""
    kinds = dict(bronze.dtypes)

    def when(column: str):
        return text.parse_best_effort(column) if kinds[column] == "string" else C(column).cast("timestamp")

    return bronze.select(
        C("unid").alias("EVENT_ID"),
        C("source_id").alias("SOURCE_ID"),
        C("flynn_region").alias("REGION"),
        C("auth").alias("REPORTING_AGENCY"),
        C("evtype").alias("EVENT_TYPE_CODE"),
        seismic.label_event_type(C("evtype")).alias("EVENT_TYPE"),
        C("magtype").alias("MAGNITUDE_TYPE_CODE"),
        seismic.label_magnitude_type(C("magtype")).alias("MAGNITUDE_TYPE"),
        C("lat").cast("double").alias("LATITUDE"),
        C("lon").cast("double").alias("LONGITUDE"),
        C("mag").cast("double").alias("MAGNITUDE"),
        C("depth").cast("double").alias("DEPTH_KM"),
        when("time").alias("EARTHQUAKE_TIME"),
        when("lastupdate").alias("LAST_UPDATED_AT"),
        C("__deleted"),
    )


def silver_seismic_events(
    bronze: DataFrame, as_of: str, newest: datetime | None = None, honor_deletes: bool = False
) -> DataFrame:
    """One row per event: its last kept version.

    Deleted versions are removed before the last one is chosen, so a deleted
    event keeps its previous version; ``honor_deletes`` chooses first.
    ``newest`` is the last update time in the target: versions updated within
    24 hours of it are processed again, to be merged on EVENT_ID.
    """
    rows = seismic_rows(bronze)
    if newest is not None:
        edge = F.lit(newest) - F.expr(f"INTERVAL {fixed.REVISION_WINDOW_HOURS} HOURS")
        rows = rows.filter(C("LAST_UPDATED_AT") >= edge)
    if honor_deletes:
        chosen = drop_soft_deleted(dedup.latest_events(rows))
    else:
        chosen = dedup.latest_events(drop_soft_deleted(rows))
    return chosen.drop("__deleted").withColumn("LOADED_AT", dates.stamp(as_of))

"""Queries per operator: filters, column functions, joins, aggregates, windows, checks, pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch import adapters as A
from tidewatch import fixed
from tidewatch.functions import dates, geo, keys, ports, seismic, text, vessels
from tidewatch.operators import aggregates, compatible, dedup, filters, joins, pages, quality
from tidewatch.operators.proximity import proximity_join
from tidewatch.plans import gold, recommend, silver
from tidewatch.registry.base import query
from tidewatch.registry.common import Domain
from tidewatch.registry.sql import (
    day, haversine, in_year, month_day, name_key, real, recode, replaced, rnd, sk, stamp, whole, words,
)
from tidewatch.sources.writers import staged

C = F.col

_KEPT = "coalesce(__deleted, '') <> 'true'"  # live rows

# --- B: filters ---------------------------------------------------------------


@query("b1_prune_ports", "SELECT * EXCLUDE (LOADED_AT) FROM y_ports")
def b1(spark, sf_dir):
    """B1: the kept port columns (one row per port)."""
    return dedup.first_port_records(silver.prune_ports(Domain(spark, sf_dir).ports())).drop("OID_")


@query("b2_named_only", "SELECT detail_link, name FROM x_vessels WHERE name IS NOT NULL")
def b2(spark, sf_dir):
    """B2: rows with a name."""
    return filters.named_only(Domain(spark, sf_dir).vessels(), "name").select("detail_link", "name")


@query("b3_drop_soft_deleted", "SELECT source_id, __deleted FROM x_seismic WHERE __deleted = 'false' OR __deleted IS NULL")
def b3(spark, sf_dir):
    """Batch soft-delete filter."""
    return filters.drop_soft_deleted(Domain(spark, sf_dir).seismic()).select("source_id", "__deleted")


@query("b4_drop_soft_deleted_live", f"SELECT source_id, __deleted FROM x_seismic WHERE {_KEPT}")
def b4(spark, sf_dir):
    """Live soft-delete filter."""
    return filters.drop_soft_deleted_live(Domain(spark, sf_dir).seismic()).select("source_id", "__deleted")


@query(
    "b5_active_only",
    f"SELECT NAME, {stamp('REPORT_DATE')} AS REPORT_DATE, REPORTED_STATUS FROM y_vessels"
    " WHERE REPORTED_STATUS IN ('Under way', 'Sailing')",
)
def b5(spark, sf_dir):
    """Reports under way."""
    return filters.active_only(Domain(spark, sf_dir).silver_vessels()).select("NAME", "REPORT_DATE", "REPORTED_STATUS")


@query("b6_valid_ports", "SELECT WORLD_PORT_INDEX_NUMBER, LATITUDE, LONGITUDE FROM y_ports WHERE abs(LONGITUDE) <= 180")
def b6(spark, sf_dir):
    """Ports with valid coordinates."""
    return filters.valid_ports(Domain(spark, sf_dir).silver_ports()).select(
        "WORLD_PORT_INDEX_NUMBER", "LATITUDE", "LONGITUDE")


_POINT = "lat AS latitude, lon AS longitude, mag AS magnitude, flynn_region AS title"


@query("b7_strong_event_alerts", f"SELECT {_POINT} FROM x_live WHERE {_KEPT} AND mag >= 5.5")
def b7(spark, sf_dir):
    """Strong events with coordinates."""
    return filters.strong_event_alerts(Domain(spark, sf_dir).live())


@query("b8_mapped_points", f"SELECT {_POINT} FROM x_live WHERE {_KEPT}")
def b8(spark, sf_dir):
    """Points for the map."""
    return filters.mapped_points(Domain(spark, sf_dir).live())


@query(
    "b9_lookback",
    f"SELECT EVENT_ID, {stamp('EARTHQUAKE_TIME')} AS EARTHQUAKE_TIME FROM z_events"
    f" WHERE EARTHQUAKE_TIME >= TIMESTAMP '{A.AS_OF}' - INTERVAL 14 DAY",
)
def b9(spark, sf_dir):
    """Events of the last 14 days."""
    events = Domain(spark, sf_dir).gold_events()
    return filters.within_lookback(events, "EARTHQUAKE_TIME", A.AS_OF).select("EVENT_ID", "EARTHQUAKE_TIME")


@query(
    "b10_above_watermark",
    "SELECT detail_link FROM x_vessels WHERE \"_INGESTED_AT\" > (SELECT max(\"_INGESTED_AT\") FROM x_vessels"
    " WHERE \"_INGESTED_AT\" < TIMESTAMP '1998-01-01')",
)
def b10(spark, sf_dir):
    """Rows ingested after the newest row of an earlier load."""
    rows = Domain(spark, sf_dir).vessels()
    newest = aggregates.high_watermark(rows.filter("_INGESTED_AT < timestamp '1998-01-01'"), "_INGESTED_AT")
    return filters.above_watermark(rows, "_INGESTED_AT", newest).select("detail_link")


@query("b11_below_risk_cutoff", "SELECT WORLD_PORT_INDEX_NUMBER, RISK AS MAX_RISK_SCORE FROM r_ports WHERE RISK < 90")
def b11(spark, sf_dir):
    """Ports below the risk cutoff."""
    return Domain(spark, sf_dir).prepared_ports().select("WORLD_PORT_INDEX_NUMBER", "MAX_RISK_SCORE")


@query(
    "b12_time_range",
    f"SELECT source_id, time AS event_time FROM x_live WHERE {_KEPT}"
    f" AND CAST(time AS TIMESTAMP) >= TIMESTAMP '{A.AS_OF}' - INTERVAL 7 DAY",
)
def b12(spark, sf_dir):
    """Live rows of the last 7 days."""
    return filters.time_range(Domain(spark, sf_dir).live(), A.AS_OF).select("source_id", "event_time")


@query("b13_renames", f"SELECT source_id, time AS event_time, unid FROM x_live WHERE {_KEPT}")
def b13(spark, sf_dir):
    """Renamed pass-through columns."""
    return Domain(spark, sf_dir).live().select("source_id", "event_time", "unid")


# --- S: column functions ------------------------------------------------------


@query(
    "s_cast",
    f"SELECT detail_link, {whole('deadweight')} AS deadweight, {whole('year_built')} AS year_built,"
    f" {real(chr(34) + 'length(m)' + chr(34))} AS length, {real('destination_port_lat')} AS lat,"
    f" {real('destination_port_lon')} AS lon,"
    " CASE WHEN report_date LIKE '____-%' THEN report_date || ':00' END AS report,"
    " CASE WHEN trim(reported_status) IN ('None', '-', '', 'N/A') THEN NULL ELSE trim(reported_status) END AS status"
    " FROM x_vessels",
)
def s_cast(spark, sf_dir):
    """Casts of raw text."""
    return Domain(spark, sf_dir).vessels().select(
        "detail_link",
        text.try_number("deadweight").alias("deadweight"),
        text.try_number("year_built").alias("year_built"),
        text.try_double(C("`length(m)`")).alias("length"),
        text.try_coordinate("destination_port_lat").alias("lat"),
        text.try_coordinate("destination_port_lon").alias("lon"),
        text.try_timestamp("report_date").alias("report"),
        text.clean_status("reported_status").alias("status"),
    )


_REPORT = "try_strptime(report_date, '%Y-%m-%d %H:%M')"


@query(
    "s_dates",
    "SELECT detail_link, atd, ata, eta,"
    f" {day('coalesce(' + in_year('atd', 'y') + ', ' + in_year('atd', 'y - 1') + ')')} AS departed,"
    f" {day('coalesce(' + in_year('ata', 'y') + ', ' + in_year('ata', 'y - 1') + ')')} AS arrived,"
    f" {day('CASE WHEN ' + in_year('eta', 'y') + ' >= CAST(r AS DATE) - 1 THEN ' + in_year('eta', 'y') + ' ELSE ' + in_year('eta', 'y + 1') + ' END')} AS expected"
    f" FROM (SELECT detail_link, {_REPORT} AS r, year({_REPORT}) AS y, {month_day('departure_date', 'ATD:')} AS atd,"
    f" {month_day('arrival_date', 'ATA:')} AS ata, {month_day('arrival_date', 'ETA:')} AS eta FROM x_vessels)",
)
def s_dates(spark, sf_dir):
    """Month-day fragments and their years."""
    rows = Domain(spark, sf_dir).vessels().select(
        "detail_link", text.try_timestamp("report_date").alias("r"),
        dates.extract_month_day("departure_date", "ATD:").alias("atd"),
        dates.extract_month_day("arrival_date", "ATA:").alias("ata"),
        dates.extract_month_day("arrival_date", "ETA:").alias("eta"),
    )
    year = F.year("r")
    return rows.select(
        "detail_link", "atd", "ata", "eta",
        dates.resolve_past_date(C("atd"), year).alias("departed"),
        dates.resolve_past_date(C("ata"), year).alias("arrived"),
        dates.resolve_eta(C("eta"), year, C("r")).alias("expected"),
    )


@query(
    "s_ports_clean",
    "SELECT OID_ AS object_id, nullif(trim(UN_LOCODE), '') AS locode, nullif(trim(Alternate_Port_Name), '') AS other_name,"
    " CASE WHEN trim(Repairs) IN ('', 'Unknown', 'N/A', '-') THEN NULL ELSE trim(Repairs) END AS repairs,"
    " CASE WHEN trim(Port_Security) IN ('', 'Unknown', 'N/A', '-') THEN NULL ELSE trim(Port_Security) END AS security,"
    " CASE WHEN Channel_Depth_m <> 0 THEN Channel_Depth_m END AS channel,"
    " Longitude <= 180 AS located FROM x_ports",
)
def s_ports_clean(spark, sf_dir):
    """Blanks, categories, zero sentinels and coordinates of ports."""
    return Domain(spark, sf_dir).ports().select(
        C("OID_").alias("object_id"),
        text.blank_to_null("UN_LOCODE").alias("locode"),
        text.blank_to_null("Alternate_Port_Name").alias("other_name"),
        text.clean_categorical("Repairs").alias("repairs"),
        text.clean_categorical("Port_Security").alias("security"),
        text.zero_to_null("Channel_Depth_m").alias("channel"),
        geo.valid_coordinates(C("Latitude"), C("Longitude")).alias("located"),
    )


@query(
    "s_labels",
    f"SELECT source_id, {recode('evtype', fixed.EVENT_TYPE_LABELS, 'evtype')} AS event_type,"
    f" {recode('magtype', fixed.MAGNITUDE_TYPE_LABELS, 'magtype')} AS magnitude_type, lat, mag,"
    f" '{A.AS_OF}' AS loaded_at FROM x_seismic",
)
def s_labels(spark, sf_dir):
    """Code labels, numeric casts and the load stamp."""
    return Domain(spark, sf_dir).seismic().select(
        "source_id",
        seismic.label_event_type(C("evtype")).alias("event_type"),
        seismic.label_magnitude_type(C("magtype")).alias("magnitude_type"),
        C("lat").cast("double").alias("lat"), C("mag").cast("double").alias("mag"),
        dates.stamp(A.AS_OF).alias("loaded_at"),
    )


@query(
    "s13_parse_best_effort",
    f"SELECT event_id AS id, CASE event_id % 7 WHEN 6 THEN NULL WHEN 0 THEN {stamp('ts')} WHEN 1 THEN {stamp('ts')}"
    f" WHEN 2 THEN {stamp('ts')} WHEN 3 THEN strftime(ts, '%Y-%m-%d 00:00:00') WHEN 4 THEN"
    " strftime(ts, '%Y-%m-%d 00:00:00') ELSE strftime(to_timestamp(1700000000 + event_id) AT TIME ZONE 'UTC',"
    " '%Y-%m-%d %H:%M:%S') END AS parsed FROM events",
)
def s13(spark, sf_dir):
    """Seven spellings of a date-time."""
    spelled = (
        "CASE event_id % 7 WHEN 0 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss')"
        " WHEN 1 THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") WHEN 2 THEN date_format(ts, 'yyyy/MM/dd HH:mm:ss')"
        " WHEN 3 THEN date_format(ts, 'yyyy-MM-dd') WHEN 4 THEN date_format(ts, 'dd/MM/yyyy')"
        " WHEN 5 THEN cast(1700000000 + event_id AS string) ELSE 'soon' END"
    )
    return A.table(spark, sf_dir, "events").select(
        C("event_id").alias("id"), text.parse_best_effort(F.expr(spelled)).alias("parsed"))


@query(
    "s_calendar",
    "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_sk,"
    " CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,"
    " CAST(day(o_orderdate) AS INTEGER) AS d, CAST(week(o_orderdate) AS INTEGER) AS w,"
    " CAST(quarter(o_orderdate) AS INTEGER) AS q, CAST(hour(o_orderdate) AS INTEGER) AS h,"
    " strftime(o_orderdate, '%a') AS day_name, strftime(o_orderdate, '%b') AS month_name,"
    f" {day(chr(100) + 'ate_trunc(' + chr(39) + 'month' + chr(39) + ', o_orderdate)')} AS month_start,"
    f" {day('date_trunc(' + chr(39) + 'year' + chr(39) + ', o_orderdate)')} AS year_start,"
    " CAST(o_orderkey % 20 AS INTEGER) AS days FROM orders",
)
def s_calendar(spark, sf_dir):
    """Calendar keys, parts, names, truncations and day differences."""
    d = F.to_date("o_orderdate")
    return A.table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.date_sk(d).alias("date_sk"), F.year(d).alias("y"), F.month(d).alias("m"),
        F.dayofmonth(d).alias("d"), F.weekofyear(d).alias("w"), F.quarter(d).alias("q"),
        F.hour("o_orderdate").alias("h"), F.dayname(d).alias("day_name"), F.monthname(d).alias("month_name"),
        F.trunc(d, "month").alias("month_start"), F.trunc(d, "year").alias("year_start"),
        dates.days_between(F.date_sub(d, (C("o_orderkey") % 20).cast("int")), C("o_orderdate")).alias("days"),
    )


@query(
    "s_keys",
    f"SELECT detail_link, {sk('name', 'report_date')} AS sk, {name_key('destination_port_name')} AS name_key,"
    " detail_link || '-' || CAST(strlen(detail_link) AS VARCHAR) AS pair FROM x_vessels",
)
def s_keys(spark, sf_dir):
    """Surrogate keys, pair ids and name keys."""
    return Domain(spark, sf_dir).vessels().select(
        "detail_link", keys.surrogate_key(C("name"), C("report_date")).alias("sk"),
        text.name_key("destination_port_name").alias("name_key"),
        keys.pair_id("detail_link", F.length("detail_link").cast("double")).alias("pair"),
    )


@query(
    "s_page_text",
    "SELECT o_orderkey,"
    " CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS length,"
    " CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey % 50 AS VARCHAR) END AS beam,"
    " 'Port ' || o_custkey AS port, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'Land' END AS country,"
    " CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE (o_orderkey % 90) || '.5N' END AS lat,"
    " CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE (o_custkey % 180) || '.25E' END AS lon,"
    " CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderstatus END AS status FROM orders",
)
def s_page_text(spark, sf_dir):
    """Sizes, port and country, coordinate sentences, navigation status."""
    raw = A.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "CASE WHEN o_orderkey % 4 = 0 THEN '-' ELSE o_custkey || ' / ' || o_orderkey % 50 || ' m' END AS size",
        "'Port ' || o_custkey || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE ' , Land' END AS place",
        "CASE WHEN o_orderkey % 5 = 0 THEN 'No place' ELSE 'It is at ' || o_orderkey % 90 || '.5N, by the sea, '"
        " || o_custkey % 180 || '.25E.\nA, b' END AS sentence",
        "CASE WHEN o_orderkey % 6 = 0 THEN 'x\ny\n' ELSE 'x\nNavigation Status\n' || o_orderstatus || '\ny\n' END AS page",
    )
    length, beam = text.parse_size("size")
    port, country = text.split_name_country("place")
    lat, lon = text.parse_coord_sentence("sentence")
    return raw.select(
        "o_orderkey", length.alias("length"), beam.alias("beam"), port.alias("port"), country.alias("country"),
        lat.alias("lat"), lon.alias("lon"), text.nav_status("page").alias("status"),
    )


@query(
    "s_vessel_class",
    f"SELECT DETAIL_LINK, {day('LATEST_ARRIVAL_DATE')} AS LATEST_ARRIVAL_DATE, VESSEL_AGE, AGE_CATEGORY, SIZE_CATEGORY,"
    " HAS_VALID_DESTINATION, VOYAGE_STATUS, IS_ANCHORED, IS_MOORED, IS_UNDERWAY, IS_VALID_COORDINATES,"
    " IS_TEMPORAL_ANOMALY, IS_MISSING_TIMES FROM z_vessels",
)
def s_vessel_class(spark, sf_dir):
    """Vessel and voyage classification."""
    return Domain(spark, sf_dir).gold_vessels().select(
        "DETAIL_LINK", "LATEST_ARRIVAL_DATE", "VESSEL_AGE", "AGE_CATEGORY", "SIZE_CATEGORY", "HAS_VALID_DESTINATION",
        "VOYAGE_STATUS", "IS_ANCHORED", "IS_MOORED", "IS_UNDERWAY", "IS_VALID_COORDINATES", "IS_TEMPORAL_ANOMALY",
        "IS_MISSING_TIMES",
    )


@query(
    "s_port_scores",
    "SELECT g.WORLD_PORT_INDEX_NUMBER, g.SUPPLY_SCORE, g.SUPPLY_RATING, g.COMMUNICATION_SCORE, g.COMMUNICATION_RATING,"
    " g.PORT_DEPTH_CLASS, s.HAS_REPAIRS, s.HAS_RADIO, s.OVERALL_PORT_SCORE, f.HAS_RO_RO_FACILITY, f.DRY_DOCK_SIZE,"
    " f.PORT_PRIMARY_TYPE FROM z_ports g JOIN z_supply s USING (WORLD_PORT_INDEX_NUMBER)"
    " JOIN z_facilities f USING (WORLD_PORT_INDEX_NUMBER)",
)
def s_port_scores(spark, sf_dir):
    """Port scores, flags and kinds."""
    return Domain(spark, sf_dir).dim_port().select(
        "WORLD_PORT_INDEX_NUMBER", "SUPPLY_SCORE", "SUPPLY_RATING", "COMMUNICATION_SCORE", "COMMUNICATION_RATING",
        "PORT_DEPTH_CLASS", "HAS_REPAIRS", "HAS_RADIO", "OVERALL_PORT_SCORE", "HAS_RO_RO_FACILITY", "DRY_DOCK_SIZE",
        "PORT_PRIMARY_TYPE",
    )


@query(
    "s_geo_risk",
    f"SELECT source_id, {rnd('DISTANCE_KM', 3)} AS DISTANCE_KM, RISK_SCORE, CASE WHEN RISK_SCORE >= 75 THEN 'CRITICAL'"
    " WHEN RISK_SCORE >= 50 THEN 'HIGH' WHEN RISK_SCORE >= 25 THEN 'MODERATE' ELSE 'LOW' END AS RISK_BAND,"
    " MAGNITUDE_CLASS, BUCKET FROM (SELECT *, CASE WHEN MAGNITUDE IS NULL THEN NULL ELSE "
    + rnd("least(100.0::DOUBLE, MAGNITUDE / 10 * 40 + CASE WHEN DEPTH_KM < 70 THEN 30 WHEN DEPTH_KM BETWEEN 70 AND 300"
          " THEN 15 ELSE 5 END + greatest(0.0::DOUBLE, 500 - DISTANCE_KM) / 500 * 30)", 1)
    + " END AS RISK_SCORE FROM (SELECT source_id, mag AS MAGNITUDE, depth AS DEPTH_KM,"
    f" {haversine('lat', 'lon', 'lat * 0.97::DOUBLE', 'lon + 2')} AS DISTANCE_KM,"
    " CASE WHEN mag >= 7 THEN 'Major' WHEN mag >= 5 THEN 'Moderate' ELSE 'Minor' END AS MAGNITUDE_CLASS,"
    " CASE WHEN mag < 2 THEN 'Minor (<2)' WHEN mag < 4 THEN 'Light (2-4)' WHEN mag < 6 THEN 'Moderate (4-6)'"
    " ELSE 'Strong (6+)' END AS BUCKET FROM x_seismic))",
    rounded={"DISTANCE_KM": 3},
)
def s_geo_risk(spark, sf_dir):
    """Distance, risk, bands and buckets."""
    mag = C("mag")
    rows = Domain(spark, sf_dir).seismic().withColumn(
        "DISTANCE_KM", geo.haversine_km(C("lat"), C("lon"), C("lat") * 0.97, C("lon") + 2))
    scored = rows.withColumn("RISK_SCORE", seismic.risk_score(mag, C("depth"), C("DISTANCE_KM")))
    return scored.select(
        "source_id", "DISTANCE_KM", "RISK_SCORE", seismic.risk_band(C("RISK_SCORE")).alias("RISK_BAND"),
        seismic.magnitude_class(mag).alias("MAGNITUDE_CLASS"), seismic.intensity_bucket(mag).alias("BUCKET"),
    )


@query("s_daily_risk", "SELECT DAILY_SEISMIC_SK, DAILY_RISK_LEVEL, DAILY_RISK_SCORE FROM s_daily")
def s_daily_risk(spark, sf_dir):
    """Daily risk level and its number."""
    level = C("DAILY_RISK_LEVEL")
    return Domain(spark, sf_dir).daily().select(
        keys.surrogate_key(keys.stamp_text("EVENT_DATE"), C("REGION")).alias("DAILY_SEISMIC_SK"),
        level, seismic.daily_risk_score(level).alias("DAILY_RISK_SCORE"))


@query(
    "s_destination",
    "SELECT DETAIL_LINK, DEST_PORT_INDEX_NUMBER, DESTINATION_PORT_LAT, DESTINATION_PORT_LON, IS_VALID_COORDINATES,"
    " HAS_VALID_DESTINATION, IS_ARRIVED, DESTINATION_PORT_FOUND, VESSEL_STATUS FROM z_details",
)
def s_destination(spark, sf_dir):
    """What follows from the matched destination."""
    return Domain(spark, sf_dir).details().select(
        "DETAIL_LINK", "DEST_PORT_INDEX_NUMBER", "DESTINATION_PORT_LAT", "DESTINATION_PORT_LON",
        "IS_VALID_COORDINATES", "HAS_VALID_DESTINATION", "IS_ARRIVED", "DESTINATION_PORT_FOUND", "VESSEL_STATUS")


@query(
    "s_recommend_scores",
    "SELECT WORLD_PORT_INDEX_NUMBER, SAFETY AS SAFETY_SCORE, DEPTH AS DEPTH_SCORE, HARBOR AS HARBOR_SCORE,"
    f" {rnd('INFRA', 2)} AS INFRASTRUCTURE_SCORE, {rnd('SEISMIC', 2)} AS SEISMIC_SAFETY_SCORE,"
    f" {rnd('FINAL', 2)} AS FINAL_SCORE, {rnd('100 * exp(-abs(LATITUDE) * 111 / 2000)', 3)} AS DISTANCE_SCORE,"
    " CASE WHEN lower(PORT_SECURITY) = 'yes' THEN 1 ELSE 0 END AS SECURE,"
    " coalesce(MAXIMUM_VESSEL_LENGTH_M, 9999) AS LENGTH_LIMIT, coalesce(MAXIMUM_VESSEL_BEAM_M, 999) AS BEAM_LIMIT"
    " FROM r_final",
)
def s_recommend_scores(spark, sf_dir):
    """Port scores for ranking."""
    ports_ = Domain(spark, sf_dir).prepared_ports()
    return ports_.select(
        "WORLD_PORT_INDEX_NUMBER", "SAFETY_SCORE", "DEPTH_SCORE",
        ports.harbor_size_score(C("HARBOR_SIZE")).alias("HARBOR_SCORE"),
        F.round("INFRASTRUCTURE_SCORE", 2).alias("INFRASTRUCTURE_SCORE"),
        F.round("SEISMIC_SAFETY_SCORE", 2).alias("SEISMIC_SAFETY_SCORE"),
        F.round("FINAL_SCORE", 2).alias("FINAL_SCORE"),
        F.round(ports.distance_score(F.abs("LATITUDE") * 111), 3).alias("DISTANCE_SCORE"),
        ports.yes_no(C("PORT_SECURITY")).alias("SECURE"),
        C("MAXIMUM_VESSEL_LENGTH_M").alias("LENGTH_LIMIT"), C("MAXIMUM_VESSEL_BEAM_M").alias("BEAM_LIMIT"),
    )


@query("s68_required_facility", "SELECT NAME, TYPE, NEED FROM r_active")
def s68(spark, sf_dir):
    """Facility a vessel type needs."""
    active = dedup.active_vessels(Domain(spark, sf_dir).gold_vessels())
    return active.select("NAME", "TYPE", vessels.required_facility(C("TYPE")).alias("NEED"))


# --- J: joins -----------------------------------------------------------------

_DETAIL = f"SELECT DETAIL_LINK, {stamp('REPORT_DATE')} AS REPORT_DATE"


@query("j1_map_alias", "SELECT DETAIL_LINK, DESTINATION_PORT_NAME, MAPPED_NAME FROM z_vessels_mapped")
def j1(spark, sf_dir):
    """Destination aliases, with their fan-out."""
    d = Domain(spark, sf_dir)
    return joins.map_alias(d.gold_vessels(), d.aliases()).select("DETAIL_LINK", "DESTINATION_PORT_NAME", "MAPPED_NAME")


@query("j2_match_port_by_name", "SELECT DETAIL_LINK, DEST_PORT_INDEX_NUMBER FROM z_details")
def j2(spark, sf_dir):
    """Destination port by name."""
    d = Domain(spark, sf_dir)
    side = d.silver_ports().select("MAIN_PORT_NAME", C("WORLD_PORT_INDEX_NUMBER").alias("DEST_PORT_INDEX_NUMBER"))
    mapped = joins.map_alias(d.gold_vessels(), d.aliases())
    return joins.match_port_by_name(mapped, side).select("DETAIL_LINK", "DEST_PORT_INDEX_NUMBER")


_J3 = (
    "SELECT v.DETAIL_LINK, p.WORLD_PORT_INDEX_NUMBER AS DEST_PORT_INDEX_NUMBER FROM z_vessels_mapped v LEFT JOIN z_ports p"
    f" ON {name_key('coalesce(v.MAPPED_NAME, v.DESTINATION_PORT_NAME)')} = {name_key('p.MAIN_PORT_NAME')}"
    f" AND coalesce({name_key('v.DESTINATION_PORT_COUNTRY')} = {name_key('p.COUNTRY_CODE')},"
    " v.DESTINATION_PORT_COUNTRY IS NULL)"
)


def _j3(spark, sf_dir, **kw):
    d = Domain(spark, sf_dir)
    side = d.silver_ports().select(
        "MAIN_PORT_NAME", "COUNTRY_CODE", C("WORLD_PORT_INDEX_NUMBER").alias("DEST_PORT_INDEX_NUMBER"))
    mapped = joins.map_alias(d.gold_vessels(), d.aliases(), **kw)
    return joins.match_port_by_name_country(mapped, side, **kw).select("DETAIL_LINK", "DEST_PORT_INDEX_NUMBER")


@query("j3_match_port_by_name_country", _J3)
def j3(spark, sf_dir):
    """Destination port by name and stated country."""
    return _j3(spark, sf_dir)


@query("j3_match_port_shuffled", _J3)
def j3_shuffled(spark, sf_dir):
    """J3 with the shuffle join that large port tables take."""
    return _j3(spark, sf_dir, hint="merge")


_J4 = (
    "SELECT EVENT_ID, CAST(WORLD_PORT_INDEX_NUMBER AS BIGINT) AS port,"
    f" {rnd('DISTANCE_KM', 3)} AS DISTANCE_KM FROM z_near WHERE DISTANCE_KM <= 500"
)


def _j4(spark, sf_dir, **kw):
    d = Domain(spark, sf_dir)
    side = filters.valid_ports(d.silver_ports()).select(
        C("WORLD_PORT_INDEX_NUMBER").cast("bigint").alias("port"),
        C("LATITUDE").alias("PORT_LATITUDE"), C("LONGITUDE").alias("PORT_LONGITUDE"))
    near = proximity_join(d.gold_events().select("EVENT_ID", "LATITUDE", "LONGITUDE"), side, **kw)
    return near.select("EVENT_ID", "port", "DISTANCE_KM")


@query("j4_proximity_join", _J4, rounded={"DISTANCE_KM": 3})
def j4(spark, sf_dir):
    """Pairs within 500 km."""
    return _j4(spark, sf_dir)


@query("j4_proximity_shuffled", _J4, rounded={"DISTANCE_KM": 3})
def j4_shuffled(spark, sf_dir):
    """J4 with the shuffle join that large port tables take."""
    return _j4(spark, sf_dir, hint="merge")


@query(
    "j5_port_dimension_join",
    "SELECT g.WORLD_PORT_INDEX_NUMBER, f.PORT_PRIMARY_TYPE, s.OVERALL_PORT_SCORE FROM z_ports g LEFT JOIN z_facilities f"
    " USING (WORLD_PORT_INDEX_NUMBER) LEFT JOIN z_supply s USING (WORLD_PORT_INDEX_NUMBER)",
)
def j5(spark, sf_dir):
    """Facilities and supplies joined to ports."""
    return Domain(spark, sf_dir).dim_port().select("WORLD_PORT_INDEX_NUMBER", "PORT_PRIMARY_TYPE", "OVERALL_PORT_SCORE")


@query(
    "j6_scoring_ports",
    "SELECT p.WORLD_PORT_INDEX_NUMBER, coalesce(p.MAXIMUM_VESSEL_LENGTH_M, 9999) AS MAXIMUM_VESSEL_LENGTH_M,"
    " coalesce(p.MAXIMUM_VESSEL_BEAM_M, 999) AS MAXIMUM_VESSEL_BEAM_M, f.HAS_CONTAINER_FACILITY, f.PORT_PRIMARY_TYPE"
    " FROM z_ports p JOIN z_facilities f USING (WORLD_PORT_INDEX_NUMBER) WHERE p.IS_VALID_COORDINATES",
)
def j6(spark, sf_dir):
    """Ports with facilities and default limits."""
    d = Domain(spark, sf_dir)
    return recommend.scoring_ports(d.gold_ports(), d.facilities()).select(
        "WORLD_PORT_INDEX_NUMBER", "MAXIMUM_VESSEL_LENGTH_M", "MAXIMUM_VESSEL_BEAM_M", "HAS_CONTAINER_FACILITY",
        "PORT_PRIMARY_TYPE")


@query(
    "j7_recent_proximity",
    "SELECT x.PROXIMITY_ID, x.RISK_SCORE FROM z_proximity x WHERE x.EVENT_ID IN (SELECT EVENT_ID FROM z_events"
    f" WHERE EARTHQUAKE_TIME >= TIMESTAMP '{A.AS_OF}' - INTERVAL 14 DAY)",
)
def j7(spark, sf_dir):
    """Pairs of recent events."""
    d = Domain(spark, sf_dir)
    return aggregates.recent_pairs(d.proximity_of, d.gold_events(), A.AS_OF).select("PROXIMITY_ID", "RISK_SCORE")


@query("j8_attach_risk", "SELECT WORLD_PORT_INDEX_NUMBER, MAIN_PORT_NAME, RISK AS MAX_RISK_SCORE FROM r_ports")
def j8(spark, sf_dir):
    """Port risk by normalised name."""
    d = Domain(spark, sf_dir)
    ports_ = filters.valid_ports(d.gold_ports()).select("WORLD_PORT_INDEX_NUMBER", "MAIN_PORT_NAME")
    risk = staged(recommend.recent_port_risk(d.gold_events(), d.silver_ports(), A.AS_OF), "port-risk")
    return joins.attach_risk(ports_, risk)


def _asked(d: Domain):
    active = dedup.active_vessels(d.gold_vessels())
    need = vessels.required_facility(C("TYPE")).alias("REQUIRED_FACILITY")
    return staged(active.select("NAME", "TYPE", "LENGTH_M", "BEAM_M", need), "asked")


def _prepared(d: Domain):
    return staged(d.prepared_ports(), "scored-ports")


@query(
    "j9_compatible_ports",
    "SELECT NAME, CAST(WORLD_PORT_INDEX_NUMBER AS BIGINT) AS PORT, RANK FROM r_pairs WHERE RANK <= 3",
)
def j9(spark, sf_dir):
    """Best compatible ports per vessel by dimensions and facility."""
    d = Domain(spark, sf_dir)
    ranked = compatible.top_compatible(_asked(d), _prepared(d))
    return ranked.select("NAME", C("PORT").cast("bigint").alias("PORT"), "RANK")


@query(
    "j10_without_port",
    "SELECT NAME, TYPE FROM r_active WHERE NAME NOT IN (SELECT NAME FROM r_pairs)",
)
def j10(spark, sf_dir):
    """Vessels no port can take."""
    d = Domain(spark, sf_dir)
    return compatible.without_port(_asked(d), _prepared(d)).select("NAME", "TYPE")


@query("j11_lookup_sk", "SELECT PROXIMITY_ID, SEISMIC_EVENT_SK, PORT_SK FROM s_proximity")
def j11(spark, sf_dir):
    """Dimension keys of pairs."""
    d = Domain(spark, sf_dir)
    sides = gold.proximity_sides(d.gold_events(), d.silver_ports())
    pairs = joins.lookup_sk(*sides, d.dim_event(), d.dim_port(), gold.pair_up)
    return pairs.select("PROXIMITY_ID", "SEISMIC_EVENT_SK", "PORT_SK")


@query("j12_insert_if_absent", "SELECT unid, source_id FROM x_seismic WHERE action = 'update' UNION ALL"
       " SELECT unid, source_id FROM x_seismic WHERE action = 'create' AND unid NOT IN"
       " (SELECT unid FROM x_seismic WHERE action = 'update')")
def j12(spark, sf_dir):
    """Insert created rows whose key the target (the updated rows) lacks."""
    rows = Domain(spark, sf_dir).seismic().select("unid", "source_id", "action")
    target = rows.filter("action = 'update'").drop("action")
    return joins.insert_if_absent(target, rows.filter("action = 'create'").drop("action"), ["unid"])


@query("j13_delete_by_key", "SELECT unid, source_id FROM x_seismic WHERE unid NOT IN"
       " (SELECT unid FROM x_seismic WHERE action IN ('delete', 'update'))")
def j13(spark, sf_dir):
    """Delete rows by key."""
    rows = Domain(spark, sf_dir).seismic().select("unid", "source_id", "action")
    return joins.delete_by_key(rows, rows.filter("action IN ('delete', 'update')"), ["unid"]).select("unid", "source_id")


# --- G: aggregates ------------------------------------------------------------


@query(
    "g1_daily_region_stats",
    f"SELECT {stamp('EVENT_DATE')} AS EVENT_DATE, REGION, TOTAL_EVENTS, {rnd('AVG_MAGNITUDE', 6)} AS AVG_MAGNITUDE,"
    " MAX_MAGNITUDE, SEISMIC_INTENSITY_INDEX FROM z_daily_stats",
    rounded={"AVG_MAGNITUDE": 6},
)
def g1(spark, sf_dir):
    """Daily counts, magnitudes and intensity index per region."""
    return aggregates.daily_region_stats(Domain(spark, sf_dir).gold_events())


@query("g3_max_port_risk", "SELECT PORT_NAME, MAX_RISK_SCORE FROM r_risk")
def g3(spark, sf_dir):
    """Highest recent risk per port name, from pairs and events joined by id."""
    d = Domain(spark, sf_dir)
    return aggregates.max_port_risk(d.proximity_of, d.gold_events(), A.AS_OF)


@query("g3_recent_port_risk", "SELECT PORT_NAME, MAX_RISK_SCORE FROM r_risk")
def g3_recent(spark, sf_dir):
    """G3 with old events dropped before the distance join."""
    d = Domain(spark, sf_dir)
    return recommend.recent_port_risk(d.gold_events(), d.silver_ports(), A.AS_OF)


@query(
    "g4_intensity_histogram",
    f"SELECT category, count(*) AS count FROM (SELECT CASE WHEN mag >= 6 THEN 'Strong (6+)' WHEN mag >= 4 THEN"
    " 'Moderate (4-6)' WHEN mag >= 2 THEN 'Light (2-4)' ELSE 'Minor (<2)' END AS category FROM x_live"
    f" WHERE {_KEPT} AND mag IS NOT NULL) GROUP BY category",
)
def g4(spark, sf_dir):
    """Versions per magnitude bucket."""
    return aggregates.intensity_histogram(Domain(spark, sf_dir).live())


@query("g5_events_per_day", f"SELECT substr(time, 1, 10) AS day, count(*) AS earthquakes FROM x_live WHERE {_KEPT} GROUP BY 1")
def g5(spark, sf_dir):
    """Versions per day."""
    return aggregates.events_per_day(Domain(spark, sf_dir).live())


@query(
    "g6_high_watermarks",
    f"SELECT {stamp('max(lastupdate)')} AS updated, {stamp('max(time)')} AS happened, max(seq) AS seq FROM x_seismic",
)
def g6(spark, sf_dir):
    """Newest update and event time."""
    return Domain(spark, sf_dir).seismic().agg(
        F.max("lastupdate").alias("updated"), F.max("time").alias("happened"), F.max("seq").alias("seq"))


_PROFILED = ["name", "type", "destination_port_name", "arrival_date", "reported_status"]


@query(
    "g7_null_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS \"rows\", count(*) - count({c}) AS missing,"
        f" {rnd(f'(count(*) - count({c})) * 100.0::DOUBLE / count(*)', 6)} AS missing_pct FROM x_vessels" for c in _PROFILED
    ),
    rounded={"missing_pct": 6},
)
def g7(spark, sf_dir):
    """Missing values per column."""
    return aggregates.null_profile(Domain(spark, sf_dir).vessels(), _PROFILED)


@query(
    "g8_snapshot_metrics",
    "SELECT 'rows' AS metric, count(*) AS value FROM x_vessels UNION ALL "
    + " UNION ALL ".join(f"SELECT 'missing_{c}', count(*) FILTER (WHERE {c} IS NULL) FROM x_vessels" for c in _PROFILED),
)
def g8(spark, sf_dir):
    """Counts behind the snapshot gate."""
    return quality.snapshot_metrics(Domain(spark, sf_dir).vessels())


@query("g9_distinct_vessels", "SELECT count(*) AS recommendations, count(DISTINCT VESSEL_NAME) AS vessels FROM r_out")
def g9(spark, sf_dir):
    """Size of the recommendation table."""
    d = Domain(spark, sf_dir)
    active = dedup.active_vessels(d.gold_vessels())
    return aggregates.distinct_vessels(recommend.recommend(active, _prepared(d), A.AS_OF))


# --- W: windows ---------------------------------------------------------------


@query("w1_latest_report", _DETAIL + " FROM y_vessels")
def w1(spark, sf_dir):
    """Last ingested report per vessel and minute."""
    rows = silver.vessel_rows(filters.named_only(Domain(spark, sf_dir).vessels(), "name"))
    return dedup.latest_vessel_reports(rows).select("DETAIL_LINK", "REPORT_DATE")


@query(
    "w2_first_port_record",
    "SELECT World_Port_Index_Number AS WORLD_PORT_INDEX_NUMBER, min(OID_) AS OID_ FROM x_ports GROUP BY ALL",
)
def w2(spark, sf_dir):
    """Lowest object id per port."""
    return dedup.first_port_records(silver.prune_ports(Domain(spark, sf_dir).ports())).select(
        "WORLD_PORT_INDEX_NUMBER", "OID_")


@query("w3_latest_event", "SELECT EVENT_ID, SOURCE_ID FROM y_events")
def w3(spark, sf_dir):
    """Last version per event."""
    rows = silver.seismic_rows(filters.drop_soft_deleted(Domain(spark, sf_dir).seismic()))
    return dedup.latest_events(rows).select("EVENT_ID", "SOURCE_ID")


@query("w4_one_voyage_per_report", f"SELECT VESSEL_NAME, {stamp('REPORT_DATE')} AS REPORT_DATE, DESTINATION_PORT_SK, DETAIL_LINK FROM s_voyage")
def w4(spark, sf_dir):
    """One voyage per vessel report."""
    return Domain(spark, sf_dir).voyages().select("VESSEL_NAME", "REPORT_DATE", "DESTINATION_PORT_SK", "DETAIL_LINK")


@query("w5_active_vessels", f"SELECT NAME, {stamp('REPORT_DATE')} AS REPORT_DATE, DETAIL_LINK FROM r_active")
def w5(spark, sf_dir):
    """Latest report under way per vessel."""
    return dedup.active_vessels(Domain(spark, sf_dir).gold_vessels()).select("NAME", "REPORT_DATE", "DETAIL_LINK")


@query(
    "w6_rolling_rows",
    f"SELECT {stamp('EVENT_DATE')} AS EVENT_DATE, REGION, {rnd('ROLLING', 6)} AS ROLLING_7D_AVG_EVENTS FROM z_rolling",
    rounded={"ROLLING_7D_AVG_EVENTS": 6},
)
def w6(spark, sf_dir):
    """Mean events over seven event days."""
    stats = aggregates.daily_region_stats(Domain(spark, sf_dir).gold_events())
    return aggregates.rolling_rows_avg(stats).select("EVENT_DATE", "REGION", "ROLLING_7D_AVG_EVENTS")


@query(
    "w6_rolling_calendar",
    f"SELECT {stamp('EVENT_DATE')} AS EVENT_DATE, REGION, {rnd('r', 6)} AS ROLLING_7D_AVG_EVENTS FROM (SELECT *,"
    " avg(TOTAL_EVENTS) OVER (PARTITION BY REGION ORDER BY EVENT_DATE RANGE BETWEEN INTERVAL 6 DAYS PRECEDING"
    " AND CURRENT ROW) AS r FROM z_daily_stats)",
    rounded={"ROLLING_7D_AVG_EVENTS": 6},
)
def w6_calendar(spark, sf_dir):
    """W6 over seven calendar days."""
    stats = aggregates.daily_region_stats(Domain(spark, sf_dir).gold_events())
    return aggregates.rolling_rows_avg(stats, calendar=True).select("EVENT_DATE", "REGION", "ROLLING_7D_AVG_EVENTS")


@query(
    "w7_top_n",
    "SELECT o_custkey AS NAME, o_orderkey AS WORLD_PORT_INDEX_NUMBER, CAST(n AS INTEGER) AS RANK FROM (SELECT *,"
    " row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n <= 3",
)
def w7(spark, sf_dir):
    """Top three per key with rank, over every order."""
    rows = A.table(spark, sf_dir, "orders").select(
        C("o_custkey").alias("NAME"), C("o_orderkey").alias("WORLD_PORT_INDEX_NUMBER"),
        C("o_totalprice").alias("FINAL_SCORE"))
    return dedup.top_n_per_vessel(rows).drop("FINAL_SCORE")


# --- T: sorts, limits, sets, generators ----------------------------------------


@query("t1_newest_first", replaced("z_daily", stamps="EVENT_DATE") + " ORDER BY EVENT_DATE DESC, REGION")
def t1(spark, sf_dir):
    """Daily risk, newest day first."""
    return gold.daily_aggregated_seismic_events(Domain(spark, sf_dir).gold_events(), ordered=True)


@query("t2_magnitude_series", f"SELECT time, mag AS magnitude FROM x_live WHERE {_KEPT} ORDER BY time")
def t2(spark, sf_dir):
    """Magnitudes in time order."""
    return aggregates.magnitude_series(Domain(spark, sf_dir).live(), ordered=True)


@query(
    "t3_strongest_events",
    f"SELECT source_id, time, flynn_region AS location, mag AS magnitude, depth FROM x_live WHERE {_KEPT}"
    " ORDER BY mag DESC NULLS LAST, source_id LIMIT 10",
)
def t3(spark, sf_dir):
    """The ten strongest versions."""
    return aggregates.strongest_events(Domain(spark, sf_dir).live())


@query(
    "t5_union_rows",
    "SELECT unid, source_id, 'backfill' AS origin FROM x_seismic WHERE action = 'create' UNION ALL"
    " SELECT unid, source_id, 'live' FROM x_seismic",
)
def t5(spark, sf_dir):
    """T5: backfilled and live rows in one table."""
    rows = Domain(spark, sf_dir).seismic().select("unid", "source_id", "action")
    old = rows.filter("action = 'create'").withColumn("origin", F.lit("backfill"))
    return old.unionByName(rows.withColumn("origin", F.lit("live"))).drop("action")


# --- I: checks ----------------------------------------------------------------


def _check(check: str, column: str, severity: str, failures: str) -> str:
    bad = "fail" if severity == "error" else "warn"
    return (
        f"SELECT '{check}' AS \"check\", '{column}' AS \"column\", '{severity}' AS severity,"
        f" CAST(f AS BIGINT) AS failures, CASE WHEN f > 0 THEN '{bad}' ELSE 'pass' END AS status"
        f" FROM (SELECT ({failures}) AS f)"
    )


@query(
    "i1_not_null",
    " UNION ALL ".join(
        _check("not_null", c, "error", f"SELECT count(*) FROM y_vessels WHERE {c} IS NULL") for c in ("NAME", "REPORT_DATE")
    ),
)
def i1(spark, sf_dir):
    """NULL counts."""
    return quality.not_null(Domain(spark, sf_dir).silver_vessels(), ["NAME", "REPORT_DATE"])


@query(
    "i2_unique",
    _check("unique", "unid", "warn", "SELECT count(*) FROM (SELECT unid FROM x_seismic GROUP BY unid HAVING count(*) > 1)")
    + " UNION ALL " + _check("unique", "flynn_region", "error",
                             "SELECT count(*) FROM (SELECT flynn_region FROM x_seismic WHERE flynn_region IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"),
)
def i2(spark, sf_dir):
    """Repeated values."""
    rows = Domain(spark, sf_dir).seismic()
    return quality.combine(quality.unique(rows, "unid", "warn"), quality.unique(rows, "flynn_region"))


@query(
    "i3_accepted_values",
    _check("accepted_values", "HARBOR_SIZE", "warn",
           f"SELECT count(DISTINCT Harbor_Size) FROM x_ports WHERE Harbor_Size NOT IN {words(fixed.HARBOR_SIZES)}"),
)
def i3(spark, sf_dir):
    """Values outside the list."""
    rows = Domain(spark, sf_dir).ports().select(C("Harbor_Size").alias("HARBOR_SIZE"))
    return quality.accepted_values(rows, "HARBOR_SIZE", fixed.HARBOR_SIZES, "warn")


@query(
    "i4_relationships",
    _check("relationships", "DESTINATION_PORT_SK", "error",
           "SELECT count(*) FROM s_voyage WHERE DESTINATION_PORT_SK IS NOT NULL AND DESTINATION_PORT_SK NOT IN"
           " (SELECT PORT_SK FROM s_port)") + " UNION ALL "
    + _check("relationships", "unid", "error",
             "SELECT count(*) FROM x_seismic WHERE unid NOT IN (SELECT EVENT_ID FROM y_events)"),
)
def i4(spark, sf_dir):
    """I4: keys without a parent."""
    d = Domain(spark, sf_dir)
    return quality.combine(
        quality.relationships(d.voyages(), "DESTINATION_PORT_SK", d.dim_port(), "PORT_SK"),
        quality.relationships(d.seismic(), "unid", d.silver_events(), "EVENT_ID"),
    )


@query(
    "i5_freshness",
    f"SELECT 'freshness' AS \"check\", 'lastupdate' AS \"column\", {stamp('max(lastupdate)')} AS newest,"
    f" {rnd('date_diff(' + chr(39) + 'second' + chr(39) + ', date_trunc(' + chr(39) + 'second' + chr(39) + ', max(lastupdate)), TIMESTAMP ' + chr(39) + '2024-02-01 02:00:00' + chr(39) + ') / 3600.0::DOUBLE', 3)} AS hours,"
    " 'warn' AS status FROM x_seismic",
    rounded={"hours": 3},
)
def i5(spark, sf_dir):
    """Age of the newest row, some 26 hours here."""
    return quality.freshness(Domain(spark, sf_dir).seismic(), "lastupdate", "2024-02-01 02:00:00")


_MISSING = {c: f"(SELECT count(*) FILTER (WHERE {c} IS NULL) FROM x_vessels)" for c in _PROFILED}


@query(
    "i6_validate_snapshot",
    "SELECT 'verdict' AS kind, CASE WHEN count(*) = 0 THEN 'no rows' WHEN count(name) = 0 THEN 'every name is NULL' ELSE 'OK' END"
    " AS text FROM x_vessels UNION ALL SELECT 'warning', count(*) || ' rows, expected at least 50' FROM x_vessels HAVING count(*) < 50"
    + "".join(
        f" UNION ALL SELECT 'warning', '{c}: ' || {n} || ' of ' || (SELECT count(*) FROM x_vessels) || ' missing' WHERE {n} > 0"
        for c, n in _MISSING.items()),
)
def i6(spark, sf_dir):
    """Verdict and warnings of a snapshot."""
    verdict = quality.validate_snapshot(Domain(spark, sf_dir).vessels())
    rows = [("verdict", verdict.message), *[("warning", w) for w in verdict.warnings]]
    return spark.createDataFrame(rows, "kind string, text string")


@query(
    "i_fused_checks",
    " UNION ALL ".join([
        _check("not_null", "name", "error", "SELECT count(*) FROM x_vessels WHERE name IS NULL"),
        _check("not_null", "type", "warn", "SELECT count(*) FROM x_vessels WHERE type IS NULL"),
        _check("unique", "detail_link", "error",
               "SELECT count(*) FROM (SELECT detail_link FROM x_vessels WHERE detail_link IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"),
        _check("unique", "destination_port_name", "warn",
               "SELECT count(*) FROM (SELECT 1 FROM x_vessels WHERE destination_port_name IS NOT NULL GROUP BY destination_port_name HAVING count(*) > 1)"),
        _check("accepted_values", "type", "error", "SELECT count(DISTINCT type) FROM x_vessels WHERE type NOT IN ('Cargo', 'Tanker')"),
        _check("relationships", "destination_port_name", "warn",
               "SELECT count(*) FROM x_vessels WHERE destination_port_name NOT IN (SELECT Main_Port_Name FROM x_ports"
               " WHERE Main_Port_Name IS NOT NULL)"),
    ]),
)
def i_fused(spark, sf_dir):
    """Six checks of the reports from one scan and one shuffle, most of them failing."""
    d, check = Domain(spark, sf_dir), quality.Check
    return quality.check_all(d.vessels(), [
        check("not_null", "name"), check("not_null", "type", "warn"), check("unique", "detail_link"),
        check("unique", "destination_port_name", "warn"), check("accepted_values", "type", values=("Cargo", "Tanker")),
        check("relationships", "destination_port_name", "warn", parent="ports", key="Main_Port_Name"),
    ], {"ports": d.ports()})


# --- P: pages -----------------------------------------------------------------

_BASE = "https://ships.example"
_HAS_ROW = "o_orderkey % 19 <> 0"


@query(
    "p1_extract_list_rows",
    "SELECT '/list/' || CAST(o_orderkey // 20 AS VARCHAR) AS list_url, 'V' || o_custkey AS name,"
    " CASE WHEN o_orderkey % 3 <> 0 THEN 'R&D Ship' WHEN (o_orderkey // 20) % 2 = 0 THEN 'Cargo' ELSE 'Tanker' END AS type,"
    " CASE WHEN o_custkey % 11 <> 0 THEN CAST(1965 + o_custkey % 37 AS VARCHAR) END AS year_built,"
    " CAST(5000 + (o_custkey * 37) % 90000 AS VARCHAR) AS gross_tonnage,"
    " CAST(8000 + (o_custkey * 41) % 90000 AS VARCHAR) AS deadweight,"
    " CASE WHEN o_orderkey % 7 <> 0 THEN CAST(60 + (o_custkey * 7) % 300 AS VARCHAR) END AS \"length(m)\","
    " CASE WHEN o_orderkey % 7 <> 0 THEN CAST(10 + (o_custkey * 3) % 50 AS VARCHAR) END AS \"beam(m)\","
    f" '{_BASE}/d/' || o_orderkey AS detail_link FROM orders WHERE {_HAS_ROW}",
)
def p1(spark, sf_dir):
    """Vessel records out of list pages."""
    return pages.extract_list_rows(A.list_pages(spark, sf_dir), _BASE, C("page_type"))


_N40 = "CAST(o_custkey // 40 AS VARCHAR)"
_MON = "strftime({0}, '%b') || ' ' || CAST(day({0}) AS VARCHAR)"
_D0 = "CAST(o_orderdate AS DATE)"
_P2 = (
    "SELECT '/d/' || o_orderkey AS detail_link,"
    " CASE WHEN o_orderkey % 6 <> 0 THEN 'PORT ' || o_orderkey % 30 END AS last_port_name,"
    " CASE WHEN o_orderkey % 6 <> 0 THEN 'NATION ' || o_custkey % 25 END AS last_port_country,"
    " CASE WHEN o_orderkey % 6 <> 0 THEN 'ATD: ' || " + _MON.format(f"({_D0} - CAST(o_orderkey % 20 AS INTEGER))")
    + " || ', 19:11 UTC' END AS departure_date,"
    f" CASE WHEN o_orderkey % 3 <> 0 THEN 'PORT ' || {_N40} END AS destination_port_name,"
    " CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 2 <> 0 THEN 'Country X' END AS destination_port_country,"
    " CASE WHEN o_orderkey % 3 <> 0 THEN 'ETA: ' || " + _MON.format(f"({_D0} + CAST(o_orderkey % 25 AS INTEGER))")
    + " || ', 01:00' END AS arrival_date,"
    " CASE WHEN o_orderkey % 5 <> 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'Under way' ELSE 'Moored' END END"
    f" AS reported_status, CASE WHEN o_orderkey % 3 <> 0 THEN '/p/' || {_N40} END AS port_link FROM orders"
)


@query("p2_extract_detail_fields", _P2)
def p2(spark, sf_dir):
    """Voyage fields out of detail pages."""
    return pages.extract_detail_fields(A.detail_pages(spark, sf_dir))


@query(
    "p3_attach_port_coords",
    "SELECT d.detail_link, d.port_link,"
    " CASE WHEN s_suppkey % 5 <> 0 THEN (s_suppkey % 90) || '.25N' END AS destination_port_lat,"
    " CASE WHEN s_suppkey % 5 <> 0 THEN (s_suppkey % 180) || '.50E' END AS destination_port_lon"
    f" FROM ({_P2}) d LEFT JOIN supplier ON d.port_link = '/p/' || s_suppkey",
)
def p3(spark, sf_dir):
    """Coordinates from port pages, once per link."""
    details = pages.extract_detail_fields(A.detail_pages(spark, sf_dir)).select("detail_link", "port_link")
    return pages.attach_port_coords(details, A.port_pages(spark, sf_dir))


@query(
    "p1_page_links",
    "SELECT page_id, url, CAST(i - 1 AS INTEGER) AS position, links[i] AS link,"
    " replace(replace(replace(replace(replace(replace(labels[i], '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'),"
    " '&quot;', '\"'), '&#39;', ''''), '&amp;', '&') AS label FROM (SELECT *, unnest(range(1, len(links) + 1)) AS i FROM ("
    "SELECT page_id, url, regexp_extract_all(html, '(?is)<li><a href=\"([^\"]*)\">[^<]*</a></li>', 1) AS links,"
    " regexp_extract_all(html, '(?is)<li><a href=\"[^\"]*\">([^<]*)</a></li>', 1) AS labels FROM pages))",
)
def p1_links(spark, sf_dir):
    """P1 over the given pages: their list anchors."""
    return pages.page_links(A.table(spark, sf_dir, "pages"))

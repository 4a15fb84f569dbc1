"""The same tables once more as plain SQL, for checking.

Each entry of ``TABLES`` is a SELECT that may use the entries before it and the
given tables. :func:`with_tables` puts the ones a query mentions in front of it.
"""

from __future__ import annotations

import re

from tidewatch import adapters as A
from tidewatch import fixed


def rnd(x: str, n: int) -> str:
    """Round half away from zero in decimal, as a double."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,12)), {n}) AS DOUBLE)"


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def columns(exprs: dict[str, str]) -> str:
    return ", ".join(f'{e} AS "{n}"' for n, e in exprs.items())


def words(values) -> str:
    return "(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + ")"


def recode(x: str, table: dict, default: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN " + (f"'{v}'" if isinstance(v, str) else str(v)) for k, v in table.items())
    return f"CASE {x} {whens} ELSE {default} END"


def whole(x: str) -> str:
    return f"CAST(round(TRY_CAST(trim({x}) AS DECIMAL(38,10)), 0) AS BIGINT)"


def real(x: str) -> str:
    return (
        f"CASE WHEN regexp_matches(trim({x}), '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$')"
        f" THEN TRY_CAST(trim({x}) AS DOUBLE) END"
    )


def month_day(x: str, tag: str) -> str:
    return f"CASE WHEN {x} LIKE '%{tag}%' THEN nullif(regexp_extract({x}, '[A-Z][a-z][a-z]\\s+[0-9][0-9]?'), '') END"


def in_year(md: str, year: str) -> str:
    return f"CAST(try_strptime(regexp_replace({md}, '\\s+', ' ') || ' ' || CAST({year} AS VARCHAR), '%b %d %Y') AS DATE)"


def name_key(x: str) -> str:
    return f"upper(trim({x}))"


def sk(*parts: str) -> str:
    texts = [f"coalesce(CAST({p} AS VARCHAR), '{fixed.NULL_KEY_PLACEHOLDER}')" for p in parts]
    return "md5(" + " || '-' || ".join(texts) + ")"


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"pow(sin(radians(({lat2}) - ({lat1})) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians(({lon2}) - ({lon1})) / 2), 2)"
    )
    return f"12742.0::DOUBLE * atan2(sqrt({a}), sqrt(greatest(0.0::DOUBLE, 1 - ({a}))))"


def yes(c: str) -> str:
    return f"CASE WHEN upper({c}) = 'YES' THEN 1 ELSE 0 END"


def supplied(c: str) -> str:
    return f"CASE WHEN upper({c}) IN {words(fixed.SUPPLY_WORDS)} THEN 1 ELSE 0 END"


_LIVE_TIMES = {"time": stamp("CAST(ts AS TIMESTAMP)"), "lastupdate": stamp("CAST(ts AS TIMESTAMP)")}
_YEAR = "year(REPORT_DATE)"
_SILVER_VESSEL_TYPED = {
    "NAME": "trim(name)",
    "TYPE": "trim(type)",
    "YEAR_BUILT": whole("year_built"),
    "GROSS_TONNAGE": whole("gross_tonnage"),
    "DEADWEIGHT": whole("deadweight"),
    "LENGTH_M": real('"length(m)"'),
    "BEAM_M": real('"beam(m)"'),
    "REPORT_DATE": "try_strptime(report_date, '%Y-%m-%d %H:%M')",
    "LAST_PORT_NAME": "last_port_name",
    "LAST_PORT_COUNTRY": "last_port_country",
    "DESTINATION_PORT_NAME": "destination_port_name",
    "DESTINATION_PORT_COUNTRY": "destination_port_country",
    "DESTINATION_LAT": real("destination_port_lat"),
    "DESTINATION_LON": real("destination_port_lon"),
    "REPORTED_STATUS": f"CASE WHEN trim(reported_status) NOT IN {words(fixed.EMPTY_STATUS_WORDS)}"
    " THEN trim(reported_status) END",
    "DETAIL_LINK": "detail_link",
    "_INGESTED_AT": '"_INGESTED_AT"',
    "atd": month_day("departure_date", "ATD:"),
    "ata": month_day("arrival_date", "ATA:"),
    "eta": month_day("arrival_date", "ETA:"),
}
_CATEGORY = "CASE WHEN trim({0}) NOT IN " + words(fixed.EMPTY_CATEGORY_WORDS) + " THEN trim({0}) END"
_SILVER_PORT = {
    "WORLD_PORT_INDEX_NUMBER": "World_Port_Index_Number",
    **{c: f"nullif(trim({c}), '')" for c in fixed.PORT_TEXT_KEPT},
    "LATITUDE": "Latitude",
    "LONGITUDE": "Longitude",
    "IS_VALID_COORDINATES": "coalesce(abs(Latitude) <= 90 AND abs(Longitude) <= 180, false)",
    **{c: f"nullif({src}, 0)" for c, src in fixed.PORT_MEASURE_KEPT.items()},
    **{c: _CATEGORY.format(c) for c in fixed.PORT_CATEGORY_KEPT},
}
_GOLD_PORT = [
    "WORLD_PORT_INDEX_NUMBER", *fixed.PORT_TEXT_KEPT, "LATITUDE", "LONGITUDE", "IS_VALID_COORDINATES",
    *fixed.GOLD_PORT_MEASURES, *fixed.GOLD_PORT_CATEGORIES,
]
_HEAD = ("WORLD_PORT_INDEX_NUMBER, MAIN_PORT_NAME, COUNTRY_CODE, REGION_NAME, HARBOR_SIZE, PORT_DEPTH_CLASS,"
         " IS_VALID_COORDINATES, LATITUDE, LONGITUDE")
_AS_OF_V = f"TIMESTAMP '{A.VESSELS_AS_OF}'"
_AS_OF = f"TIMESTAMP '{A.AS_OF}'"
_RISK = (
    "CASE WHEN MAGNITUDE IS NULL THEN NULL ELSE "
    + rnd(
        "least(100.0::DOUBLE, MAGNITUDE * 4 + (CASE WHEN DEPTH_KM < 70 THEN 30 WHEN DEPTH_KM <= 300 THEN 15 ELSE 5 END)"
        " + greatest(0.0::DOUBLE, (500 - DISTANCE_KM) * 0.06))",
        1,
    )
    + " END"
)
_DEST = {
    "DEST_PORT_INDEX_NUMBER": "WORLD_PORT_INDEX_NUMBER", "DEST_PORT_COUNTRY_CODE": "COUNTRY_CODE",
    "DEST_HARBOR_SIZE": "HARBOR_SIZE", "DEST_PORT_DEPTH_CLASS": "PORT_DEPTH_CLASS",
    "DEST_CARGO_PIER_DEPTH_M": "CARGO_PIER_DEPTH_M", "DEST_MAX_VESSEL_LENGTH_M": "MAXIMUM_VESSEL_LENGTH_M",
    "DEST_MAX_VESSEL_DRAFT_M": "MAXIMUM_VESSEL_DRAFT_M", "DEST_SUPPLY_RATING": "SUPPLY_RATING",
    "DEST_SUPPLY_SCORE": "SUPPLY_SCORE", "DEST_COMMUNICATION_RATING": "COMMUNICATION_RATING",
    "DEST_CONTAINER_FACILITY": "FACILITIES_CONTAINER", "DEST_OIL_TERMINAL": "FACILITIES_OIL_TERMINAL",
    "DEST_LIQUID_BULK": "FACILITIES_LIQUID_BULK",
}
_FACILITY = " ".join(f"WHEN contains(lower(TYPE), '{w}') THEN '{c}'" for w, c in fixed.FACILITY_KEYWORDS)

TABLES: dict[str, str] = {
    # inputs
    "x_seismic": f"SELECT {columns({**A.SEISMIC, 'seq': 'event_id'})} FROM events",
    "x_live": f"SELECT {columns({**A.SEISMIC, **_LIVE_TIMES, 'seq': 'event_id'})} FROM events",
    "x_ports": f"SELECT {columns(A.PORTS)} FROM (SELECT *, unnest(CASE WHEN s_suppkey % 10 = 0 THEN [0, 1]"
    " ELSE [0] END) AS copy FROM supplier)",
    "x_vessels": f"SELECT {columns(A.VESSELS)}, o_orderdate + to_hours(CAST(o_orderkey % 5 AS INTEGER))"
    ' AS "_INGESTED_AT" FROM orders',
    "x_aliases": "SELECT 'ANCH ' || CAST(s_suppkey // 3 AS VARCHAR) AS RAW_NAME, 'PORT ' || CAST(s_suppkey // 3 AS"
    " VARCHAR) AS MAPPED_NAME FROM supplier WHERE s_suppkey % 12 = 0 UNION ALL SELECT ' Anch ' ||"
    " CAST(s_suppkey // 3 AS VARCHAR), 'PORT ' || CAST(s_suppkey // 3 + 1 AS VARCHAR) FROM supplier"
    " WHERE s_suppkey % 24 = 0",
    # cleaned
    "y_events": "SELECT unid AS EVENT_ID, source_id AS SOURCE_ID, flynn_region AS REGION, auth AS REPORTING_AGENCY,"
    f" evtype AS EVENT_TYPE_CODE, {recode('evtype', fixed.EVENT_TYPE_LABELS, 'evtype')} AS EVENT_TYPE,"
    " magtype AS MAGNITUDE_TYPE_CODE,"
    f" {recode('magtype', fixed.MAGNITUDE_TYPE_LABELS, 'magtype')} AS MAGNITUDE_TYPE,"
    " lat AS LATITUDE, lon AS LONGITUDE, mag AS MAGNITUDE, depth AS DEPTH_KM, time AS EARTHQUAKE_TIME,"
    f" lastupdate AS LAST_UPDATED_AT, {_AS_OF} AS LOADED_AT FROM (SELECT *, row_number() OVER (PARTITION BY unid"
    " ORDER BY lastupdate DESC NULLS FIRST, source_id DESC) AS n FROM x_seismic"
    " WHERE coalesce(__deleted, 'false') = 'false') WHERE n = 1",
    "y_ports": f"SELECT {columns(_SILVER_PORT)}, {_AS_OF} AS LOADED_AT FROM (SELECT *, row_number() OVER (PARTITION BY"
    " World_Port_Index_Number ORDER BY OID_ ASC NULLS LAST) AS n FROM x_ports) WHERE n = 1",
    "y_vessels_typed": f"SELECT {columns(_SILVER_VESSEL_TYPED)} FROM x_vessels WHERE name IS NOT NULL",
    "y_vessels_dated": "SELECT *,"
    f" coalesce({in_year('atd', _YEAR)}, {in_year('atd', _YEAR + ' - 1')}) AS DEPARTURE_DATE,"
    f" coalesce({in_year('ata', _YEAR)}, {in_year('ata', _YEAR + ' - 1')}) AS ACTUAL_ARRIVAL_DATE,"
    f" CASE WHEN {in_year('eta', _YEAR)} >= CAST(REPORT_DATE AS DATE) - 1 THEN {in_year('eta', _YEAR)}"
    f" ELSE {in_year('eta', _YEAR + ' + 1')} END AS ESTIMATED_ARRIVAL_DATE FROM y_vessels_typed",
    "y_vessels": "SELECT * EXCLUDE (atd, ata, eta, n),"
    " coalesce(abs(DESTINATION_LAT) <= 90 AND abs(DESTINATION_LON) <= 180, false) AS IS_VALID_COORDINATES,"
    " coalesce(ACTUAL_ARRIVAL_DATE < DEPARTURE_DATE, false) AS IS_TEMPORAL_ANOMALY,"
    " coalesce(DEPARTURE_DATE, ACTUAL_ARRIVAL_DATE, ESTIMATED_ARRIVAL_DATE) IS NULL AS IS_MISSING_TIMES"
    " FROM (SELECT *, row_number() OVER (PARTITION BY NAME, REPORT_DATE ORDER BY \"_INGESTED_AT\" DESC NULLS LAST,"
    " DETAIL_LINK) AS n FROM y_vessels_dated) WHERE n = 1",
    # enriched
    "z_ports_scored": f"SELECT {', '.join(_GOLD_PORT)},"
    f" {' + '.join(supplied(c) for c in fixed.SUPPLY_FLAGS.values())} AS SUPPLY_SCORE,"
    f" {' + '.join(yes(c) for c in fixed.COMMUNICATION_FLAGS.values())} AS COMMUNICATION_SCORE,"
    " greatest(coalesce(CARGO_PIER_DEPTH_M, 0), coalesce(CHANNEL_DEPTH_M, 0)) AS deepest FROM y_ports",
    "z_ports": "SELECT * EXCLUDE (deepest),"
    " CASE SUPPLY_SCORE WHEN 5 THEN 'Excellent' WHEN 4 THEN 'Good' WHEN 3 THEN 'Good' WHEN 0 THEN 'Unavailable'"
    " ELSE 'Limited' END AS SUPPLY_RATING,"
    " CASE COMMUNICATION_SCORE WHEN 4 THEN 'Excellent' WHEN 3 THEN 'Good' WHEN 0 THEN 'Unavailable'"
    " ELSE 'Limited' END AS COMMUNICATION_RATING,"
    " CASE WHEN deepest = 0 THEN 'Unknown' WHEN deepest < 8 THEN 'Shallow' WHEN deepest <= 15 THEN 'Medium'"
    " ELSE 'Deep' END AS PORT_DEPTH_CLASS FROM z_ports_scored",
    "z_supply": f"SELECT {_HEAD}, {columns({f: supplied(c) for f, c in fixed.SUPPLY_FLAGS.items()})},"
    f" {columns({f: yes(c) for f, c in fixed.COMMUNICATION_FLAGS.items()})}, SUPPLY_SCORE, SUPPLY_RATING,"
    " COMMUNICATION_SCORE, COMMUNICATION_RATING, SUPPLY_SCORE + COMMUNICATION_SCORE AS OVERALL_PORT_SCORE"
    " FROM z_ports",
    "z_facility_flags": f"SELECT {_HEAD}, {columns({f: yes(c) for f, c in fixed.FACILITY_FLAGS.items()})},"
    " CRANES_CONTAINER, coalesce(DRY_DOCK, 'None') AS DRY_DOCK_SIZE, coalesce(REPAIRS, 'None') AS REPAIR_CAPABILITY,"
    " FROM z_ports",
    # bits: oil, liquid, container, ro-ro, solid
    "z_facilities": "SELECT * EXCLUDE (code), CASE"
    " WHEN code LIKE '11___' THEN 'Liquid Cargo & Oil Hub' WHEN code LIKE '1____' THEN 'Oil Terminal'"
    " WHEN code LIKE '010_0' THEN 'Liquid Bulk Specialist' WHEN code LIKE '__11_' THEN 'Container & Ro-Ro Port'"
    " WHEN code LIKE '__1__' THEN 'Container Port' WHEN code LIKE '__010' THEN 'Ro-Ro Specialist (Vehicles)'"
    " WHEN code LIKE '_00_1' THEN 'Dry Bulk Port' WHEN code LIKE '___11' THEN 'Multi-Purpose Commercial Port'"
    " WHEN DRY_DOCK_SIZE IN ('Medium', 'Large') OR REPAIR_CAPABILITY = 'Major' THEN 'Shipyard & Maintenance Port'"
    " ELSE 'General Cargo / Undefined' END AS PORT_PRIMARY_TYPE FROM (SELECT *, concat(HAS_OIL_TERMINAL_FACILITY,"
    " HAS_LIQUID_BULK_FACILITY, HAS_CONTAINER_FACILITY, HAS_RO_RO_FACILITY, HAS_SOLID_BULK_FACILITY) AS code"
    " FROM z_facility_flags)",
    "z_vessels": "SELECT * EXCLUDE (\"_INGESTED_AT\", DESTINATION_LAT, DESTINATION_LON),"
    " DESTINATION_LAT AS DESTINATION_PORT_LAT, DESTINATION_LON AS DESTINATION_PORT_LON,"
    " coalesce(ACTUAL_ARRIVAL_DATE, ESTIMATED_ARRIVAL_DATE) AS LATEST_ARRIVAL_DATE,"
    f" year({_AS_OF_V}) - YEAR_BUILT AS VESSEL_AGE,"
    f" CASE WHEN YEAR_BUILT IS NULL THEN 'Unknown' WHEN year({_AS_OF_V}) - YEAR_BUILT > 25 THEN 'Old'"
    f" WHEN year({_AS_OF_V}) - YEAR_BUILT > 15 THEN 'Aging' WHEN year({_AS_OF_V}) - YEAR_BUILT >= 5 THEN 'Mid-life'"
    " ELSE 'New' END AS AGE_CATEGORY,"
    " CASE WHEN DEADWEIGHT >= 80000 THEN 'Capesize' WHEN DEADWEIGHT >= 60000 THEN 'Panamax'"
    " WHEN DEADWEIGHT >= 40000 THEN 'Handymax' WHEN DEADWEIGHT < 40000 THEN 'Handysize' ELSE 'Unknown' END"
    " AS SIZE_CATEGORY, DESTINATION_PORT_NAME IS NOT NULL AS HAS_VALID_DESTINATION,"
    " CAST(date_diff('day', DEPARTURE_DATE, CAST(REPORT_DATE AS DATE)) AS INTEGER) AS DAYS_SINCE_DEPARTURE,"
    " coalesce(REPORTED_STATUS, CASE WHEN ACTUAL_ARRIVAL_DATE IS NOT NULL THEN 'Arrived / At Berth'"
    " WHEN DESTINATION_PORT_NAME IS NOT NULL AND DEPARTURE_DATE IS NOT NULL THEN 'In Transit'"
    " WHEN DESTINATION_PORT_NAME IS NULL AND LAST_PORT_NAME IS NOT NULL THEN 'At Port'"
    f" WHEN ESTIMATED_ARRIVAL_DATE < CAST({_AS_OF_V} AS DATE) THEN 'Delayed' ELSE 'Unknown' END) AS VOYAGE_STATUS,"
    " coalesce(contains(lower(REPORTED_STATUS), 'anchor'), false) AS IS_ANCHORED,"
    " coalesce(contains(lower(REPORTED_STATUS), 'moor'), false) AS IS_MOORED,"
    " coalesce(regexp_matches(lower(REPORTED_STATUS), 'under ?way|sailing'), false) AS IS_UNDERWAY FROM y_vessels",
    "z_vessels_mapped": "SELECT v.*, a.MAPPED_NAME FROM z_vessels v LEFT JOIN x_aliases a"
    f" ON {name_key('v.DESTINATION_PORT_NAME')} = {name_key('a.RAW_NAME')}",
    "z_details": "SELECT v.* EXCLUDE (MAPPED_NAME) REPLACE ("
    " coalesce(v.DESTINATION_PORT_LAT, p.LATITUDE) AS DESTINATION_PORT_LAT,"
    " coalesce(v.DESTINATION_PORT_LON, p.LONGITUDE) AS DESTINATION_PORT_LON,"
    " coalesce(v.DESTINATION_PORT_LAT, p.LATITUDE) IS NOT NULL AND"
    " coalesce(v.DESTINATION_PORT_LON, p.LONGITUDE) IS NOT NULL AS IS_VALID_COORDINATES,"
    " v.DESTINATION_PORT_NAME IS NOT NULL AND (p.WORLD_PORT_INDEX_NUMBER IS NOT NULL OR"
    " v.DESTINATION_PORT_LAT IS NOT NULL) AS HAS_VALID_DESTINATION),"
    f" {columns({n: 'p.' + c for n, c in _DEST.items()})},"
    " v.ACTUAL_ARRIVAL_DATE IS NOT NULL OR (p.WORLD_PORT_INDEX_NUMBER IS NOT NULL AND (v.IS_MOORED OR v.IS_ANCHORED))"
    " OR v.VOYAGE_STATUS IN ('Arrived / At Berth', 'At Port') AS IS_ARRIVED,"
    " p.WORLD_PORT_INDEX_NUMBER IS NOT NULL AS DESTINATION_PORT_FOUND,"
    f" CASE WHEN v.REPORT_DATE >= {_AS_OF_V} - INTERVAL 48 HOUR THEN 'Active' ELSE 'Inactive' END AS VESSEL_STATUS"
    " FROM z_vessels_mapped v LEFT JOIN z_ports p"
    f" ON {name_key('coalesce(v.MAPPED_NAME, v.DESTINATION_PORT_NAME)')} = {name_key('p.MAIN_PORT_NAME')}",
    "z_events": "SELECT EVENT_ID, REGION, MAGNITUDE, DEPTH_KM, EARTHQUAKE_TIME, LATITUDE, LONGITUDE,"
    " CASE WHEN MAGNITUDE < 5 OR MAGNITUDE IS NULL THEN 'Minor' WHEN MAGNITUDE < 7 THEN 'Moderate'"
    " ELSE 'Major' END AS MAGNITUDE_CLASS FROM y_events",
    "z_near": "SELECT e.*, p.WORLD_PORT_INDEX_NUMBER, p.MAIN_PORT_NAME AS PORT_NAME,"
    f" {haversine('e.LATITUDE', 'e.LONGITUDE', 'p.LATITUDE', 'p.LONGITUDE')} AS DISTANCE_KM"
    " FROM z_events e JOIN y_ports p ON p.IS_VALID_COORDINATES"
    " AND abs(e.LATITUDE - p.LATITUDE) < 4.6",
    "z_proximity": "SELECT EVENT_ID || '-' || CAST(CAST(WORLD_PORT_INDEX_NUMBER AS BIGINT) AS VARCHAR) AS PROXIMITY_ID,"
    f" EVENT_ID, MAGNITUDE, PORT_NAME, DISTANCE_KM, {_RISK} AS RISK_SCORE FROM z_near WHERE DISTANCE_KM <= 500",
    "z_daily_stats": "SELECT date_trunc('day', EARTHQUAKE_TIME) AS EVENT_DATE, REGION, count(EVENT_ID) AS TOTAL_EVENTS,"
    " avg(MAGNITUDE) AS AVG_MAGNITUDE, max(MAGNITUDE) AS MAX_MAGNITUDE,"
    " CAST(count(*) + count(*) FILTER (WHERE MAGNITUDE >= 7) AS BIGINT) AS SEISMIC_INTENSITY_INDEX"
    " FROM z_events GROUP BY ALL",
    "z_rolling": "SELECT *, avg(TOTAL_EVENTS) OVER (PARTITION BY REGION ORDER BY EVENT_DATE"
    " ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ROLLING FROM z_daily_stats",
    "z_daily": f"SELECT EVENT_DATE, REGION, TOTAL_EVENTS, {rnd('AVG_MAGNITUDE', 2)} AS AVG_MAGNITUDE, MAX_MAGNITUDE,"
    f" {rnd('ROLLING', 1)} AS ROLLING_7D_AVG_EVENTS, CASE"
    " WHEN MAX_MAGNITUDE >= 7 OR SEISMIC_INTENSITY_INDEX >= 6 THEN 'CRITICAL'"
    " WHEN MAX_MAGNITUDE >= 5.5 OR TOTAL_EVENTS > ROLLING * 1.5 THEN 'HIGH'"
    " WHEN MAX_MAGNITUDE >= 4 THEN 'MODERATE' ELSE 'LOW' END AS DAILY_RISK_LEVEL FROM z_rolling",
    # star
    "s_port": f"SELECT {sk('CAST(g.WORLD_PORT_INDEX_NUMBER AS BIGINT)')} AS PORT_SK, g.* EXCLUDE ("
    + ", ".join(
        c for c in ["ENTRANCE_RESTRICTION_OTHER", "SUPPLY_SCORE", "SUPPLY_RATING", "COMMUNICATION_SCORE",
                    "COMMUNICATION_RATING", "CRANES_CONTAINER",
                    *[c for c in fixed.GOLD_PORT_CATEGORIES
                      if c.startswith(("COMMUNICATIONS_", "SUPPLIES_", "FACILITIES_")) or c in ("REPAIRS", "DRY_DOCK")]]
    )
    + "), f.PORT_PRIMARY_TYPE, " + ", ".join(f"f.{c}" for c in fixed.FACILITY_FLAGS)
    + ", f.CRANES_CONTAINER, f.DRY_DOCK_SIZE, f.REPAIR_CAPABILITY, "
    + ", ".join(f"s.{c}" for c in [*fixed.SUPPLY_FLAGS, *fixed.COMMUNICATION_FLAGS])
    + ", s.SUPPLY_SCORE, s.SUPPLY_RATING, s.COMMUNICATION_SCORE, s.COMMUNICATION_RATING, s.OVERALL_PORT_SCORE,"
    f" {_AS_OF} AS DIM_LOADED_AT FROM z_ports g JOIN z_facilities f USING (WORLD_PORT_INDEX_NUMBER)"
    " JOIN z_supply s USING (WORLD_PORT_INDEX_NUMBER)",
    "s_event": f"SELECT {sk('EVENT_ID')} AS SEISMIC_EVENT_SK, *, date_trunc('day', EARTHQUAKE_TIME) AS EVENT_DATE,"
    " date_trunc('month', EARTHQUAKE_TIME) AS EVENT_MONTH, CAST(year(EARTHQUAKE_TIME) AS INTEGER) AS EVENT_YEAR,"
    f" CAST(hour(EARTHQUAKE_TIME) AS INTEGER) AS EVENT_HOUR, {_AS_OF} AS DIM_LOADED_AT FROM z_events",
    "s_daily": f"SELECT {sk(stamp('EVENT_DATE'), 'REGION')} AS DAILY_SEISMIC_SK, *,"
    " CAST(strftime(EVENT_DATE, '%Y%m%d') AS INTEGER) AS DATE_SK, date_trunc('month', EVENT_DATE) AS EVENT_MONTH,"
    " CAST(year(EVENT_DATE) AS INTEGER) AS EVENT_YEAR, CAST(week(EVENT_DATE) AS INTEGER) AS EVENT_WEEK,"
    " CASE DAILY_RISK_LEVEL WHEN 'LOW' THEN 1 WHEN 'MODERATE' THEN 2 WHEN 'HIGH' THEN 3 ELSE 4 END"
    f" AS DAILY_RISK_SCORE, {_AS_OF} AS FACT_LOADED_AT FROM z_daily",
    "s_proximity": f"SELECT {sk('x.EVENT_ID', 'd.PORT_SK', 'CAST(round(x.DISTANCE_KM * 1000) AS BIGINT)')}"
    " AS PROXIMITY_SK, x.PROXIMITY_ID, e.SEISMIC_EVENT_SK, d.PORT_SK, x.EVENT_ID, x.PORT_NAME, x.DISTANCE_KM,"
    " x.RISK_SCORE, CASE WHEN x.RISK_SCORE < 25 OR x.RISK_SCORE IS NULL THEN 'LOW' WHEN x.RISK_SCORE < 50"
    " THEN 'MODERATE' WHEN x.RISK_SCORE < 75 THEN 'HIGH' ELSE 'CRITICAL' END AS RISK_BAND,"
    f" {_AS_OF} AS FACT_LOADED_AT FROM z_proximity x LEFT JOIN s_event e USING (EVENT_ID)"
    f" LEFT JOIN s_port d ON {name_key('x.PORT_NAME')} = {name_key('d.MAIN_PORT_NAME')}",
    "s_voyage_pairs": "SELECT v.*, d.PORT_SK AS DESTINATION_PORT_SK, d.WORLD_PORT_INDEX_NUMBER AS sk_index"
    " FROM z_details v LEFT JOIN x_aliases a"
    f" ON {name_key('v.DESTINATION_PORT_NAME')} = {name_key('a.RAW_NAME')} LEFT JOIN s_port d"
    f" ON {name_key('coalesce(a.MAPPED_NAME, v.DESTINATION_PORT_NAME)')} = {name_key('d.MAIN_PORT_NAME')}"
    f" AND (v.DESTINATION_PORT_COUNTRY IS NULL OR {name_key('v.DESTINATION_PORT_COUNTRY')} ="
    f" {name_key('d.COUNTRY_CODE')})",
    "s_voyage": f"SELECT {sk('NAME', stamp('REPORT_DATE'))} AS VOYAGE_SK,"
    " CAST(strftime(REPORT_DATE, '%Y%m%d') AS INTEGER) AS DATE_SK, NAME AS VESSEL_NAME, TYPE AS VESSEL_TYPE,"
    " * EXCLUDE (NAME, TYPE, n, sk_index, DEST_PORT_INDEX_NUMBER, DEST_PORT_COUNTRY_CODE, IS_ARRIVED,"
    f" IS_VALID_COORDINATES), {_AS_OF_V} AS FACT_LOADED_AT FROM (SELECT *, row_number() OVER (PARTITION BY NAME,"
    " REPORT_DATE ORDER BY DESTINATION_PORT_SK DESC NULLS LAST, DETAIL_LINK,"
    " (sk_index IS NOT DISTINCT FROM DEST_PORT_INDEX_NUMBER) DESC, DEST_PORT_INDEX_NUMBER NULLS LAST) AS n"
    " FROM s_voyage_pairs) WHERE n = 1",
    # recommendations
    "r_active": f"SELECT * EXCLUDE (n), CASE {_FACILITY} END AS NEED FROM (SELECT *, row_number() OVER"
    " (PARTITION BY NAME ORDER BY REPORT_DATE DESC NULLS FIRST, DETAIL_LINK) AS n FROM z_vessels"
    f" WHERE REPORTED_STATUS IN {words(fixed.ACTIVE_STATUSES)} AND NAME IS NOT NULL) WHERE n = 1",
    "r_risk": "SELECT x.PORT_NAME, max(x.RISK_SCORE) AS MAX_RISK_SCORE FROM z_proximity x JOIN z_events e"
    f" USING (EVENT_ID) WHERE e.EARTHQUAKE_TIME >= {_AS_OF} - INTERVAL 14 DAY GROUP BY x.PORT_NAME",
    "r_ports": "SELECT p.*, " + ", ".join(f"f.{c}" for c in fixed.FACILITY_FLAGS) + ","
    " coalesce((SELECT max(k.MAX_RISK_SCORE) FROM r_risk k"
    f" WHERE {name_key('k.PORT_NAME')} = {name_key('p.MAIN_PORT_NAME')}), 0) AS RISK"
    " FROM z_ports p JOIN z_facilities f USING (WORLD_PORT_INDEX_NUMBER) WHERE p.IS_VALID_COORDINATES",
    "r_scored": "SELECT *, least(100.0::DOUBLE, 50 + "
    + recode("lower(trim(SHELTER_AFFORDED))", {"excellent": 30, "good": 20, "fair": 10}, "0")
    + " + CASE WHEN lower(trim(PORT_SECURITY)) IN ('yes', 'y', 'true') THEN 20 ELSE 0 END) AS SAFETY, "
    + recode("PORT_DEPTH_CLASS", {"Deep": 100, "Medium": 65, "Shallow": 30}, "50") + "::DOUBLE AS DEPTH, "
    + recode("HARBOR_SIZE", {"Large": 100, "Medium": 70, "Small": 40, "Very Small": 20}, "50") + "::DOUBLE AS HARBOR,"
    " greatest(0.0::DOUBLE, 100 - RISK) AS SEISMIC FROM r_ports WHERE RISK < 90",
    "r_final": "SELECT *, DEPTH * 0.6::DOUBLE + HARBOR * 0.4::DOUBLE AS INFRA,"
    " SUPPLY_SCORE * 0.3::DOUBLE + (DEPTH * 0.6::DOUBLE + HARBOR * 0.4::DOUBLE) * 0.25::DOUBLE"
    " + SEISMIC * 0.3::DOUBLE + COMMUNICATION_SCORE * 0.15::DOUBLE AS FINAL FROM r_scored",
    "r_pairs": "SELECT v.NAME, v.TYPE, coalesce(v.LENGTH_M, 0) AS LENGTH, coalesce(v.BEAM_M, 0) AS BEAM,"
    " v.REPORTED_STATUS, v.DESTINATION_PORT_LAT, v.DESTINATION_PORT_LON, p.*, CAST(row_number() OVER (PARTITION BY"
    " v.NAME ORDER BY p.FINAL DESC, p.WORLD_PORT_INDEX_NUMBER) AS INTEGER) AS RANK FROM r_active v JOIN r_final p"
    " ON coalesce(p.MAXIMUM_VESSEL_LENGTH_M, 9999) >= coalesce(v.LENGTH_M, 0)"
    " AND coalesce(p.MAXIMUM_VESSEL_BEAM_M, 999) >= coalesce(v.BEAM_M, 0) AND (v.NEED IS NULL OR CASE v.NEED "
    + " ".join(f"WHEN '{c}' THEN p.{c}" for c in fixed.FACILITY_FLAGS)
    + " END = 1)",
    "r_out": f"SELECT CAST({_AS_OF} AS DATE) AS RUN_DATE, NAME AS VESSEL_NAME, TYPE AS VESSEL_TYPE, LENGTH AS"
    " VESSEL_LENGTH_M, BEAM AS VESSEL_BEAM_M, REPORTED_STATUS, RANK, MAIN_PORT_NAME AS RECOMMENDED_PORT_NAME,"
    " WORLD_PORT_INDEX_NUMBER, COUNTRY_CODE, REGION_NAME, HARBOR_SIZE, PORT_DEPTH_CLASS, LATITUDE, LONGITUDE,"
    f" {rnd('FINAL', 2)} AS FINAL_SCORE, {rnd('DIST', 2)} AS DISTANCE_KM,"
    f" {rnd('100 * exp(-DIST / 2000)', 2)} AS DISTANCE_SCORE, {rnd('INFRA', 2)} AS INFRASTRUCTURE_SCORE,"
    f" {rnd('SEISMIC', 2)} AS SEISMIC_SAFETY_SCORE, SUPPLY_SCORE::DOUBLE AS SUPPLY_SCORE,"
    " COMMUNICATION_SCORE::DOUBLE AS COMMUNICATION_SCORE, SAFETY AS SAFETY_SCORE, DEPTH AS DEPTH_SCORE,"
    f" {rnd('RISK', 2)} AS SEISMIC_RISK_SCORE FROM (SELECT *,"
    f" {haversine('DESTINATION_PORT_LAT', 'DESTINATION_PORT_LON', 'LATITUDE', 'LONGITUDE')} AS DIST FROM r_pairs"
    " WHERE RANK <= 3)",
}


def with_tables(sql: str) -> str:
    """The query with every table it needs in front, in order."""
    need: set[str] = set()

    def visit(text: str) -> None:
        for name in TABLES:
            if name not in need and re.search(rf"\b{name}\b", text):
                need.add(name)
                visit(TABLES[name])

    visit(sql)
    parts = [f"{n} AS ({t})" for n, t in TABLES.items() if n in need]
    return ("WITH " + ", ".join(parts) + " " if parts else "") + sql


def replaced(table: str, dates: str = "", stamps: str = "", rounded: dict[str, int] | None = None, where: str = "") -> str:
    """``SELECT *`` with dates and stamps as text and doubles rounded."""
    reps = [f"{day(c)} AS {c}" for c in dates.split()] + [f"{stamp(c)} AS {c}" for c in stamps.split()]
    reps += [f"{rnd(c, n)} AS {c}" for c, n in (rounded or {}).items()]
    replace = f" REPLACE ({', '.join(reps)})" if reps else ""
    return f"SELECT *{replace} FROM {table} {where}".strip()

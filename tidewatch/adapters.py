"""Domain inputs derived from the generic benchmark tables.

Everything is row-local integer arithmetic on the given tables, so each input
has as many rows as its table and grows with it. Names are spread so that the
number of same-named ports and aliases does not grow with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import fixed, schemas

AS_OF = "2024-01-31 00:00:00"  # just after the last event
VESSELS_AS_OF = "2001-08-01 12:00:00"  # just after the last order

MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS `{name}`" for name, expr in columns.items()])


def _cases(selector: str, n: int, values: list[str | None]) -> str:
    """``CASE`` over ``selector % n``; the last value is the default."""
    text = ["NULL" if v is None else f"'{v}'" for v in values]
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(text[:-1]))
    return f"CASE ({selector}) % {n} {whens} ELSE {text[-1]} END"


# --- seismic: three consecutive events are versions of one --------------------

SEISMIC = {
    "source_id": "cast(event_id AS string)",
    "source_catalog": "'CAT'",
    "lastupdate": "cast(ts AS timestamp)",
    "time": "cast(ts AS timestamp)",
    "flynn_region": "'REGION ' || cast(user_id % 500 AS string)",
    "lat": "cast((event_id * 7919) % 18001 AS double) / 100 - 90",
    "lon": "cast((event_id * 104729) % 36001 AS double) / 100 - 180",
    "depth": "CASE WHEN event_id % 17 = 0 THEN NULL ELSE cast((event_id * 31) % 700 AS double) END",
    "evtype": _cases("event_id", 5, ["ke", "se", "sl", "uk", "zz"]),
    "auth": "'AG' || cast(event_id % 4 AS string)",
    # steps of 1/512 are exact in binary, so means do not depend on the order of addition
    "mag": "CASE WHEN event_id % 29 = 0 THEN NULL"
    " ELSE cast(((event_id * 7919) % 64) * ((event_id * 7919) % 64) AS double) / 512 END",
    "magtype": _cases("event_id", 8, ["ml", "mb", "mw", "ms", "md", "mr", "m", "xx"]),
    "unid": "'ev' || cast(event_id - event_id % 3 AS string)",
    "action": "CASE event_id % 10 WHEN 9 THEN 'delete' WHEN 8 THEN 'update' ELSE 'create' END",
    "__deleted": "CASE WHEN event_id % 50 = 0 THEN 'true' WHEN event_id % 7 = 0 THEN NULL ELSE 'false' END",
}


def seismic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change rows of events; ``seq`` is the arrival order."""
    return _select(table(spark, sf_dir, "events"), {**SEISMIC, "seq": "event_id"})


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change rows with text times, as a feed carries them."""
    text = "date_format({}, 'yyyy-MM-dd HH:mm:ss')"
    rows = seismic(spark, sf_dir)
    return rows.withColumns({c: F.expr(text.format(c)) for c in ("time", "lastupdate")})


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON feed messages (``value``) with their offset ``seq``."""
    rows = live(spark, sf_dir)
    properties = F.struct(*[c for c in fixed.EVENT_COLUMNS if c not in ("unid", "action")])
    message = F.struct("action", F.struct(F.col("unid").alias("id"), properties.alias("properties")).alias("data"))
    return rows.select("seq", F.to_json(message).alias("value"))


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON change envelopes; events marked deleted come as deletes, every 41st is a tombstone."""
    rows = live(spark, sf_dir)
    state = F.struct(*fixed.EVENT_COLUMNS)
    gone = F.col("__deleted") == "true"
    envelope = F.struct(
        F.when(gone, state).alias("before"), F.when(~F.coalesce(gone, F.lit(False)), state).alias("after"),
        F.when(gone, "d").otherwise("c").alias("op"),
    )
    return rows.select("seq", F.when(F.col("seq") % 41 != 0, F.to_json(envelope)).alias("value"))


# --- ports: every tenth is listed twice, three share a name -------------------

_YES_NO = ["Yes", "No", "Unknown", "-", " Limited ", "N/A"]


def yes_no_sql(m: int) -> str:
    return _cases(f"(s_suppkey * {m}) % 31 + {m}", 6, _YES_NO)


def _port_columns() -> dict[str, str]:
    depth = {"Cargo_Pier_Depth_m": (13, 22), "Channel_Depth_m": (17, 19), "Anchorage_Depth_m": (11, 30),
             "Oil_Terminal_Depth_m": (7, 25), "Liquified_Natural_Gas_Terminal_Depth_m": (5, 20),
             "Tidal_Range_m": (3, 9), "Entrance_Width_m": (29, 300), "Maximum_Vessel_Length_m": (37, 400),
             "Maximum_Vessel_Beam_m": (41, 70), "Maximum_Vessel_Draft_m": (43, 24)}
    columns = {
        "OID_": "cast(s_suppkey * 2 + copy AS double)",
        "World_Port_Index_Number": "cast(s_suppkey AS double)",
        "Region_Name": "'REGION_' || cast(s_nationkey % 5 AS string)",
        "Main_Port_Name": "CASE WHEN s_suppkey % 11 = 0 THEN '  Port ' ELSE 'PORT ' END"
        " || cast((s_suppkey - s_suppkey % 3) / 3 AS bigint) || CASE WHEN s_suppkey % 13 = 0 THEN ' ' ELSE '' END",
        "Alternate_Port_Name": "CASE WHEN s_suppkey % 4 = 0 THEN ' ' ELSE s_name END",
        "UN_LOCODE": "CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE 'LC' || cast(s_suppkey AS string) END",
        "Country_Code": "CASE WHEN s_suppkey % 19 = 0 THEN ' ' ELSE 'NATION_' || cast(s_nationkey AS string) END",
        "World_Water_Body": "'SEA ' || cast(s_suppkey % 7 AS string)",
        "Harbor_Size": _cases("s_suppkey + copy", 6, ["Very Small", "Small", "Medium", "Large", "", "Unknown"]),
        "Shelter_Afforded": _cases("s_suppkey * 5", 4, ["Excellent", "Good", "Fair", "None"]),
        "Dry_Dock": _cases("s_suppkey", 5, ["Small", "Medium", "Large", "Unknown", "-"]),
        "Repairs": _cases("s_suppkey", 7, ["Major", "Moderate", "Limited", "Emergency Only", "None", "N/A", "-"]),
        "Latitude": "cast((s_suppkey * 7919 + 1234) % 18001 AS double) / 100 - 90",
        "Longitude": "CASE WHEN s_suppkey % 23 = 0 THEN cast(999 AS double)"
        " ELSE cast((s_suppkey * 104729 + 5678) % 36001 AS double) / 100 - 180 END",
    }
    columns.update({c: f"cast((s_suppkey * {a}) % {b} AS double)" for c, (a, b) in depth.items()})
    kept = [c for c in fixed.PORT_COLUMNS if c.upper() in fixed.PORT_CATEGORY_KEPT and c not in columns]
    columns.update({c: yes_no_sql(7 + 2 * i) for i, c in enumerate(kept)})
    return columns


PORTS = _port_columns()


def ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 109 directory columns; those not derived are NULL."""
    listed = table(spark, sf_dir, "supplier").selectExpr(
        "*", "explode(CASE WHEN s_suppkey % 10 = 0 THEN array(0, 1) ELSE array(0) END) AS copy"
    )
    absent = "cast(NULL AS {})"
    columns = {
        f.name: PORTS.get(f.name, absent.format(f.dataType.simpleString())) for f in schemas.PORTS.fields
    }
    return _select(listed, columns)


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchorage names: one per fourth port name, every eighth with a second target."""
    number = "cast(s_suppkey / 3 AS bigint)"
    first = table(spark, sf_dir, "supplier").filter("s_suppkey % 12 = 0")
    one = first.selectExpr(f"'ANCH ' || {number} AS RAW_NAME", f"'PORT ' || {number} AS MAPPED_NAME")
    two = first.filter("s_suppkey % 24 = 0").selectExpr(
        f"' Anch ' || {number} AS RAW_NAME", f"'PORT ' || ({number} + 1) AS MAPPED_NAME"
    )
    return one.unionByName(two)


# --- vessels: an order is a report, the customer is the vessel ----------------

_MD = "substr('" + MONTHS + "', (month({d}) - 1) * 3 + 1, 3) || ' ' || cast(day({d}) AS string)"
_DAY = "cast(o_orderdate AS date)"
_DEP = f"({_DAY} - cast(o_orderkey % 20 AS int))"
_ETA = f"({_DAY} + cast(o_orderkey % 25 AS int))"
_PORT_NUMBER = "cast((o_custkey - o_custkey % 40) / 40 AS bigint)"

VESSELS = {
    "name": "CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_custkey % 7 = 0 THEN ' V' ELSE 'V' END"
    " || cast(o_custkey AS string)",
    "type": _cases("o_custkey", 9, [
        "Bulk Carrier", "Container Ship", "Chemical/Oil Products Tanker", "Ro-Ro Cargo Ship", "General Cargo Ship",
        "Vehicles Carrier", "Liquid Bulk Carrier", "Crude Oil Tanker", "Cargo"]),
    "year_built": "CASE WHEN o_custkey % 11 = 0 THEN '-' ELSE cast(1965 + o_custkey % 37 AS string) END",
    "gross_tonnage": "cast(5000 + (o_custkey * 37) % 90000 AS string)",
    "deadweight": "CASE WHEN o_custkey % 13 = 0 THEN '-' WHEN o_custkey % 17 = 0 THEN '40000.5'"
    " ELSE cast(8000 + (o_custkey * 41) % 90000 AS string) END",
    "length(m)": "CASE o_custkey % 12 WHEN 0 THEN '' WHEN 1 THEN '12d' WHEN 2 THEN '120.5'"
    " ELSE cast(60 + (o_custkey * 7) % 300 AS string) END",
    "beam(m)": "CASE o_custkey % 12 WHEN 0 THEN '' ELSE cast(10 + (o_custkey * 3) % 50 AS string) END",
    "detail_link": "'/d/' || cast(o_orderkey AS string)",
    "departure_date": f"CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'ATA: ' || {_MD.format(d=_DEP)}"
    f" || ', 08:27 UTC(2 days ago)' ELSE 'ATD: ' || {_MD.format(d=_DEP)} || ', 19:11 UTC(5 days ago)' END",
    "last_port_country": "'NATION_' || cast(o_custkey % 25 AS string)",
    "last_port_name": "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 'PORT ' || cast(o_orderkey % 30 AS string) END",
    "arrival_date": f"CASE o_orderkey % 5 WHEN 0 THEN 'ETA: -' WHEN 1 THEN 'ATA: ' || {_MD.format(d=_DAY)}"
    f" || ', 04:28 UTCARRIVED' ELSE 'ETA: ' || {_MD.format(d=_ETA)} || ', 01:00' END",
    "destination_port_country": "CASE WHEN o_orderkey % 2 = 0 THEN NULL"
    " ELSE ' nation_' || cast(o_custkey % 25 AS string) END",
    "destination_port_name": "CASE WHEN o_orderkey % 3 = 0 THEN NULL"
    f" WHEN o_orderkey % 10 = 1 THEN 'anch ' || cast({_PORT_NUMBER} AS string)"
    f" WHEN o_orderkey % 10 = 2 THEN ' Port ' || cast({_PORT_NUMBER} AS string) || ' '"
    f" ELSE 'PORT ' || cast({_PORT_NUMBER} AS string) END",
    "destination_port_lat": "CASE o_orderkey % 6 WHEN 0 THEN '49.29N' WHEN 1 THEN 'None' WHEN 2 THEN ''"
    " ELSE cast(cast(o_custkey % 89 AS double) + 0.25 AS string) END",
    "destination_port_lon": "CASE o_orderkey % 6 WHEN 0 THEN '123.10W' WHEN 1 THEN 'None' WHEN 2 THEN NULL"
    " WHEN 3 THEN '999.5' ELSE cast(cast(o_custkey % 179 AS double) + 0.5 AS string) END",
    "reported_status": _cases("o_orderkey", 8, ["Under way", "-", "", " Moored ", "At anchor", "Sailing", "None", None]),
    "report_date": f"CASE WHEN o_orderkey % 101 = 0 THEN 'x' ELSE cast({_DAY} AS string) || ' 10:30' END",
}


def vessels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 18 text columns of a snapshot plus the load stamp."""
    columns = {
        **VESSELS,
        "_INGESTED_AT": "cast(o_orderdate + make_dt_interval(0, cast(o_orderkey % 5 AS int)) AS timestamp)",
    }
    return _select(table(spark, sf_dir, "orders"), columns)


# --- pages: list and detail pages written from the orders ---------------------

LIST_ROWS = 20  # rows per list page


def list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List pages with a table of up to 20 vessels each (``url, html``)."""
    cells = [
        "'<td><a class=\"l\" href=\"/d/' || o_orderkey || '\">V' || o_custkey ||"
        " CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '<br>R&amp;D Ship' END || '</a></td>'",
        "'<td>' || CASE WHEN o_custkey % 11 = 0 THEN '' ELSE cast(1965 + o_custkey % 37 AS string) END || '</td>'",
        "'<td> ' || (5000 + (o_custkey * 37) % 90000) || ' </td>'",
        "'<td>' || (8000 + (o_custkey * 41) % 90000) || '</td>'",
        "CASE WHEN o_orderkey % 19 = 0 THEN '' ELSE '<td>' || CASE WHEN o_orderkey % 7 = 0 THEN '-' ELSE"
        " (60 + (o_custkey * 7) % 300) || ' / ' || (10 + (o_custkey * 3) % 50) || ' m' END || '</td>' END",
    ]
    row = " || ".join(cells)
    rows = table(spark, sf_dir, "orders").selectExpr(
        f"cast((o_orderkey - o_orderkey % {LIST_ROWS}) / {LIST_ROWS} AS bigint) AS page",
        "o_orderkey", f"'<tr>' || {row} || '</tr>' AS tr",
    )
    # a page groups LIST_ROWS consecutive keys, so the array has a fixed bound
    grouped = rows.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "tr"))).alias("rows"))
    body = F.array_join(F.transform("rows", lambda r: r["tr"]), "\n")
    head = "<html><body><table class=\"t\">\n<tr><th>Vessel</th><th>Built</th></tr>\n"
    return grouped.select(
        F.concat(F.lit("/list/"), F.col("page").cast("string")).alias("url"),
        F.when(F.col("page") % 2 == 0, "Cargo").otherwise("Tanker").alias("page_type"),
        F.concat(F.lit(head), body, F.lit("\n</table></body></html>")).alias("html"),
    )


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail pages (``url, html``), one per order."""
    anchor = "'<a class=\"_npNa\" href=\"/p/' || {n} || '\">PORT ' || {n} || {country} || '</a>'"
    last = anchor.format(n="(o_orderkey % 30)", country="', NATION ' || (o_custkey % 25)")
    dest = anchor.format(n=_PORT_NUMBER, country="CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE ', Country&nbsp;X' END")
    html = (
        "'<html><body>'"
        f" || CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE '<div class=\"vi__r1 vi__stp\"><div>' || {last}"
        f" || '</div><div class=\"_value\"> ATD: ' || {_MD.format(d=_DEP)} || ', 19:11 UTC</div></div>' END"
        f" || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '<div class=\"vi__r1 vi__sbt\"><div>' || {dest}"
        f" || '</div><div class=\"_value\"><b>ETA: </b>' || {_MD.format(d=_ETA)} || ', 01:00</div></div>' END"
        " || CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '<table><tr><td>Navigation Status</td><td> ' ||"
        " CASE WHEN o_orderkey % 2 = 0 THEN 'Under way' ELSE 'Moored' END"
        " || '</td></tr><tr><td>x</td></tr></table>' END || '</body></html>'"
    )
    return table(spark, sf_dir, "orders").selectExpr("'/d/' || o_orderkey AS url", f"{html} AS html")


def port_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Port pages (``url, html``) with the coordinate sentence; every fifth lacks it."""
    html = (
        "'<p class=\"text1\">\nPort ' || s_suppkey || ' lies at ' || (s_suppkey % 90) || '.25N, ' ||"
        " CASE WHEN s_suppkey % 4 = 0 THEN 'near NATION, ' ELSE '' END || (s_suppkey % 180) || '.50E.\nMore, text.</p>'"
    )
    return table(spark, sf_dir, "supplier").selectExpr(
        "'/p/' || s_suppkey AS url", f"CASE WHEN s_suppkey % 5 = 0 THEN '<p>none</p>' ELSE {html} END AS html"
    )


def schema_of_live() -> T.StructType:
    """Schema of live rows (the event columns with ``event_time``)."""
    return T.StructType(
        [T.StructField("event_time" if f.name == "time" else f.name, f.dataType) for f in schemas.EVENT_ROW.fields]
    )

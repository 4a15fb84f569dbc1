"""Queries for readers, writers and merges (A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch import adapters as A
from tidewatch import fixed
from tidewatch.operators import dedup, joins, merge
from tidewatch.plans import silver
from tidewatch.registry.base import query
from tidewatch.registry.common import Domain
from tidewatch.session import scratch
from tidewatch.sources import readers, writers
from tidewatch.sources.keyed import KeyedTable

C = F.col

_RAW_PORT = ["OID_", "World_Port_Index_Number", "Main_Port_Name", "UN_LOCODE", "Harbor_Size", "Repairs", "Channel_Depth_m",
             "Railway", "Latitude", "Longitude"]


def _csv(df, path: str, **options) -> str:
    writer = df.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).options(**options).csv(path)
    return path


@query(
    "a1_read_ports",
    "SELECT " + ", ".join("CAST(NULL AS VARCHAR) AS Railway" if c == "Railway" else
                          "nullif(UN_LOCODE, '') AS UN_LOCODE" if c == "UN_LOCODE" else
                          "nullif(Harbor_Size, '') AS Harbor_Size" if c == "Harbor_Size" else c for c in _RAW_PORT)
    + " FROM x_ports",
)
def a1(spark, sf_dir):
    """A1: the 109-column directory written as CSV and read back."""
    path = _csv(Domain(spark, sf_dir).ports(), scratch(spark, "ports-csv"), emptyValue="", escape='"')
    return readers.read_ports(spark, path).select(*_RAW_PORT)


@query(
    "a2_read_vessels",
    "SELECT detail_link, name, nullif(departure_date, '') AS departure_date,"
    " destination_port_name, nullif(reported_status, '') AS reported_status, report_date,"
    " '2024-01-31 00:00:00' AS \"_INGESTED_AT\" FROM x_vessels",
)
def a2(spark, sf_dir):
    """A2: snapshots below year= and month= folders, read back with a load stamp."""
    raw = Domain(spark, sf_dir).vessels().select(*[C(f"`{c}`") for c in fixed.VESSEL_COLUMNS])
    dated = raw.withColumns({"year": F.substring("report_date", 1, 4), "month": F.substring("report_date", 6, 2)})
    root = scratch(spark, "vessels-csv")
    writer = dated.write.partitionBy("year").option("header", True).option("emptyValue", "")
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(root)
    return readers.read_vessel_files(spark, root, A.AS_OF).select(
        "detail_link", "name", "departure_date", "destination_port_name", "reported_status", "report_date", "_INGESTED_AT")


_DAY, _OTHER_DAY = "1995-06-19", "1997-02-01"


@query(
    "a2_read_vessels_day",
    "SELECT detail_link, name, report_date, '2024-01-31 00:00:00' AS \"_INGESTED_AT\" FROM x_vessels"
    f" WHERE substr(report_date, 1, 10) = '{_DAY}'",
)
def a2_day(spark, sf_dir):
    """A2: two days written to their places, one of them read."""
    raw = Domain(spark, sf_dir).vessels().select(*[C(f"`{c}`") for c in fixed.VESSEL_COLUMNS])
    root = scratch(spark, "vessel-days")
    for day in (_DAY, _OTHER_DAY):
        _csv(raw.where(C("report_date").startswith(day)), readers.vessels_path(root, day), emptyValue="", escape='"')
    return readers.read_vessels(spark, root, _DAY, A.AS_OF).select("detail_link", "name", "report_date", "_INGESTED_AT")


@query(
    "a3_replace_day",
    f"SELECT detail_link, report_date FROM x_vessels WHERE substr(report_date, 1, 10) = '{_DAY}'"
    " AND destination_port_name IS NOT NULL OR substr(report_date, 1, 10) = '" + _OTHER_DAY + "'",
)
def a3_day(spark, sf_dir):
    """A3: two days loaded, then one of them loaded again from fewer reports."""
    rows = Domain(spark, sf_dir).vessels().select("detail_link", "report_date", "destination_port_name")
    path = scratch(spark, "vessel-loads")
    for day in (_DAY, _OTHER_DAY):
        writers.replace_day(rows, path, day)
    writers.replace_day(rows.where("destination_port_name IS NOT NULL"), path, _DAY)
    return spark.read.schema(rows.schema).parquet(path).select("detail_link", "report_date")


@query(
    "a3_replace_slices",
    "SELECT source_id, action FROM (SELECT *, CAST(time AS DATE) AS d FROM x_seismic) WHERE action = 'update'"
    " OR d NOT IN (SELECT CAST(time AS DATE) FROM x_seismic WHERE action = 'update')",
)
def a3(spark, sf_dir):
    """A3: all event days loaded, then the days with updates loaded again from the updates only."""
    rows = Domain(spark, sf_dir).seismic().select(
        "source_id", "action", F.date_format("time", "yyyy-MM-dd").alias("report_day"))
    path = scratch(spark, "slices")
    writers.replace_slices(rows, path, "report_day")
    writers.replace_slices(rows.filter("action = 'update'"), path, "report_day")
    return spark.read.parquet(path).select("source_id", "action")


@query(
    "a4_append_load",
    "SELECT World_Port_Index_Number AS WORLD_PORT_INDEX_NUMBER, min(OID_) AS OID_, '2024-02-29 00:00:00' AS \"_LOADED_AT\""
    " FROM x_ports GROUP BY ALL",
)
def a4(spark, sf_dir):
    """Two appended loads; the newer one wins a tie of object ids."""
    ports, path = Domain(spark, sf_dir).ports(), scratch(spark, "loads")
    for loaded in ("2024-01-31 00:00:00", "2024-02-29 00:00:00"):
        writers.append_load(ports, path, loaded)
    return dedup.first_port_records(silver.prune_ports(spark.read.parquet(path))).select(
        "WORLD_PORT_INDEX_NUMBER", "OID_", "_LOADED_AT")


@query(
    "a4_load_once",
    "SELECT World_Port_Index_Number, '2024-01-31 00:00:00' AS \"_LOADED_AT\" FROM x_ports UNION ALL"
    " SELECT World_Port_Index_Number, '2024-03-31 00:00:00' FROM x_ports WHERE Harbor_Size = 'Small'",
)
def a4_once(spark, sf_dir):
    """A4: a month's file offered in two runs counts once; the next month's comes with the third."""
    ports, root = Domain(spark, sf_dir).ports(), scratch(spark, "monthly")

    def run(loaded):
        files = readers.stream_ports(spark, f"{root}/in")
        writers.append_new_files(files, f"{root}/out", f"{root}/ledger", loaded).awaitTermination()

    _csv(ports, f"{root}/in/2024-01", emptyValue="", escape='"')
    run("2024-01-31 00:00:00")
    run("2024-02-29 00:00:00")
    _csv(ports.filter("Harbor_Size = 'Small'"), f"{root}/in/2024-03", emptyValue="", escape='"')
    run("2024-03-31 00:00:00")
    return spark.read.parquet(f"{root}/out").select("World_Port_Index_Number", "_LOADED_AT")


@query("a5_write_snapshot", "SELECT detail_link, report_date, CAST(NULL AS VARCHAR) AS type FROM x_vessels")
def a5(spark, sf_dir):
    """A5: a snapshot with an absent column; the second write finds it there and does nothing."""
    raw, path = Domain(spark, sf_dir).vessels(), scratch(spark, "snapshot")
    writers.write_snapshot(raw.drop("type"), path)
    writers.write_snapshot(raw.filter("name IS NULL"), path)
    return readers.read_vessel_files(spark, path, A.AS_OF).select("detail_link", "report_date", "type")


@query(
    "a6_route_quarantine",
    "SELECT 'good' AS place, count(*) AS n FROM x_vessels UNION ALL SELECT 'quarantine', count(*) FROM x_vessels",
)
def a6(spark, sf_dir):
    """A good snapshot and one without its type column."""
    raw, root = Domain(spark, sf_dir).vessels(), scratch(spark, "route")
    writers.route_quarantine(raw, f"{root}/good", f"{root}/unused")
    writers.route_quarantine(raw.drop("type"), f"{root}/unused", f"{root}/quarantine")

    def count(place):
        rows = readers.read_vessel_files(spark, f"{root}/{place}", A.AS_OF)
        return rows.agg(F.count("*").alias("n")).select(F.lit(place).alias("place"), "n")

    return count("good").unionByName(count("quarantine"))


@query(
    "a6_row_quarantine",
    "SELECT detail_link, report_date, CASE WHEN name IS NOT NULL AND destination_port_name IS NOT NULL THEN 'good' ELSE 'bad' END"
    " AS verdict FROM x_vessels",
)
def a6_rows(spark, sf_dir):
    """Every report on one side, by whether it names vessel and destination; both sides read back."""
    path = scratch(spark, "sides")
    rule = C("name").isNotNull() & C("destination_port_name").isNotNull()
    writers.split_quarantine(Domain(spark, sf_dir).vessels(), path, rule)
    sides = [writers.read_verdict(spark, path, v).withColumn("verdict", F.lit(v)) for v in ("good", "bad")]
    return sides[0].unionByName(sides[1]).select("detail_link", "report_date", "verdict")


@query(
    "a7_write_recommendations",
    "SELECT o_orderkey AS VESSEL, strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS RUN_DATE,"
    " o_totalprice AS FINAL_SCORE FROM orders",
)
def a7(spark, sf_dir):
    """A run with history written twice; every run day holds its last write."""
    rows = A.table(spark, sf_dir, "orders").select(
        C("o_orderkey").alias("VESSEL"), F.trunc("o_orderdate", "year").alias("RUN_DATE"),
        C("o_totalprice").alias("FINAL_SCORE"))
    path = scratch(spark, "recommendations")
    for _ in range(2):
        writers.write_recommendations(rows, path, history=True)
    return spark.read.parquet(path)


@query("a8_materialize_table", "SELECT EVENT_ID, MAGNITUDE_CLASS FROM z_events")
def a8(spark, sf_dir):
    """A table stored in its layer and read from there."""
    events = Domain(spark, sf_dir).gold_events()
    stored = writers.materialize_table(events, " gold ", "events", scratch(spark, "gold-db"))
    return stored.select("EVENT_ID", "MAGNITUDE_CLASS")


def _merge_sides(spark, sf_dir):
    """Last created and last updated version per event."""
    rows = Domain(spark, sf_dir).seismic().select("unid", "source_id", "action", "mag", "lastupdate", "seq")
    pick = [C("seq").desc()]
    return (
        dedup.top_per_key(rows.filter("action = 'create'"), ["unid"], pick),
        dedup.top_per_key(rows.filter("action = 'update'"), ["unid"], pick),
    )


_MERGED = (
    "SELECT unid, source_id, action FROM (SELECT *, row_number() OVER (PARTITION BY unid ORDER BY"
    " (action = 'update') DESC, seq DESC) AS n FROM x_seismic WHERE action IN ('create', 'update')) WHERE n = 1"
)


@query("a9_merge_incremental", _MERGED)
def a9(spark, sf_dir):
    """Updates merged over created rows."""
    created, updated = _merge_sides(spark, sf_dir)
    return merge.merge_incremental(created, updated, ["unid"]).select("unid", "source_id", "action")


@query("a9_keyed_table", _MERGED)
def a9_keyed(spark, sf_dir):
    """A9 stored: both sides merged into a keyed table, the second twice."""
    created, updated = _merge_sides(spark, sf_dir)
    table = KeyedTable(spark, scratch(spark, "keyed"), created.schema, ["unid"], buckets=16)
    combine = lambda target, batch: merge.merge_incremental(target, batch, ["unid"])
    for batch in (created, updated, updated):
        table.merge(batch, combine)
    return table.read().select("unid", "source_id", "action")


@query(
    "a10_sync_all_columns",
    "SELECT unid, source_id, CASE WHEN action = 'update' THEN mag END AS new_mag FROM (" + _MERGED.replace(
        "SELECT unid, source_id, action FROM", "SELECT * FROM") + ")",
)
def a10(spark, sf_dir):
    """A10: the batch has a new column and lacks others."""
    created, updated = _merge_sides(spark, sf_dir)
    batch = updated.select("unid", "source_id", C("mag").alias("new_mag"))
    return merge.sync_all_columns(merge.merge_incremental(created, batch, ["unid"]), batch)


@query("a11_load_seed", "SELECT DETAIL_LINK, MAPPED_NAME FROM z_vessels_mapped")
def a11(spark, sf_dir):
    """Aliases from a CSV, used on every vessel report."""
    d = Domain(spark, sf_dir)
    seed = readers.load_seed(spark, _csv(d.aliases(), scratch(spark, "seed")))
    return joins.map_alias(d.gold_vessels(), seed).select("DETAIL_LINK", "MAPPED_NAME")


_FLAT = ", ".join(c for c in fixed.EVENT_COLUMNS if c != "action")


@query("a13_geojson_events", f"SELECT {_FLAT}, 'create' AS action FROM x_live")
def a13(spark, sf_dir):
    """Events packed into backfill documents of 20 features and unpacked again."""
    rows = Domain(spark, sf_dir).changes()
    props = F.struct(*[c for c in fixed.EVENT_COLUMNS if c not in ("unid", "action")])
    feature = F.struct(C("unid").alias("id"), props.alias("properties"))
    # twenty consecutive arrivals per document
    docs = rows.groupBy(F.floor(C("seq") / 20).alias("doc")).agg(F.collect_list(feature).alias("features"))
    return readers.parse_geojson_events(docs.select(F.to_json(F.struct("features")).alias("value")))


@query("a14_event_messages", f"SELECT {_FLAT}, action FROM x_live")
def a14(spark, sf_dir):
    """Feed messages parsed into rows."""
    return readers.parse_event_messages(A.event_messages(spark, sf_dir))


@query("a17_load_stats", "SELECT count(*) AS n, true AS has_bytes FROM x_seismic")
def a17(spark, sf_dir):
    """Rows counted while writing, files and bytes after."""
    watched, watch = writers.observed(Domain(spark, sf_dir).seismic(), "a17")
    path = scratch(spark, "stats")
    watched.write.parquet(path)
    stats = writers.load_stats(spark, path, watch.get["rows"])
    return spark.createDataFrame([(stats["rows"], stats["bytes"] > 0)], "n bigint, has_bytes boolean")



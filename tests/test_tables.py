"""Readers, writers, merges, checks, rebuilds and streams."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tidewatch import fixed, schemas
from tidewatch.operators import dedup, filters, merge, pages, quality
from tidewatch.plans import rebuild as rebuilds
from tidewatch.plans import silver
from tidewatch.session import scratch, shared_root
from tidewatch.sources import readers, writers
from tidewatch.sources.keyed import KeyedTable
from tidewatch.streaming import cdc, events

C = F.col
ACTIONS = "unid string, action string, seq long, v string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- readers and writers --------------------------------------------------------


def test_bad_port_lines_are_skipped_whatever_is_selected(spark, tmp_path):
    good = ",".join("1.5" if c in fixed.PORT_DOUBLE_COLUMNS else f'"{c}, x"' for c in fixed.PORT_COLUMNS)
    bad = good.replace("1.5", "deep", 1)
    (tmp_path / "p.csv").write_text("\n".join([",".join(fixed.PORT_COLUMNS), good, bad, good]) + "\n")
    read = readers.read_ports(spark, str(tmp_path / "p.csv"))
    assert len(read.columns) == 109
    assert read.select("Main_Port_Name").collect()[0][0] == "Main_Port_Name, x"
    assert read.select("Main_Port_Name").count() == read.count() == 2


def test_doubled_quotes_in_ports(spark, tmp_path):
    line = ",".join("1.5" if c in fixed.PORT_DOUBLE_COLUMNS else '"x ""y"", z"' for c in fixed.PORT_COLUMNS)
    (tmp_path / "p.csv").write_text("\n".join([",".join(fixed.PORT_COLUMNS), line]) + "\n")
    assert [r[0] for r in readers.read_ports(spark, str(tmp_path / "p.csv")).select("Main_Port_Name").collect()] == ['x "y", z']


def test_day_snapshot(spark, tmp_path):
    folder = tmp_path / "year=2026" / "month=05"
    folder.mkdir(parents=True)
    line = ["A", "", *["x"] * 6, '"ATD: May 14, 19:11 UTC(5 days ago)"', *["x"] * 8, "2026-05-19 22:44"]
    (folder / "vessels_2026-05-19.csv").write_text(",".join(fixed.VESSEL_COLUMNS) + "\n" + ",".join(line) + "\n")
    got = readers.read_vessels(spark, str(tmp_path), "2026-05-19", "2026-05-20 01:00:00").first()
    assert (got["name"], got["type"], got["departure_date"]) == ("A", None, "ATD: May 14, 19:11 UTC(5 days ago)")
    assert got["_INGESTED_AT"] == dt.datetime(2026, 5, 20, 1)


def vessel_frame(spark, n, day="2026-05-19", **fixed_values):
    data = [tuple(fixed_values.get(c, f"{c}{i}" if c != "report_date" else f"{day} 10:00") for c in fixed.VESSEL_COLUMNS)
            for i in range(n)]
    return spark.createDataFrame(data, schemas.VESSELS)


def test_replace_day_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "bronze")
    both = vessel_frame(spark, 3, "2026-05-19").unionByName(vessel_frame(spark, 5, "2026-05-20"))
    writers.replace_day(both, path, "2026-05-19")
    writers.replace_day(both, path, "2026-05-20")
    writers.replace_day(vessel_frame(spark, 2, "2026-05-20"), path, "2026-05-20")
    writers.replace_day(vessel_frame(spark, 2, "2026-05-20"), path, "2026-05-20")
    got = spark.read.parquet(path).groupBy("report_day").count()
    assert sorted((str(r[0]), r[1]) for r in got.collect()) == [("2026-05-19", 3), ("2026-05-20", 2)]


def test_snapshot_is_written_once(spark, tmp_path):
    path = str(tmp_path / "s")
    writers.write_snapshot(vessel_frame(spark, 3).drop("type"), path)
    writers.write_snapshot(vessel_frame(spark, 9), path)
    got = readers.read_vessel_files(spark, path, "2026-05-20 00:00:00")
    assert got.count() == 3 and got.filter("type IS NOT NULL").count() == 0


def test_recommendations_replace_or_keep_history(spark, tmp_path):
    frame = lambda day, n: spark.range(n).select(F.lit(day).cast("date").alias("RUN_DATE"), "id")
    last, all_ = str(tmp_path / "last"), str(tmp_path / "all")
    for day, n in (("2026-05-19", 4), ("2026-05-20", 3), ("2026-05-20", 2)):
        writers.write_recommendations(frame(day, n), last)
        writers.write_recommendations(frame(day, n), all_, history=True)
    assert spark.read.parquet(last).count() == 2
    assert spark.read.parquet(all_).count() == 6


def test_layer_names():
    assert writers.layer_table(" star ", "dim_port") == "STAR.dim_port"
    assert writers.layer_table(None, "x", "silver") == "silver.x"


def test_feed_messages(spark):
    props = {"source_id": "1", "mag": 5.5, "time": "2026-05-01T00:00:00Z"}
    texts = [json.dumps({"action": "UPDATE", "data": {"id": "e1", "properties": props}}),
             json.dumps({"data": {"id": "e2", "properties": {"mag": None}}}), json.dumps({"action": "create"}), "{broken"]
    got = readers.parse_event_messages(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    assert [(r["unid"], r["action"], r["mag"]) for r in got] == [("e1", "update", 5.5), ("e2", "create", None)]
    doc = json.dumps({"features": [{"id": "e1", "properties": props}, {"id": "e2", "properties": {}}]})
    got = readers.parse_geojson_events(spark.createDataFrame([(doc,)], "value string")).collect()
    assert [(r["unid"], r["action"], r["source_id"]) for r in got] == [("e1", "create", "1"), ("e2", "create", None)]


def test_scratch_is_below_the_named_folder(spark):
    assert scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir", None) or shared_root(spark))
    assert scratch(spark, "x") != scratch(spark, "x")


def test_registry_header_is_stripped(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x07payload"),)], "value binary")
    assert bytes(df.select(cdc.strip_registry_header(C("value"))).first()[0]) == b"payload"


# --- windows ----------------------------------------------------------------------


def test_null_order_of_latest_rows(spark):
    ev = spark.createDataFrame([("e", "2026-01-01", "1"), ("e", None, "2")], "EVENT_ID string, LAST_UPDATED_AT string, SOURCE_ID string")
    assert dedup.latest_events(ev).first()["SOURCE_ID"] == "2"
    ve = spark.createDataFrame([("v", 1, None, "a"), ("v", 1, "2026", "b"), ("v", 1, "2026", "c")],
                               "NAME string, REPORT_DATE int, _INGESTED_AT string, DETAIL_LINK string")
    assert dedup.latest_vessel_reports(ve).first()["DETAIL_LINK"] == "b"


def test_old_report_under_way_beats_newer_moored(spark):
    df = spark.createDataFrame([("v", 1, "Under way", "a"), ("v", 2, "Moored", "b"), ("w", 1, "Moored", "c")],
                               "NAME string, REPORT_DATE int, REPORTED_STATUS string, DETAIL_LINK string")
    assert [r["DETAIL_LINK"] for r in dedup.active_vessels(df).collect()] == ["a"]


def test_soft_delete_forms_differ_on_odd_marks(spark):
    df = spark.createDataFrame([("true",), ("false",), (None,), ("maybe",)], "__deleted string")
    assert sorted(str(r[0]) for r in filters.drop_soft_deleted(df).collect()) == ["None", "false"]
    assert sorted(str(r[0]) for r in filters.drop_soft_deleted_live(df).collect()) == ["None", "false", "maybe"]


def test_empty_target_means_full_load(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1),), (None,)], "t timestamp")
    assert filters.above_watermark(df, "t", None).count() == 2
    assert filters.above_watermark(df, "t", dt.datetime(2025, 1, 1)).count() == 1


# --- merges -----------------------------------------------------------------------


def test_merge_twice_is_merge_once_and_null_keys_never_match(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    batch = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    once = merge.merge_incremental(target, batch, ["k"])
    assert sorted(map(str, [tuple(r) for r in once.collect()])) == sorted(
        map(str, [("a", 1), (None, 3), ("b", 20), ("c", 30)]))
    assert merge.merge_incremental(once, batch, ["k"]).count() == 4


def test_schema_change(spark):
    target = spark.createDataFrame([("a", 1, 1)], "k string, v int, gone int")
    batch = spark.createDataFrame([("b", 2, "n")], "k string, v int, fresh string")
    merged = merge.merge_incremental(target, batch, ["k"])
    synced = merge.sync_all_columns(merged, batch)
    assert synced.columns == ["k", "v", "fresh"]
    assert rows(synced.select("k", "v")) == [("a", 1), ("b", 2)]


def replay(messages, held=()):
    table = dict(held)
    for unid, action, _, v in sorted(messages, key=lambda m: m[2]):
        action = action.lower()
        if action in ("update", "delete"):
            table.pop(unid, None)
        if action in ("create", "update") and unid not in table:
            table[unid] = v
    return sorted(table.items())


def test_actions_of_the_guide_case(spark):
    m = [("e1", "create", 1, "a"), ("e1", "update", 2, "b"), ("e1", "delete", 3, "c"), ("e2", "create", 4, "d"),
         ("e2", "create", 5, "e"), ("e3", "odd", 6, "f")]
    df = spark.createDataFrame(m, ACTIONS)
    got = merge.apply_event_actions(spark.createDataFrame([], ACTIONS), df)
    assert rows(got.select("unid", "v")) == [("e2", "d")]


@pytest.mark.parametrize("seed", range(3))
def test_actions_equal_replay_in_any_batches(spark, tmp_path, seed):
    rng = random.Random(seed)
    messages = [(f"e{rng.randint(0, 12) if i % 3 else 0}", rng.choice(["create", "Update", "DELETE"]), i, f"v{i}")
                for i in range(120)]
    df = spark.createDataFrame(messages, ACTIONS)
    table = KeyedTable(spark, str(tmp_path / "t"), df.schema, ["unid"], buckets=4)
    cuts = [0, *sorted(rng.sample(range(1, 119), 2)), 120]
    for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        part = df.filter((C("seq") >= a) & (C("seq") < b))
        assert events.apply_messages(table, part, source="s", batch_id=n)
        assert not events.apply_messages(table, part, source="s", batch_id=n)  # the same batch again
    assert rows(table.read().select("unid", "v")) == replay(messages)


def test_keyed_table_survives_an_unfinished_write(spark, tmp_path):
    schema = "k string, v int"
    first = spark.createDataFrame([(f"k{i}", i) for i in range(20)], schema)
    table = KeyedTable(spark, str(tmp_path / "t"), first.schema, ["k"], buckets=4)
    combine = lambda t, b: merge.merge_incremental(t, b, ["k"])
    assert table.is_empty() and table.read().count() == 0
    table.merge(first, combine)
    # data of a version whose manifest was never written
    first.limit(1).withColumn("_bucket", F.lit(0)).write.partitionBy("_bucket").parquet(f"{table.root}/data/v-1")
    assert table.read().count() == 20
    table.merge(spark.createDataFrame([("k1", 100), ("new", 1)], schema), combine)
    assert table.read().count() == 21 and table.read().filter("k = 'k1'").first()["v"] == 100
    table.merge(first, lambda t, b: t.join(b, "k", "left_anti"))  # empties all but one bucket
    table.expire(keep=1)
    assert rows(table.read()) == [("new", 1)]


def test_late_revision_within_the_window(spark):
    schema = ("unid string, source_id string, flynn_region string, auth string, evtype string, magtype string,"
              " lat double, lon double, mag double, depth double, time string, lastupdate string, __deleted string")

    def version(unid, n, updated, deleted="false"):
        return (unid, str(n), "R", "A", "ke", "ml", 0.0, 0.0, float(n), 1.0, "2026-05-01 00:00:00", updated, deleted)

    held = silver.silver_seismic_events(
        spark.createDataFrame([version("a", 1, "2026-05-01 10:00:00"), version("b", 2, "2026-05-03 10:00:00")], schema), "2026-05-04 00:00:00")
    newest = held.agg(F.max("LAST_UPDATED_AT")).first()[0]
    late = [version("a", 3, "2026-05-02 12:00:00"), version("b", 4, "2026-05-01 09:00:00"), version("c", 5, "2026-05-03 11:00:00", "true")]
    fresh = silver.silver_seismic_events(spark.createDataFrame(late, schema), "2026-05-04 00:00:00", newest)
    merged = merge.merge_incremental(held, fresh, ["EVENT_ID"])
    assert rows(merged.select("EVENT_ID", "SOURCE_ID")) == [("a", "3"), ("b", "2")]
    both = spark.createDataFrame([version("d", 1, "2026-05-01 10:00:00"), version("d", 2, "2026-05-02 10:00:00", "true")], schema)
    assert silver.silver_seismic_events(both, "2026-05-04 00:00:00").first()["SOURCE_ID"] == "1"
    assert silver.silver_seismic_events(both, "2026-05-04 00:00:00", honor_deletes=True).count() == 0


def test_incremental_vessel_loads_equal_one_full_load(spark):
    def day(d, n):
        return vessel_frame(spark, n, f"2026-05-{d}").withColumn("_INGESTED_AT", F.to_timestamp(F.lit(f"2026-05-{d} 23:00:00")))

    first, second = day(19, 5), day(20, 7)
    keys = ["NAME", "REPORT_DATE"]
    held = silver.silver_vessels(first)
    newest = held.agg(F.max("_INGESTED_AT")).first()[0]
    step = merge.merge_incremental(held, silver.silver_vessels(first.unionByName(second), newest), keys)
    full = silver.silver_vessels(first.unionByName(second))
    assert rows(step.select(*keys, "DETAIL_LINK")) == rows(full.select(*keys, "DETAIL_LINK"))
    assert silver.silver_vessels(first, newest).count() == 0


def test_versions_beyond_the_window_are_left_out(spark, tmp_path):
    schema = ("unid string, source_id string, flynn_region string, auth string, evtype string, magtype string,"
              " lat double, lon double, mag double, depth double, time string, lastupdate string, __deleted string")

    def version(unid, n, updated):
        return (unid, str(n), "R", "A", "ke", "ml", 0.0, 0.0, 1.0, 1.0, "2026-05-01 00:00:00", updated, None)

    parts = [[version("a", 1, "2026-05-03 10:00:00")], [version("b", 2, "2026-05-02 11:00:00"), version("c", 3, "2026-05-02 09:00:00")]]
    target_schema = silver.silver_seismic_events(spark.createDataFrame(parts[0], schema), "2026-05-04 00:00:00").schema
    for hours, kept in ((24, ["a", "b"]), (None, ["a", "b", "c"])):
        root = str(tmp_path / f"w{hours}")
        table = KeyedTable(spark, f"{root}/t", target_schema, ["EVENT_ID"], 2)
        for part in parts:
            frame = spark.createDataFrame(part, schema)
            frame.write.mode("append").parquet(f"{root}/src")
            stream = spark.readStream.schema(frame.schema).parquet(f"{root}/src")
            events.follow_revisions(stream, table, f"{root}/cp", "2026-05-04 00:00:00", hours).awaitTermination()
        assert sorted(r["EVENT_ID"] for r in table.read().collect()) == kept


# --- checks -----------------------------------------------------------------------


def test_snapshot_gate(spark):
    assert quality.validate_snapshot(vessel_frame(spark, 50)).warnings == []
    few = quality.validate_snapshot(vessel_frame(spark, 49, type=None))
    assert few.ok and len(few.warnings) == 2
    assert quality.validate_snapshot(vessel_frame(spark, 0)).message == "no rows"
    assert quality.validate_snapshot(vessel_frame(spark, 60, name=None)).message == "every name is NULL"
    assert "type" in quality.validate_snapshot(vessel_frame(spark, 60).drop("type")).message


def test_freshness(spark):
    df = spark.createDataFrame([("2026-05-01 00:00:00",)], "t string").withColumn("t", F.to_timestamp("t"))
    for hours, status in ((24, "pass"), (26, "warn"), (50, "error")):
        as_of = str(dt.datetime(2026, 5, 1) + dt.timedelta(hours=hours))
        assert quality.freshness(df, "t", as_of).first()["status"] == status


def test_severity(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert quality.enforce(quality.unique(df, "k", "warn"))[0]["failures"] == 1
    with pytest.raises(quality.QualityError):
        quality.enforce(quality.combine(quality.unique(df, "k", "warn"), quality.not_null(df, ["k"])))
    parents = spark.createDataFrame([("b",)], "p string")
    assert quality.relationships(df, "k", parents, "p").first()["failures"] == 2
    assert quality.accepted_values(df, "k", ["b"]).first()["failures"] == 1


def test_failed_check_stops_what_depends_on_it(spark):
    built = []
    models = [
        rebuilds.Model("one", ("raw",), lambda r: r, [lambda df, _: quality.not_null(df, ["k"])]),
        rebuilds.Model("two", ("one",), lambda r: r),
        rebuilds.Model("other", ("raw",), lambda r: r),
    ]
    raw = {"raw": spark.createDataFrame([(None,)], "k string")}

    def store(name, df):
        built.append(name)
        return df

    with pytest.raises(quality.QualityError):
        rebuilds.rebuild(models, raw, store)
    assert built == ["one"]
    assert rebuilds.downstream(models, "one") == ["one", "two"]


# --- pages ------------------------------------------------------------------------


def test_list_page_rows(spark):
    html = """<html><table><tr><th>h</th></tr>
    <tr><td><a href="/d/1">ONE<br/>Bulk &amp; Ore</a></td><td>2001</td><td> 10 </td><td></td><td>229 / 32 m</td></tr>
    <tr><td><a href="https://x/2">TWO</a></td><td>2001</td><td>10</td><td>20</td><td>-</td><td>more</td></tr>
    <tr><td>no link</td><td>1</td><td>1</td><td>1</td><td>1</td></tr><tr><td><a href="/d/3">short</a></td></tr>
    </table><table><tr><td>second</td></tr></table></html>"""
    df = spark.createDataFrame([("u", html), ("v", "<p>none</p>")], "url string, html string")
    got = [tuple(r)[1:] for r in pages.extract_list_rows(df, "https://b", F.lit("Cargo")).collect()]
    assert got == [("ONE", "Bulk & Ore", "2001", "10", None, "229", "32", "https://b/d/1"),
                   ("TWO", "Cargo", "2001", "10", "20", None, None, "https://x/2")]


def test_detail_page_without_blocks(spark):
    df = spark.createDataFrame([("u", "<html></html>")], "url string, html string")
    assert tuple(pages.extract_detail_fields(df).first()) == ("u", *[None] * 8)


# --- streams ----------------------------------------------------------------------


@pytest.mark.parametrize("files", [1, 4])
def test_stream_result_does_not_depend_on_the_files(spark, tmp_path, files):
    schema = schemas.EVENT_CDC_ROW
    data = [tuple({"unid": f"e{i % 7}", "mag": float(i % 9), "source_id": str(i), "lat": 1.0, "lon": 2.0,
                   "time": f"2026-05-0{1 + i % 3}T00:00:00Z", "__deleted": "true" if i % 5 == 0 else None}.get(f.name)
                  for f in schema.fields) for i in range(40)]
    changes = spark.createDataFrame(data, schema)
    src = str(tmp_path / "src")
    changes.repartition(files).write.parquet(src)
    stream = lambda: cdc.live_events(
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src))
    cdc.write_cdc_append(stream(), str(tmp_path / "out"), str(tmp_path / "cp1")).awaitTermination()
    expected = cdc.live_events(changes)
    assert spark.read.parquet(str(tmp_path / "out")).count() == expected.count() == 32
    events.live_counts(stream(), "days", str(tmp_path / "days"), str(tmp_path / "cp2")).awaitTermination()
    from tidewatch.operators.aggregates import events_per_day, strongest_events

    assert rows(events.newest_counts(spark, str(tmp_path / "days"))) == rows(events_per_day(expected))
    top = events.strongest_table(spark, str(tmp_path / "top"), expected.schema)
    events.follow_strongest(stream(), top, str(tmp_path / "cp3")).awaitTermination()
    assert rows(top.read().select("source_id")) == rows(strongest_events(expected).select("source_id"))


def test_every_start_and_every_feed_counts(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], ACTIONS).schema, ["unid"], 2)

    def feed(name, *messages):
        path = str(tmp_path / f"in-{name}")
        spark.createDataFrame(list(messages), ACTIONS).coalesce(1).write.mode("append").parquet(path)
        return spark.readStream.schema(ACTIONS).parquet(path)

    history = lambda k: spark.createDataFrame([(k, "create", 0, k)], ACTIONS)
    cp = lambda name: str(tmp_path / f"cp-{name}")
    events.backfill_then_stream(history("h1"), feed("a", ("a", "create", 1, "a")), table, cp("a")).awaitTermination()
    events.backfill_then_stream(history("h2"), feed("a", ("b", "create", 2, "b")), table, cp("a")).awaitTermination()
    events.backfill_then_stream(history("h2"), feed("a"), table, cp("a")).awaitTermination()
    events.upsert_events(feed("other", ("c", "create", 1, "c")), table, cp("other")).awaitTermination()
    events.upsert_events(feed("a", ("d", "create", 3, "d")), table, cp("new")).awaitTermination()
    assert {r["unid"] for r in table.read().collect()} == {"h1", "h2", "a", "b", "c", "d"}


def test_a_restart_keeps_the_snapshot(spark, tmp_path):
    schema = schemas.EVENT_CDC_ROW
    rows_of = lambda *ids: spark.createDataFrame(
        [tuple({"unid": i, "__deleted": None}.get(f.name) for f in schema.fields) for i in ids], schema)
    src, out, cp = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "cp")
    rows_of("y").write.parquet(src)
    stream = lambda: spark.readStream.schema(schema).parquet(src)
    cdc.snapshot_then_changes(rows_of("x"), stream(), out, cp).awaitTermination()
    cdc.snapshot_then_changes(rows_of("x", "y"), stream(), out, cp).awaitTermination()
    assert sorted(r["unid"] for r in cdc.read_live(spark, out).collect()) == ["x", "y"]


def test_old_versions_expire_on_the_way(spark, tmp_path, monkeypatch):
    from tidewatch.sources import keyed

    monkeypatch.setattr(keyed, "EXPIRE_EVERY", 6)
    table = KeyedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], "k string, v int").schema, ["k"], 1)
    for v in range(13):
        batch = spark.createDataFrame([("k", v)], "k string, v int")
        table.merge(batch, lambda t, b: merge.merge_incremental(t, b, ["k"]))
    assert [tuple(r) for r in table.read().collect()] == [("k", 12)] and len(table._manifests()) == 10


def test_backfill_start(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), schemas.EVENT_ROW, ["unid"], 2)
    assert events.backfill_start(table, "2026-05-01 10:00:00") == "2026-05-01 09:00:00"


def test_change_envelopes(spark):
    row = {"unid": "e", "mag": 1.0}
    texts = [json.dumps({"after": row, "op": "c"}), json.dumps({"before": row, "after": None, "op": "d"}), None, "{x"]
    got = cdc.unwrap_cdc(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    assert [(r["unid"], r["__deleted"]) for r in got] == [("e", "false"), ("e", "true")]


# --- the stored log ---------------------------------------------------------------


def by_key(t, b):
    return merge.merge_incremental(t, b, ["k", "j"])


@pytest.mark.parametrize("seed", [1])
def test_log_equals_replay_through_folds_compactions_and_splits(spark, tmp_path, monkeypatch, seed):
    from tidewatch.sources import keyed

    monkeypatch.setattr(keyed, "FAN", 3)
    monkeypatch.setattr(keyed, "COMPACT_SHARE", 0.9)
    schema = "k string, j int, v int, at timestamp"
    rng, want, loose, counter = random.Random(seed), {}, [], 0
    table = KeyedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], schema).schema, ["k", "j"], 2, ("at",), bucket_bytes=1_500)
    levels, newest = set(), None
    for n in range(11):
        batch = {}
        for _ in range(rng.choice([3, 12, 400 if n in (0, 6) else 5])):
            counter += 1
            at = dt.datetime(2026, 1, 1) + dt.timedelta(seconds=rng.randint(0, 9_999), microseconds=5 * rng.randint(0, 1))
            batch[f"k{rng.randint(0, 300)}", rng.choice([1, 2, 2, None])] = (counter, at)
        rows_ = [(k, j, v, at) for (k, j), (v, at) in batch.items()]
        drop = n % 4 == 3
        fresh = lambda t, b: t.join(b, ["k", "j"], "left_anti")
        table.merge(spark.createDataFrame(rows_, schema), fresh if drop else by_key, "s", n)
        for (k, j), (v, at) in batch.items():
            if drop:
                want.pop((k, j), None)
            elif j is None:
                loose.append((k, j, v, at))
            else:
                want[k, j] = (v, at)
            if not drop:
                newest = max(newest or at, at)
        state = table._manifest()
        levels |= {d["level"] for d in state["deltas"]}
        got = sorted(map(str, map(tuple, KeyedTable.open(spark, table.root).read().collect())))
        assert got == sorted(map(str, [(k, j, *x) for (k, j), x in want.items()] + loose)), n
        assert dt.datetime.fromisoformat(table.mark("at")) == newest
    assert levels >= {0, 1} and len(state["leaves"]) > 2
    assert not table.merge(spark.createDataFrame(rows_, schema), by_key, "s", 10)
    before = sorted(map(str, table.read().collect()))
    table.compact()
    assert table._manifest()["deltas"] == [] and sorted(map(str, table.read().collect())) == before
    table.expire(keep=1)
    assert sorted(map(str, table.read().collect())) == before


def test_a_small_batch_rewrites_little(spark, tmp_path):
    """A thousand keys on ten million rows write less than a twentieth of the table's bytes."""
    rows_ = lambda a, b, v: spark.range(a, b).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.lit(1).alias("j"), (F.col("id") * v).alias("v"))
    table = KeyedTable(spark, str(tmp_path / "t"), rows_(0, 1, 1).schema, ["k", "j"], 16)
    table.merge(rows_(0, 10_000_000, 3), by_key)
    whole = table._bytes(table.root)
    used = sum(b["bytes"] for b in table._manifest()["base"].values())
    for n in range(9):  # one of them folds
        table.merge(rows_(n * 1_000_000, n * 1_000_000 + 1_000, n), by_key)
    added = table._bytes(table.root) - whole
    assert added < 9 * 0.05 * used / 10 and table._manifest()["deltas"][0]["level"] == 1
    got = table.read().agg(F.count("*"), F.sum("v")).first()
    changed = sum(sum(range(n * 1_000_000, n * 1_000_000 + 1_000)) * (n - 3) for n in range(9))
    assert tuple(got) == (10_000_000, 3 * sum(range(10_000_000)) + changed)


# --- lateness, buffers, ledgers, dead letters ---------------------------------------


VERSION = ("unid string, source_id string, flynn_region string, auth string, evtype string, magtype string,"
           " lat double, lon double, mag double, depth double, time string, lastupdate string, __deleted string")


def version_row(unid, n, updated, deleted=None):
    return (unid, str(n), "R", "A", "ke", "ml", 0.0, 0.0, 1.0, 1.0, "2026-05-01 00:00:00", updated, deleted)


def test_what_the_watermark_drops(spark, tmp_path):
    arrivals = [
        [version_row("a", 1, "2026-05-03 10:00:00"), version_row("b", 1, "2026-05-01 00:00:00")],  # nothing is late in the first batch
        [version_row("b", 2, "2026-05-02 11:00:00"), version_row("c", 3, "2026-05-02 09:00:00"),  # 23 and 25 hours behind
         version_row("a", 1, "2026-05-03 10:00:00")],  # delivered again
        [version_row("a", 9, "2026-05-02 12:00:00"), version_row("d", 4, "2026-05-05 00:00:00", "true")],  # older version; deleted
    ]
    schema = silver.silver_seismic_events(spark.createDataFrame(arrivals[0], VERSION), "2026-05-06 00:00:00").schema
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["EVENT_ID"], 2)
    for part in arrivals:
        spark.createDataFrame(part, VERSION).coalesce(1).write.mode("append").parquet(str(tmp_path / "src"))
        stream = spark.readStream.schema(VERSION).parquet(str(tmp_path / "src"))
        events.follow_revisions_watermarked(stream, table, str(tmp_path / "cp"), "2026-05-06 00:00:00").awaitTermination()
    assert rows(table.read().select("EVENT_ID", "SOURCE_ID")) == [("a", "1"), ("b", "2")]


def live_rows(spark, *values):
    data = [tuple({"unid": f"e{i}", "mag": float(m), "source_id": str(i), "time": f"2026-05-0{d}T00:00:00Z"}.get(f.name) for f in schemas.EVENT_CDC_ROW.fields)
            for i, (m, d) in enumerate(values)]
    return spark.createDataFrame(data, schemas.EVENT_CDC_ROW)


def test_counts_survive_restarts_and_new_checkpoints(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    stream = lambda: cdc.live_events(cdc.admit(spark.readStream.schema(schemas.EVENT_CDC_ROW), files=1).parquet(src))
    live_rows(spark, (1, 1), (5, 1), (5, 2)).coalesce(1).write.parquet(src)
    events.live_counts(stream(), "days", out, str(tmp_path / "cp1")).awaitTermination()
    live_rows(spark, (7, 2), (2, 3)).coalesce(1).write.mode("append").parquet(src)
    events.live_counts(stream(), "days", out, str(tmp_path / "cp1")).awaitTermination()
    want = [(dt.date(2026, 5, 1), 2), (dt.date(2026, 5, 2), 2), (dt.date(2026, 5, 3), 1)]
    assert rows(events.newest_counts(spark, out)) == want
    live_rows(spark, (7, 3)).coalesce(1).write.mode("append").parquet(src)
    events.live_counts(stream(), "days", out, str(tmp_path / "cp2")).awaitTermination()
    assert rows(events.newest_counts(spark, out)) == [*want[:2], (dt.date(2026, 5, 3), 2)]


@pytest.mark.parametrize("limit", [{"files": 2}, {"size": "1"}, {}])
def test_a_backlog_is_taken_in_batches(spark, tmp_path, limit):
    src = str(tmp_path / "src")
    for k in range(6):
        live_rows(spark, (k, 1)).coalesce(1).write.mode("append").parquet(src)
    stream = cdc.admit(spark.readStream.schema(schemas.EVENT_CDC_ROW), **limit).parquet(src)
    q = cdc.write_cdc_append(cdc.live_events(stream), str(tmp_path / "out"), str(tmp_path / "cp"), cdc.buffer_trigger(None))
    q.awaitTermination()
    sizes = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    assert sizes == {"files": [2] * 3, "size": [1] * 6}.get(next(iter(limit), None), [6])
    assert sorted(r["mag"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [float(k) for k in range(6)]
    assert cdc.buffer_trigger(60) == {"processingTime": "60 seconds"}
    with pytest.raises(ValueError):
        cdc.admit(spark.readStream, 1, "1m")


def test_dead_letters_once_after_a_replayed_batch(spark, tmp_path, monkeypatch):
    good = json.dumps({"action": "create", "data": {"id": "e1", "properties": {"mag": 1.0}}})
    src = str(tmp_path / "src")
    spark.createDataFrame([(1, good), (2, "{broken"), (3, None), (1, "same offset")], "seq long, value string").coalesce(1).write.parquet(src)
    stream = lambda: spark.readStream.schema("seq long, value string").parquet(src)
    where = [str(tmp_path / x) for x in ("good", "dead", "cp")]
    # the first attempt dies between the two sinks
    real = events.readers.parse_event_messages
    monkeypatch.setattr(events.readers, "parse_event_messages", lambda *a, **k: real(*a, **k).withColumn("mag", F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        events.follow_with_dead_letters(stream(), *where).awaitTermination()
    monkeypatch.setattr(events.readers, "parse_event_messages", real)
    events.follow_with_dead_letters(stream(), *where).awaitTermination()
    events.follow_with_dead_letters(stream(), *where).awaitTermination()
    assert rows(events.read_batches(spark, where[0]).select("unid", "seq")) == [("e1", 1)]
    assert sorted(map(str, map(tuple, events.read_batches(spark, where[1]).collect()))) == sorted(
        map(str, [(2, "{broken"), (3, None), (1, "same offset")]))


def test_a_months_file_counts_once(spark, tmp_path):
    line = ",".join("1.5" if c in fixed.PORT_DOUBLE_COLUMNS else "x" for c in fixed.PORT_COLUMNS)
    text = "\n".join([",".join(fixed.PORT_COLUMNS), line, line]) + "\n"

    def offer(name):
        file = tmp_path / "in" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(text)

    def load(loaded):
        stream = readers.stream_ports(spark, str(tmp_path / "in"), by_name=True)
        writers.append_new_files(stream, str(tmp_path / "out"), str(tmp_path / "ledger"), loaded).awaitTermination()
        got = spark.read.parquet(str(tmp_path / "out")).groupBy("_LOADED_AT").count()
        return sorted((r[0].month, r[1]) for r in got.collect())

    offer("a/ports_2026-01.csv")
    assert load("2026-01-31 00:00:00") == [(1, 2)]
    offer("a/ports_2026-01.csv")  # written again in its place
    offer("b/ports_2026-01.csv")  # and offered in another folder
    assert load("2026-02-28 00:00:00") == [(1, 2)]
    offer("b/ports_2026-03.csv")
    assert load("2026-03-31 00:00:00") == [(1, 2), (3, 2)]


def test_rows_in_quarantine(spark, tmp_path):
    good, bad = vessel_frame(spark, 60), vessel_frame(spark, 3, name=None)
    verdict = writers.split_quarantine(good.unionByName(bad), str(tmp_path / "q"), C("name").isNotNull())
    assert verdict.ok and verdict.metrics["bad"] == 3 and "3 of 63 rows quarantined" in verdict.warnings
    assert writers.read_verdict(spark, str(tmp_path / "q"), "good").count() == 60
    assert writers.read_verdict(spark, str(tmp_path / "q"), "bad").filter("name IS NULL").count() == 3
    none = writers.split_quarantine(bad.drop("type"), str(tmp_path / "r"), C("name").isNotNull())
    assert (none.ok, none.message) == (False, "every name is NULL")
    assert writers.split_quarantine(good.drop("type"), str(tmp_path / "s"), F.lit(None).cast("boolean")).message.startswith("missing columns")


def test_scratch_folders_can_be_removed(spark, tmp_path, monkeypatch):
    from pathlib import Path

    from tidewatch import session

    monkeypatch.setattr(session, "_made", {})
    kept = writers.staged(spark.range(5), "keep")
    assert kept.count() == 5
    (path,) = session._made[spark.sparkContext.applicationId]
    assert Path(path).exists()
    assert session.remove_scratch(spark) == 1 and not Path(path).exists()
    assert session.remove_scratch(spark) == 0


def test_a_merge_leaves_only_its_table_behind(spark, tmp_path, monkeypatch):
    """What a merge stages is gone when it is committed, and files are stored with zstd; a delta that isn't spread stays where it was made."""
    from tidewatch.sources import keyed

    monkeypatch.setattr(keyed, "COMPACT_SHARE", 9)
    rows_ = lambda n, v: spark.range(0, n, 1, 3).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.lit(1).alias("j"), F.lit(v).alias("v"))
    table = KeyedTable(spark, str(tmp_path / "t"), rows_(1, 1).schema, ["k", "j"], 2)
    for n, spread in ((3_000, True), (300, False), (30, True)):
        table.merge(rows_(n, n), lambda held, rows: rows, spread=spread)
        assert table._children(f"{table.root}/staged") == []
    assert {r["v"]: r["count"] for r in table.read().groupBy("v").count().collect()} == {3_000: 2_700, 300: 270, 30: 30}
    files = [p for p in (tmp_path / "t").rglob("*.parquet")]
    assert files and all("zstd" in p.name for p in files)
    (unspread,) = [d for d in table._manifest()["deltas"] if d["path"] == "delta/v-1-0"]
    assert len([p for p in (tmp_path / "t" / unspread["path"]).glob("*.parquet")]) == 3


def test_replaced_rows_are_written_once_and_checked_first(spark, tmp_path, monkeypatch):
    """Rows go into the table's own files, keys without rows go, and a failed check or nothing at all leaves no version."""
    from tidewatch.sources import keyed

    monkeypatch.setattr(keyed, "COMPACT_SHARE", 9)
    rows_ = lambda keys, v: spark.createDataFrame([(f"k{k}", v) for k in keys], "k string, v int")
    table = KeyedTable(spark, str(tmp_path / "t"), rows_([1], 1).schema, ["k"], 2, ("v",))
    held = lambda: {r["k"]: r["v"] for r in table.read().collect()}
    copies = []
    stored = table._stored
    monkeypatch.setattr(table, "_stored", lambda df, path: copies.append((path, df.count())) or stored(df, path))
    assert table.replace(rows_(range(6), 1))[1] == 6 and copies == []
    written, n = table.replace(rows_([4, 5, 6], 2))
    assert n == 3 and copies == [] and sorted(r["k"] for r in written.collect()) == ["k4", "k5", "k6"]
    written, n = table.replace(rows_([0, 0], 3), rows_([0, 1, 9], 0))  # k1 goes, k9 was never there, k0 has two rows
    assert n == written.count() == 2 and [c for _, c in copies] == [2, 1]
    assert held() == {"k0": 3, "k2": 1, "k3": 1, "k4": 2, "k5": 2, "k6": 2} and table.read().count() == 7

    def fails(stored):
        assert stored.count() == 1
        raise ValueError("no")

    for call in (lambda: table.replace(rows_([2], 8), None, fails), lambda: table.replace(rows_([], 8)), lambda: table.replace(rows_([], 8), rows_([9], 8))):
        before = table._manifests()
        try:
            assert call()[1] == 0
        except ValueError:
            pass
        assert table._manifests() == before
    assert table.replace(rows_([], 8), rows_([2], 8))[1] == 0 and "k2" not in held() and table.mark("v") == "3"
    whole = held()
    table.compact()
    assert held() == whole and table.read().count() == 6 and not table._manifest()["deltas"]
    table.replace(rows_([7, 8], 4))  # only new keys
    table.compact()
    assert held() == whole | {"k7": 4, "k8": 4} and table.read().count() == 8


def test_messages_write_only_what_they_change(spark, tmp_path, monkeypatch):
    """Creates of held events and deletes of absent ones leave nothing behind; a message is parsed once."""
    from tidewatch.sources import keyed

    monkeypatch.setattr(keyed, "COMPACT_SHARE", 9)
    said = lambda *m: spark.createDataFrame(
        [(i, f'{{"action": "{a}", "data": {{"id": "{k}", "properties": {{"source_id": "{v}"}}}}}}') for i, (a, k, v) in enumerate(m)],
        "seq long, value string")
    parsed = lambda *m: readers.parse_event_messages(said(*m), carry=("seq",))
    table = KeyedTable(spark, str(tmp_path / "t"), parsed(("create", "a", "1")).schema, ["unid"], 2)
    events.apply_messages(table, parsed(*[("create", k, "1") for k in "abcd"], ("delete", "z", "1")))
    events.apply_messages(table, parsed(("create", "a", "2"), ("update", "b", "2"), ("delete", "c", "2"), ("delete", "y", "2"), ("create", "e", "2"),
                                        ("delete", "d", "2"), ("create", "d", "3")))
    assert {r["unid"]: r["source_id"] for r in table.read().collect()} == {"a": "1", "b": "2", "d": "3", "e": "2"}
    (delta,) = table._manifest()["deltas"]
    rows = spark.read.parquet(f"{table.root}/{delta['path']}").select("unid", keyed.GONE).collect()
    assert sorted(map(tuple, rows)) == [("b", False), ("c", True), ("d", False), ("e", False)]
    once = readers.parse_event_messages(said(("create", "a", "1"))).filter("action = 'create'")
    assert once._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    odd = spark.createDataFrame([(0, None), (1, "x"), (2, "[]"), (3, "{}"), (4, '{"data": {}}'), (5, '{"data": {"id": "q"}}')], "seq long, value string")
    assert [tuple(r) for r in readers.parse_event_messages(odd, carry=("seq",)).select("unid", "action", "seq").collect()] == [("q", "create", 5)]

"""Tables kept current step by step equal tables built at once, and only what depends on a change is renewed."""

import pytest
from pyspark.sql import functions as F

from tidewatch import adapters as A
from tidewatch.functions.text import try_timestamp
from tidewatch.operators import quality
from tidewatch.plans import rebuild as rebuilds
from tidewatch.plans.incremental import Incremental
from tidewatch.sources.writers import staged

C = F.col
SF = "/root/testdata/sf0.001"
CALENDAR = ("1992-01-01", "2024-03-01")


def value_set(df):
    names = sorted(df.columns)
    rounded = [F.round(c, 6).alias(c) if t == "double" else C(f"`{c}`") for c, t in df.select(*[f"`{n}`" for n in names]).dtypes]
    return sorted(map(str, map(tuple, df.select(*rounded).collect())))


@pytest.fixture(scope="module")
def raw(spark):
    load = lambda df, at: df.withColumn("_LOADED_AT", F.lit(at).cast("timestamp"))
    ports = A.ports(spark, SF).filter("World_Port_Index_Number IS NOT NULL")
    first = load(ports, "2024-01-10 00:00:00")
    # the next load moves one port, renames another, brings a new one, and repeats the rest
    low = ports.agg(F.min("World_Port_Index_Number")).first()[0]
    number = C("World_Port_Index_Number")
    second = ports.withColumn("OID_", C("OID_") - F.when(number <= low + 1, 1_000.0).otherwise(0.0)).withColumn(
        "Latitude", F.when(number == low, -C("Latitude")).otherwise(C("Latitude"))).withColumn(
        "Main_Port_Name", F.when(number == low + 1, "OTHER PORT").otherwise(C("Main_Port_Name")))
    second = second.unionByName(second.filter(number == low).withColumn("World_Port_Index_Number", number + 500_000))
    vessels = A.vessels(spark, SF).filter("name IS NOT NULL").orderBy("detail_link").limit(400)
    days = [F.lit(f"2024-01-{d} 00:00:00").cast("timestamp") for d in (11, 12)]
    later = F.pmod(F.xxhash64("detail_link"), F.lit(3)) == 0
    return {
        "ports": [staged(first, "p1"), staged(first.unionByName(load(second, "2024-02-10 00:00:00")), "p2")],
        "vessels": [staged(vessels.withColumn("_INGESTED_AT", F.when(later, days[1]).otherwise(days[0])).filter(f), "v")
                    for f in (~later, F.lit(True))],
        "seismic": [staged(A.seismic(spark, SF).filter(f), "e") for f in ("lastupdate < timestamp '2024-01-20'", "true")],
        "aliases": A.aliases(spark, SF),
    }


def test_second_runs_equal_a_full_rebuild(spark, raw, tmp_path):
    inc = Incremental(spark, str(tmp_path / "inc"), A.AS_OF, raw["aliases"], CALENDAR, buckets=2)
    for n in range(2):
        inc.ports(raw["ports"][n])
        inc.vessels(raw["vessels"][n])
        inc.events(raw["seismic"][n])
    given = {k: v[-1] if isinstance(v, list) else v for k, v in raw.items()}
    dated = try_timestamp("report_date").isNotNull()
    assert 0 < inc.read("undated_reports").count() < given["vessels"].filter(~dated).count() + 1
    given["vessels"] = given["vessels"].filter(dated)
    full, _ = rebuilds.rebuild(rebuilds.models(spark, A.AS_OF, CALENDAR), given, lambda name, df: staged(df, name))
    for name in full:
        if name not in given and name != "dim_date":
            got, want = value_set(inc.read(name)), value_set(full[name])
            assert got == want, (name, len(got), len(want), sorted(set(got) ^ set(want))[:2])
    # nothing new: nothing is renewed
    inc.renewed.clear()
    inc.vessels(raw["vessels"][1])
    inc.events(raw["seismic"][1])
    assert not any(inc.renewed.values()), inc.renewed
    # one event moves to another day: its own rows, two days and what their windows reach
    one = raw["seismic"][1].orderBy(C("lastupdate").desc(), C("source_id")).limit(1)
    moved = one.withColumns({"time": C("time") - F.expr("INTERVAL 3 DAYS"), "lastupdate": C("lastupdate") + F.expr("INTERVAL 1 HOUR")})
    both = raw["seismic"][1].unionByName(moved)
    inc.events(both)
    assert inc.renewed["silver_seismic_events"] == inc.renewed["dim_seismic_event"] == 1
    assert inc.renewed["daily_aggregated_seismic_events"] <= 16 < inc.read("daily_aggregated_seismic_events").count()
    full, _ = rebuilds.rebuild(
        [m for m in rebuilds.models(spark, A.AS_OF, CALENDAR) if "proximity" not in m.name], {**full, "seismic": both},
        lambda name, df: staged(df, name), "silver_seismic_events")
    for name in ("daily_aggregated_seismic_events", "fact_daily_seismic"):
        assert value_set(inc.read(name)) == value_set(full[name])


def test_a_failed_check_leaves_the_table_and_the_run_can_be_repeated(spark, raw, tmp_path):
    inc = Incremental(spark, str(tmp_path / "inc"), A.AS_OF, raw["aliases"], CALENDAR, buckets=1)
    undated = raw["vessels"][0].limit(5).withColumn("report_date", F.lit("some day"))
    with pytest.raises(quality.QualityError, match="REPORT_DATE"):
        inc.vessels(undated, strict=True)
    inc.ports(raw["ports"][0])
    some = raw["vessels"][0].filter(try_timestamp("report_date").isNotNull()).limit(5)
    inc.vessels(some.unionByName(undated.limit(1)))
    assert inc.read("silver_vessels").count() == inc.read("fact_vessel_voyage").count() == 5
    assert inc.read("undated_reports").count() == 1


def test_fused_checks_equal_single_ones(spark):
    Q = quality.Check
    df = spark.createDataFrame(
        [("a", 1, True), ("a", 2, None), (None, 3, False), ("c", 3, True), ("d", None, True), ("", 7, True)], "k string, n int, b boolean")
    parents = {"p": spark.createDataFrame([("a",), ("c",), ("c",), (None,)], "key string"), "q": spark.createDataFrame([(3,), (9,)], "m int")}
    checks = [Q("not_null", "k"), Q("not_null", "b", "warn"), Q("unique", "k"), Q("unique", "n", "warn"), Q("not_null", "n"),
              Q("accepted_values", "k", values=("a", "d")), Q("accepted_values", "b", values=(True,)), Q("accepted_values", "n", values=(1, 2, 3, 7)),
              Q("relationships", "k", parent="p", key="key"), Q("relationships", "n", parent="q", key="m")]
    for frame in (df, df.limit(0), df.unionByName(df)):
        single = [
            {"not_null": lambda c: quality.not_null(frame, [c.column], c.severity),
             "unique": lambda c: quality.unique(frame, c.column, c.severity),
             "accepted_values": lambda c: quality.accepted_values(frame, c.column, list(c.values), c.severity),
             "relationships": lambda c: quality.relationships(frame, c.column, parents[c.parent], c.key, c.severity)}[c.kind](c)
            for c in checks
        ]
        want = sorted(map(tuple, quality.combine(*single).collect()))
        assert sorted(map(tuple, quality.check_all(frame, checks, parents).collect())) == want


def test_fused_checks_scan_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select(C("id").alias("a"), (C("id") % 7).alias("b")).write.parquet(path)
    Q = quality.Check
    report = quality.check_all(spark.read.parquet(path), [Q("not_null", "a"), Q("unique", "a"), Q("unique", "b"), Q("accepted_values", "b", values=(0, 1))])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert [r["failures"] for r in report.orderBy("check", "column").collect()] == [5, 0, 0, 7]


def test_panels_from_one_scan(spark):
    from tidewatch.plans import monitor
    from tidewatch.registry.common import Domain

    live = Domain(spark, SF).live()
    rows = monitor.panel_rows(live)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == live._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")
    rows = staged(rows, "panels")
    single = monitor.live_seismic_monitor(live)
    for name in monitor.PANELS:
        assert value_set(monitor.panel(rows, name)) == value_set(single[name]), name

"""Joins against brute force, with skew, NULL keys, poles and the antimeridian."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import compatible, joins
from tidewatch.operators.proximity import proximity_join

C = F.col


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


@pytest.mark.parametrize("hint", [None, "merge"])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_dimension_join_equals_plain_join(spark, how, hint):
    # a third of the rows on one key, a third without a key, copies of one row among them
    left = spark.range(3000).select(
        F.when(C("id") % 3 == 0, F.lit("hot")).when(C("id") % 3 == 1, F.lit(None)).otherwise(C("id").cast("string"))
        .alias("k"),
        F.when(C("id") % 3 == 0, F.lit(7)).otherwise(C("id")).alias("v"),
    ).repartition(8)
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), (None, 3), ("5", 4), ("unused", 5)], "k string, w int")
    joined = joins.dimension_join(left, right, ["k"], how, hint=hint)
    assert rows(joined) == rows(left.join(right, "k", how).select(joined.columns))


def test_hot_keys_are_split_at_run_time(spark):
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(60_000).select(
            F.when(C("id") % 3 > 0, F.lit("hot")).otherwise(C("id").cast("string")).alias("k"), F.sha2(C("id").cast("string"), 256).alias("v")
        ).repartition(8)
        right = spark.range(0, 60_000, 3).select(C("id").cast("string").alias("k"), "id").union(spark.createDataFrame([("hot", -1)], "k string, id long"))
        joined = joins.dimension_join(left, right, ["k"], "left", hint="merge")
        found = joined._jdf.queryExecution()
        assert joined.count() == 60_000 and found is not None
        done = joined.groupBy("id").count()
        assert done.where("id = -1").first()["count"] == 40_000
        plan = joined.filter("length(v) > 0")
        plan.collect()
        assert "skew=true" in plan._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_nothing_runs_before_the_action(spark):
    left = spark.range(10).withColumn("k", C("id"))
    right = spark.range(5).select(C("id").alias("k"), F.lit(1).alias("w"))
    spark.sparkContext.setJobGroup("building", "joins")
    joins.dimension_join(joins.dimension_join(left, right, ["k"]), right.distinct().withColumnRenamed("w", "u"), ["k"], "left")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(jobs) == []


def test_residual_condition(spark):
    left = spark.createDataFrame([("a", 1), ("a", 5), ("b", 1)], "k string, v int")
    right = spark.createDataFrame([("a", 3), ("b", 0)], "k string, w int")
    expected = [("a", "1", "3"), ("a", "5", "None"), ("b", "1", "None")]
    for hint in (None, "merge"):
        got = joins.dimension_join(left, right, ["k"], "left", residual=C("v") < C("w"), hint=hint)
        assert rows(got) == expected


def great_circle(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * 6371 * math.asin(min(1, math.sqrt(h)))


@pytest.mark.parametrize("radius", [500.0, 60.0, 3000.0])
@pytest.mark.parametrize("hint", [None, "merge"])
def test_grid_join_equals_all_pairs(spark, radius, hint):
    rng = random.Random(7)
    edge = [90.0, -90.0, 89.9, -86.0, 0.0, 60.0]
    points = [(rng.choice(edge) if i % 3 == 0 else rng.uniform(-90, 90),
               rng.choice([180.0, -180.0, 179.9, 0.0]) if i % 4 == 0 else rng.uniform(-180, 180)) for i in range(400)]
    ports = [(rng.choice(edge) if i % 2 == 0 else rng.uniform(-90, 90),
              rng.choice([180.0, -180.0, -179.5]) if i % 3 == 0 else rng.uniform(-180, 180)) for i in range(60)]
    events = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "e int, LATITUDE double, LONGITUDE double")
    side = spark.createDataFrame([(i, *p) for i, p in enumerate(ports)], "p int, PORT_LATITUDE double, PORT_LONGITUDE double")
    got = sorted((r["e"], r["p"]) for r in proximity_join(events, side, radius, hint).collect())
    expected = sorted((i, j) for i, e in enumerate(points) for j, p in enumerate(ports) if great_circle(*e, *p) <= radius)
    assert got == expected


@pytest.mark.parametrize("radius", [0.001, 1.0, 500.0, 12_000.0, 20_015.0, 25_000.0])
def test_chord_test_equals_distance_test(spark, radius):
    from tidewatch.functions.geo import Reach, haversine_km

    rng, pairs = random.Random(3), []
    for i in range(3000):
        lat, lon = rng.choice([rng.uniform(-89, 89), 0.0, 90.0, -90.0]), rng.uniform(-180, 180)
        # another point in the same or the opposite meridian, around the radius to the last digits
        turn = math.degrees(radius / 6371) * rng.choice([1, 1 + 1e-15, 1 - 1e-15, 1 + 1e-10, 1 - 1e-10, 1.001, 0.999, rng.uniform(0, 2)])
        far = rng.choice([0, 0, 0, 0, 360, -720, 1e6, 1e17])
        pairs.append((lat, lon + far, max(-90.0, min(90.0, lat + rng.choice([-1, 1]) * turn)), lon))
    pairs += [(0.0, v, 0.0, 0.0) for v in (float("nan"), float("inf"), -180.0)]
    df = spark.createDataFrame(pairs, "a double, b double, c double, d double")
    reach, distance = Reach(radius), haversine_km(C("a"), C("b"), C("c"), C("d"))
    near = reach.holds(reach.place(C("a"), C("b")), reach.place(C("c"), C("d")), distance)
    assert df.filter(~near.eqNullSafe(distance <= radius)).count() == 0
    # the great circle is asked for the edge and for longitudes out of range only
    asked = df.filter("abs(b) < 1000").filter(near & ~reach.holds(reach.place(C("a"), C("b")), reach.place(C("c"), C("d")), F.lit(1e9)))
    if radius == 500.0:
        assert 0 < asked.count() < df.filter("abs(b) < 1000").filter(near).count() * 0.9


def test_ports_are_not_broadcast_once_per_cell(spark):
    events = spark.createDataFrame([(1, 0.0, 0.0)], "e int, LATITUDE double, LONGITUDE double")
    side = spark.createDataFrame([(1, 0.0, 0.0)], "p int, PORT_LATITUDE double, PORT_LONGITUDE double")
    plan = proximity_join(events, side)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [_cell" in plan and "Broadcast" not in plan


def test_points_outside_the_range_have_no_pair(spark):
    events = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 0.0)], "e int, LATITUDE double, LONGITUDE double")
    side = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 999.0)], "p int, PORT_LATITUDE double, PORT_LONGITUDE double")
    assert [(r["e"], r["p"]) for r in proximity_join(events, side).collect()] == [(1, 1)]


FLAGS = ["HAS_CONTAINER_FACILITY", "HAS_RO_RO_FACILITY", "HAS_LIQUID_BULK_FACILITY", "HAS_SOLID_BULK_FACILITY",
         "HAS_OIL_TERMINAL_FACILITY"]


def fleet(spark, seed, n_vessels, n_ports, levels):
    rng = random.Random(seed)
    limit = lambda top, none: rng.choice([None, None, none, float(rng.randint(0, top)), rng.uniform(0, top)])
    ports = [(float(i), limit(420, 12000.0), limit(75, 999.0), rng.randint(0, levels) / 4,
              *[rng.randint(0, 1) for _ in FLAGS]) for i in range(n_ports)]
    vessels = [(f"v{i}", rng.choice([None, *FLAGS]), rng.choice([None, float(rng.randint(0, 430)), rng.uniform(0, 430)]),
                rng.choice([None, rng.uniform(0, 80)])) for i in range(n_vessels)]
    port_schema = ("WORLD_PORT_INDEX_NUMBER double, MAXIMUM_VESSEL_LENGTH_M double, MAXIMUM_VESSEL_BEAM_M double,"
                   " FINAL_SCORE double, " + ", ".join(f"{f} int" for f in FLAGS))
    vessel_schema = "NAME string, REQUIRED_FACILITY string, LENGTH_M double, BEAM_M double"
    return (vessels, ports, spark.createDataFrame(vessels, vessel_schema), spark.createDataFrame(ports, port_schema))


def best(vessels, ports, n):
    out = set()
    for name, need, length, beam in vessels:
        fit = [p for p in ports
               if (9999.0 if p[1] is None else p[1]) >= (length or 0) and (999.0 if p[2] is None else p[2]) >= (beam or 0)
               and (need is None or p[4 + FLAGS.index(need)] == 1)]
        for rank, p in enumerate(sorted(fit, key=lambda p: (-p[3], p[0]))[:n], 1):
            out.add((name, rank, p[0]))
    return out


@pytest.mark.parametrize("seed, levels, hint", [(1, 400, None), (2, 3, None), (3, 40, "merge")])
def test_best_ports_equal_all_pairs(spark, seed, levels, hint):
    vessels, ports, v, p = fleet(spark, seed, 150, 120, levels)
    got = {(r["NAME"], r["RANK"], r["PORT"]) for r in compatible.top_compatible(v, p, 3, hint=hint).collect()}
    assert got == best(vessels, ports, 3)
    left = {r["NAME"] for r in compatible.without_port(v, p, hint=hint).collect()}
    assert left == {x[0] for x in vessels} - {g[0] for g in got}


def test_few_ports_leave_vessels_without(spark):
    vessels, ports, v, p = fleet(spark, 5, 60, 4, 10)
    got = {(r["NAME"], r["RANK"], r["PORT"]) for r in compatible.top_compatible(v, p, 3).collect()}
    assert got == best(vessels, ports, 3)


def test_top_rows_are_limited_before_the_shuffle(spark):
    from tidewatch.operators.dedup import top_per_key

    df = spark.range(100).select((C("id") % 3).alias("k"), "id")
    plan = top_per_key(df, ["k"], [C("id").desc()], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_aliases(spark):
    from tidewatch.sources.readers import load_seed

    seed = load_seed(spark)
    vessels = spark.createDataFrame([("port said east ",), ("Alger (Algiers)",), ("Suez",), (None,)],
                                    "DESTINATION_PORT_NAME string")
    got = [(r[0], r[1]) for r in joins.map_alias(vessels, seed).collect()]
    assert sorted(x for x in got if x[0] and "said" in x[0]) == [("port said east ", "Bur Sa'id"), ("port said east ", "Port Said")]
    assert [x for x in got if x[0] == "Alger (Algiers)"] == [("Alger (Algiers)", "Algiers")] * 2
    assert ("Suez", None) in got and (None, None) in got
    assert joins.map_alias(vessels, seed, dedup_aliases=True).count() == 4


def test_keys_are_looked_up_before_pairing(spark, monkeypatch):
    monkeypatch.setattr(joins, "KEY_LIST", 2)
    events = spark.createDataFrame([("e1", 0.0, 0.0), ("e2", 0.5, 0.5), (None, 0.0, 0.1), ("e4", 50.0, 50.0)],
                                   "EVENT_ID string, LATITUDE double, LONGITUDE double")
    ports = spark.createDataFrame([(1, " a", 0.1, 0.1), (2, "A ", 0.2, 0.2), (3, None, 0.3, 0.3), (4, "b", 0.4, 0.4), (5, "c", -50.0, 0.0)],
                                  "p int, PORT_NAME string, PORT_LATITUDE double, PORT_LONGITUDE double")
    event_dim = spark.createDataFrame([("e1", "k1"), ("e4", "k4"), (None, "k0")], "EVENT_ID string, SEISMIC_EVENT_SK string")
    # one name has more ports than a list, one key is NULL, one name is unknown
    named = [("A", "s1"), ("a", "s2"), ("a ", "s3"), ("A", None), (None, "s4"), ("c", "s5"), ("C", "s5")]
    port_dim = spark.createDataFrame(named, "MAIN_PORT_NAME string, PORT_SK string")
    keyed = joins.lookup_sk(events, ports, event_dim, port_dim, lambda e, p: proximity_join(e, p, hint="merge"))
    got = rows(keyed.select("EVENT_ID", "p", "SEISMIC_EVENT_SK", "PORT_SK"))
    sks = {1: ["s1", "s2", "s3", None], 2: ["s1", "s2", "s3", None], 3: [None], 4: [None]}
    expected = [(e, p, {"e1": "k1"}.get(e), s) for e in ("e1", "e2", None) for p in sks for s in sks[p]]
    assert got == sorted(tuple(map(str, r)) for r in expected)
    # nothing is shuffled or sorted once there are pairs
    above = keyed._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin [_cell")[0]
    assert "Exchange" not in above and "Sort [" not in above and "Join" not in above


def test_recent_events_are_joined_before_pairing(spark):
    from tidewatch.operators import aggregates
    from tidewatch.plans import gold

    # ids come twice, without a time, long ago and as NULL
    known = [("e1", "2024-01-30", 1.0), ("e1", "2024-01-29", 2.0), ("e1", "2023-01-01", 3.0), ("e2", "2023-01-01", 4.0),
             (None, "2024-01-30", 5.0), ("e3", None, 6.0), ("e4", "2024-01-17", 7.0)]
    events = spark.createDataFrame([(i, m, 10.0, 0.0, float(n) / 10, when) for n, (i, when, m) in enumerate(known)],
                                   "EVENT_ID string, MAGNITUDE double, DEPTH_KM double, LATITUDE double, LONGITUDE double, at string")
    events = events.withColumn("EARTHQUAKE_TIME", C("at").cast("timestamp"))
    ports = spark.createDataFrame([(1.0, "A", 0.1, 0.1, True), (2.0, "A", 1.0, 1.0, True), (3.0, "B", 4.0, 0.0, True), (4.0, "C", 60.0, 0.0, True)],
                                  "WORLD_PORT_INDEX_NUMBER double, MAIN_PORT_NAME string, LATITUDE double, LONGITUDE double, IS_VALID_COORDINATES boolean")
    pair = lambda e: gold.gold_seismic_port_proximity(e, ports)
    as_of = "2024-01-31 00:00:00"
    made, stored = (aggregates.recent_pairs(p, events, as_of) for p in (pair, pair(events)))
    assert rows(made) == rows(stored.select(made.columns)) and made.count() == (3 * 2 + 1) * 3
    risk = [aggregates.max_port_risk(p, events, as_of) for p in (pair, pair(events))]
    assert rows(risk[0]) == rows(risk[1]) and risk[0].count() == 2


@pytest.mark.parametrize("name, shuffles", [("j7_recent_proximity", 0), ("g3_max_port_risk", 1)])
def test_pairs_are_not_joined_by_event(spark, name, shuffles):
    from tidewatch.registry import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    above = plan.split("SortMergeJoin [_cell")[0]
    assert above.count("Exchange") == shuffles and "Join" not in above

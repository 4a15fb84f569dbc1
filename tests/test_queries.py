"""Every registered query against its SQL on the smallest data set."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import compare, duck  # noqa: E402

from __spark_entry__ import entry  # noqa: E402
from tidewatch.registry import ORACLES, QUERIES  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, found = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF)
    assert ok, found


@pytest.mark.parametrize("name", ["j4_proximity_join", "j4_proximity_shuffled", "j9_compatible_ports", "j10_without_port",
                                  "m8_vessels_with_port_details", "m16_fact_seismic_port_proximity",
                                  "m17_fact_vessel_voyage", "m18_port_recommendations"])
def test_no_plan_pairs_everything(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scans_read_only_what_is_needed(spark):
    plan = QUERIES["m11_daily_risk"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan


def test_destinations_are_checked_against_all_ports(spark, tmp_path):
    # i4: ports of every harbour size are parents, the one of PORT 0 with the largest key among them
    spark.range(6).selectExpr("id AS s_suppkey", "'s' || id AS s_name", "id % 3 AS s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(20).selectExpr("id AS o_orderkey", "id % 4 AS o_custkey", "timestamp_ntz '1998-05-01 00:00:00' AS o_orderdate").write.parquet(
        f"{tmp_path}/orders.parquet")
    spark.range(9).selectExpr("id AS event_id", "timestamp_ntz '2024-01-05 00:00:00' AS ts", "id AS user_id").write.parquet(
        f"{tmp_path}/events.parquet")
    voyages = QUERIES["m17_fact_vessel_voyage"](spark, str(tmp_path))
    assert voyages.filter("DESTINATION_PORT_SK IS NOT NULL").count() > 0
    report = {r["column"]: r for r in QUERIES["i4_relationships"](spark, str(tmp_path)).collect()}
    assert report["DESTINATION_PORT_SK"]["failures"] == 0 and report["DESTINATION_PORT_SK"]["status"] == "pass"

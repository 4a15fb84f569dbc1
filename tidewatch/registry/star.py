"""Composite tables M1-M20."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch import adapters as A
from tidewatch.operators.dedup import active_vessels
from tidewatch.plans import monitor, recommend, star
from tidewatch.plans import rebuild as rebuilds
from tidewatch.plans.incremental import Incremental
from tidewatch.registry.base import query
from tidewatch.registry.common import Domain
from tidewatch.registry.sql import replaced
from tidewatch.session import scratch
from tidewatch.sources.writers import materialize_path, staged

C = F.col

_VESSEL_DATES = "DEPARTURE_DATE ACTUAL_ARRIVAL_DATE ESTIMATED_ARRIVAL_DATE"


@query("m1_silver_vessels", replaced("y_vessels", _VESSEL_DATES, "REPORT_DATE _INGESTED_AT"))
def m1(spark, sf_dir):
    """M1: cleaned vessel reports."""
    return Domain(spark, sf_dir).silver_vessels()


@query("m2_silver_ports", replaced("y_ports", stamps="LOADED_AT"))
def m2(spark, sf_dir):
    """M2: cleaned ports."""
    return Domain(spark, sf_dir).silver_ports()


@query("m3_silver_seismic_events", replaced("y_events", stamps="EARTHQUAKE_TIME LAST_UPDATED_AT LOADED_AT"))
def m3(spark, sf_dir):
    """M3: cleaned events, last version each."""
    return Domain(spark, sf_dir).silver_events()


@query("m4_gold_vessels", replaced("z_vessels", _VESSEL_DATES + " LATEST_ARRIVAL_DATE", "REPORT_DATE"))
def m4(spark, sf_dir):
    """M4: vessels with age, size and voyage status."""
    return Domain(spark, sf_dir).gold_vessels()


@query("m5_gold_ports", replaced("z_ports"))
def m5(spark, sf_dir):
    """M5: rated ports."""
    return Domain(spark, sf_dir).gold_ports()


@query("m6_port_supply_details", replaced("z_supply"))
def m6(spark, sf_dir):
    """M6: supply and communication flags."""
    return Domain(spark, sf_dir).supply()


@query("m7_port_facilities", replaced("z_facilities"))
def m7(spark, sf_dir):
    """M7: facility flags and port kind."""
    return Domain(spark, sf_dir).facilities()


@query("m8_vessels_with_port_details", replaced("z_details", _VESSEL_DATES + " LATEST_ARRIVAL_DATE", "REPORT_DATE"))
def m8(spark, sf_dir):
    """M8: vessels with their matched destination ports."""
    return Domain(spark, sf_dir).details()


@query("m9_gold_seismic_events", replaced("z_events", stamps="EARTHQUAKE_TIME"))
def m9(spark, sf_dir):
    """M9: events with magnitude class."""
    return Domain(spark, sf_dir).gold_events()


@query("m10_seismic_port_proximity", replaced("z_proximity", rounded={"DISTANCE_KM": 3}), rounded={"DISTANCE_KM": 3})
def m10(spark, sf_dir):
    """Event-port pairs within 500 km."""
    return Domain(spark, sf_dir).proximity()


@query("m11_daily_risk", replaced("z_daily", stamps="EVENT_DATE"))
def m11(spark, sf_dir):
    """Daily risk per region."""
    return Domain(spark, sf_dir).daily()


@query(
    "m12_dim_date",
    # the calendar runs from the first to the last report day of the given orders
    "SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DATE_SK, strftime(d, '%Y-%m-%d') AS FULL_DATE,"
    " CAST(year(d) AS INTEGER) AS YEAR, CAST(month(d) AS INTEGER) AS MONTH, CAST(day(d) AS INTEGER) AS DAY,"
    " CAST(week(d) AS INTEGER) AS WEEK_OF_YEAR, CAST(quarter(d) AS INTEGER) AS QUARTER,"
    " strftime(d, '%a') AS DAY_NAME, strftime(d, '%b') AS MONTH_NAME,"
    " strftime(date_trunc('month', d), '%Y-%m-%d') AS MONTH_START_DATE,"
    " strftime(date_trunc('year', d), '%Y-%m-%d') AS YEAR_START_DATE"
    " FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)",
)
def m12(spark, sf_dir):
    """Calendar over the span of the orders."""
    span = A.table(spark, sf_dir, "orders").agg(
        F.min(F.to_date("o_orderdate")).alias("a"), F.date_add(F.max(F.to_date("o_orderdate")), 1).alias("b")
    ).first()
    return star.dim_date(spark, str(span["a"]), str(span["b"]))


@query("m13_dim_port", replaced("s_port", stamps="DIM_LOADED_AT"))
def m13(spark, sf_dir):
    """Port dimension."""
    return Domain(spark, sf_dir).dim_port()


@query("m14_dim_seismic_event",
       replaced("s_event", stamps="EARTHQUAKE_TIME EVENT_DATE EVENT_MONTH DIM_LOADED_AT"))
def m14(spark, sf_dir):
    """Event dimension."""
    return Domain(spark, sf_dir).dim_event()


@query("m15_fact_daily_seismic", replaced("s_daily", stamps="EVENT_DATE EVENT_MONTH FACT_LOADED_AT"))
def m15(spark, sf_dir):
    """Daily event fact."""
    return star.fact_daily_seismic(Domain(spark, sf_dir).daily(), A.AS_OF)


@query("m16_fact_seismic_port_proximity",
       replaced("s_proximity", stamps="FACT_LOADED_AT", rounded={"DISTANCE_KM": 3}), rounded={"DISTANCE_KM": 3})
def m16(spark, sf_dir):
    """Event-port fact."""
    d = Domain(spark, sf_dir)
    return star.fact_seismic_port_proximity(d.gold_events(), d.silver_ports(), d.dim_event(), d.dim_port(), A.AS_OF)


@query("m17_fact_vessel_voyage",
       replaced("s_voyage", _VESSEL_DATES + " LATEST_ARRIVAL_DATE", "REPORT_DATE FACT_LOADED_AT"))
def m17(spark, sf_dir):
    """Voyage fact, one row per vessel report."""
    return Domain(spark, sf_dir).voyages()


@query("m18_port_recommendations", replaced("r_out", "RUN_DATE"))
def m18(spark, sf_dir):
    """Top ports per active vessel."""
    d = Domain(spark, sf_dir)
    ports = staged(d.prepared_ports(), "scored-ports")
    active = staged(active_vessels(d.gold_vessels()), "active-vessels")
    return recommend.recommend(active, ports, A.AS_OF)


@query(
    "m19_live_seismic_monitor",
    "SELECT panel, count(*) AS n, CAST(sum(v) AS BIGINT) AS total FROM ("
    " SELECT 'map' AS panel, CAST(round(lat * 100) AS BIGINT) AS v FROM x_live WHERE coalesce(__deleted, '') <> 'true'"
    " UNION ALL SELECT 'alerts', CAST(round(lat * 100) AS BIGINT) FROM x_live"
    " WHERE coalesce(__deleted, '') <> 'true' AND mag >= 5.5"
    " UNION ALL SELECT 'magnitude_series', CAST(mag * 512 AS BIGINT) FROM x_live WHERE coalesce(__deleted, '') <> 'true'"
    " UNION ALL SELECT 'intensity_histogram', count(*) FROM x_live WHERE coalesce(__deleted, '') <> 'true'"
    " AND mag IS NOT NULL GROUP BY CASE WHEN mag < 2 THEN 1 WHEN mag < 4 THEN 2 WHEN mag < 6 THEN 3 ELSE 4 END"
    " UNION ALL SELECT 'events_per_day', count(*) FROM x_live WHERE coalesce(__deleted, '') <> 'true'"
    " GROUP BY substr(time, 1, 10)"
    " UNION ALL SELECT 'strongest', CAST(mag * 512 AS BIGINT) FROM (SELECT mag FROM x_live"
    " WHERE coalesce(__deleted, '') <> 'true' ORDER BY mag DESC NULLS LAST, source_id LIMIT 10)"
    ") GROUP BY panel",
)
def m19(spark, sf_dir):
    """Row count and a sum per panel (the panels themselves are also queries of their own)."""
    panels = monitor.live_seismic_monitor(Domain(spark, sf_dir).live())
    value = {
        "map": F.round(C("latitude") * 100), "alerts": F.round(C("latitude") * 100),
        "magnitude_series": C("magnitude") * 512, "intensity_histogram": C("count"),
        "events_per_day": C("earthquakes"), "strongest": C("magnitude") * 512,
    }
    rows = [
        p.agg(F.count(F.lit(1)).alias("n"), F.sum(value[name].cast("bigint")).alias("total")).select(
            F.lit(name).alias("panel"), "n", "total")
        for name, p in panels.items()
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


@query("m18_from_stored_tables", replaced("r_out", "RUN_DATE"))
def m18_stored(spark, sf_dir):
    """The same from the stored gold tables, all pairs of events and ports among them."""
    d = Domain(spark, sf_dir)
    stored = [staged(df, "gold") for df in (d.gold_vessels(), d.gold_ports(), d.facilities(), d.proximity(), d.gold_events())]
    return recommend.port_recommendations(*stored, A.AS_OF)


_LATEST = (
    "SELECT unid, mag, source_id FROM (SELECT *, row_number() OVER (PARTITION BY unid ORDER BY lastupdate DESC,"
    " source_id DESC) AS n FROM x_live WHERE coalesce(__deleted, '') <> 'true') WHERE n = 1"
)


@query("m19_latest_versions", _LATEST)
def m19_latest(spark, sf_dir):
    """The live table reduced to the last version per event."""
    return monitor.latest_versions(Domain(spark, sf_dir).live()).select("unid", "mag", "source_id")


@query(
    "m20_rebuild",
    "SELECT 'daily_aggregated_seismic_events' AS model, count(*) AS n FROM z_daily"
    " UNION ALL SELECT 'silver_seismic_events', count(*) FROM y_events"
    " UNION ALL SELECT 'gold_seismic_events', count(*) FROM z_events"
    " UNION ALL SELECT 'dim_seismic_event', count(*) FROM s_event"
    " UNION ALL SELECT 'fact_daily_seismic', count(*) FROM s_daily"
    " UNION ALL SELECT 'gold_seismic_port_proximity', count(*) FROM z_proximity"
    " UNION ALL SELECT 'fact_seismic_port_proximity', count(*) FROM s_proximity",
)
def m20(spark, sf_dir):
    """The event tables rebuilt from the cleaned events on, stored and checked."""
    d = Domain(spark, sf_dir)
    root = scratch(spark, "rebuild")
    given = {
        "seismic": d.seismic(), "silver_ports": d.silver_ports(), "dim_port": d.dim_port(),
        "dim_date": star.dim_date(spark, "2024-01-01", "2024-02-01"),
    }
    built, _ = rebuilds.rebuild(
        rebuilds.models(spark, A.AS_OF), given, lambda n, df: materialize_path(df, f"{root}/{n}"),
        select="silver_seismic_events",
    )
    names = rebuilds.downstream(rebuilds.models(spark, A.AS_OF), "silver_seismic_events")
    out = None
    for n in names:
        row = built[n].agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("model"), "n")
        out = row if out is None else out.unionByName(row)
    return out



def _incremental(spark, sf_dir, as_of) -> Incremental:
    """The star with its ports loaded."""
    d = Domain(spark, sf_dir)
    inc = Incremental(spark, scratch(spark, "star"), as_of, d.aliases(), ("1992-01-01", "2024-03-01"), buckets=8)
    loaded = F.lit("2024-01-10 00:00:00").cast("timestamp")
    inc.ports(d.ports().withColumn("_LOADED_AT", loaded))
    return inc


@query("m20_incremental_daily", replaced("s_daily", stamps="EVENT_DATE EVENT_MONTH FACT_LOADED_AT"))
def m20_daily(spark, sf_dir):
    """The daily fact after two event days, of which the second revises the first."""
    inc, rows = _incremental(spark, sf_dir, A.AS_OF), Domain(spark, sf_dir).seismic()
    inc.events(rows.filter("lastupdate < timestamp '2024-01-16'"))
    inc.events(rows)
    return inc.read("fact_daily_seismic")


@query("m20_incremental_voyages",
       "SELECT * FROM (" + replaced("s_voyage", _VESSEL_DATES + " LATEST_ARRIVAL_DATE", "REPORT_DATE FACT_LOADED_AT") + ") WHERE REPORT_DATE IS NOT NULL")
def m20_voyages(spark, sf_dir):
    """The voyage fact after two ingests of the reports."""
    inc, rows = _incremental(spark, sf_dir, A.VESSELS_AS_OF), Domain(spark, sf_dir).vessels()
    late = F.pmod(F.xxhash64(F.trim("name")), F.lit(2)) == 0
    second = F.when(late, C("_INGESTED_AT") + F.expr("INTERVAL 40 YEARS")).otherwise(C("_INGESTED_AT"))
    inc.vessels(rows.filter(F.coalesce(~late, F.lit(True))))
    inc.vessels(rows.withColumn("_INGESTED_AT", second))
    return inc.read("fact_vessel_voyage")


_KEPT_LIVE = "FROM x_live WHERE coalesce(__deleted, '') <> 'true'"
_NO = {"category": "CAST(NULL AS VARCHAR)", "day": "CAST(NULL AS VARCHAR)", "latitude": "CAST(NULL AS DOUBLE)",
       "longitude": "CAST(NULL AS DOUBLE)", "magnitude": "CAST(NULL AS DOUBLE)", "title": "CAST(NULL AS VARCHAR)", "n": "CAST(1 AS BIGINT)"}


def _panel_sql(name: str, rest: str, **columns: str) -> str:
    return f"SELECT '{name}' AS panel, " + ", ".join(f"{columns.get(c, e)} AS {c}" for c, e in _NO.items()) + f" {_KEPT_LIVE} {rest}"


_POINT = {"latitude": "lat", "longitude": "lon", "magnitude": "mag", "title": "flynn_region"}


@query(
    "m19_panels",
    " UNION ALL ".join([
        _panel_sql("map", "AND lat IS NOT NULL AND lon IS NOT NULL", **_POINT),
        _panel_sql("alerts", "AND lat IS NOT NULL AND lon IS NOT NULL AND mag >= 5.5", **_POINT),
        _panel_sql("magnitude_series", "AND time IS NOT NULL", day="substr(time, 1, 10)", magnitude="mag"),
        _panel_sql("intensity_histogram", "AND mag IS NOT NULL GROUP BY 2", n="count(*)",
                   category="CASE WHEN mag < 2 THEN 'Minor (<2)' WHEN mag < 4 THEN 'Light (2-4)' WHEN mag < 6 THEN 'Moderate (4-6)' ELSE 'Strong (6+)' END"),
        _panel_sql("events_per_day", "AND time IS NOT NULL GROUP BY 3", n="count(*)", day="substr(time, 1, 10)"),
    ]),
)
def m19_panels(spark, sf_dir):
    """Five panels by value from one scan of the live table."""
    rows = staged(monitor.panel_rows(Domain(spark, sf_dir).live()), "panels")
    out = None
    for name in monitor.PANELS:
        p = monitor.panel(rows, name)
        part = p
        if name == "magnitude_series":
            part = p.withColumn("day", F.date_format("time", "yyyy-MM-dd"))
        elif name == "events_per_day":
            part = p.select(F.date_format("day", "yyyy-MM-dd").alias("day"), C("earthquakes").alias("n"))
        elif name == "intensity_histogram":
            part = p.select("category", C("count").alias("n"))
        none = {"category": "string", "day": "string", "latitude": "double", "longitude": "double", "magnitude": "double", "title": "string"}
        cells = [(C(c) if c in part.columns else F.lit(None)).cast(t).alias(c) for c, t in none.items()]
        part = part.select(F.lit(name).alias("panel"), *cells, (C("n") if "n" in part.columns else F.lit(1)).cast("bigint").alias("n"))
        out = part if out is None else out.unionByName(part)
    return out

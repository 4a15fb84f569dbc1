"""Live monitor: the panels over the append-only event table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.functions.seismic import intensity_bucket
from tidewatch.functions.text import parse_best_effort
from tidewatch.operators import aggregates, filters
from tidewatch.operators.dedup import top_per_key

C = F.col


def latest_versions(live: DataFrame) -> DataFrame:
    """The last version per event; the panels themselves count every version."""
    order = [C("lastupdate").desc_nulls_last(), C("source_id").desc_nulls_last()]
    return top_per_key(live, ["unid"], order)


#: The panels that one pass gives, with the columns of each.
PANELS = ("map", "alerts", "magnitude_series", "intensity_histogram", "events_per_day")


def panel_rows(live: DataFrame, latest: bool = False) -> DataFrame:
    """Rows of five panels from one scan: panel, key, latitude, longitude, magnitude, title, time, n.

    Every event gives a row to each panel it belongs to. Counted panels add up before the shuffle, by panel and key, and
    the points, alerts and series pass through the same aggregation as groups of their own row, under a number that makes
    rows of equal content one row with their count ``n``. Split it with :func:`panel`.
    """
    rows = latest_versions(live) if latest else live
    dated = C("event_time").isNotNull()
    when = parse_best_effort("event_time")
    placed = C("lat").isNotNull() & C("lon").isNotNull()
    none = {"key": "string", "latitude": "double", "longitude": "double", "magnitude": "double", "title": "string", "time": "timestamp"}

    def entry(name: str, keep, **columns):
        cells = [columns.get(c, F.lit(None)).cast(t).alias(c) for c, t in none.items()]
        return F.when(keep, F.struct(F.lit(name).alias("panel"), *cells))

    point = {"latitude": C("lat"), "longitude": C("lon"), "magnitude": C("mag"), "title": C("flynn_region")}
    entries = F.array(
        entry("map", placed, **point),
        entry("alerts", placed & (C("mag") >= fixed.ALERT_MAGNITUDE), **point),
        entry("magnitude_series", dated, time=when, magnitude=C("mag")),
        entry("intensity_histogram", C("mag").isNotNull(), key=intensity_bucket(C("mag"))),
        entry("events_per_day", dated, key=F.to_date(when)),
    )
    each = rows.select(F.explode(F.filter(entries, lambda e: e.isNotNull())).alias("e")).select("e.*")
    return each.groupBy("panel", *none).agg(F.count(F.lit(1)).alias("n"))


def panel(rows: DataFrame, name: str) -> DataFrame:
    """One panel of :func:`panel_rows` with the columns :func:`live_seismic_monitor` gives it."""
    own = rows.filter(C("panel") == name)
    if name == "intensity_histogram":
        return own.select(C("key").alias("category"), C("n").alias("count"))
    if name == "events_per_day":
        return own.select(C("key").cast("date").alias("day"), C("n").alias("earthquakes")).orderBy("day")
    columns = ["time", "magnitude"] if name == "magnitude_series" else ["latitude", "longitude", "magnitude", "title"]
    # as many rows as there were events
    return own.withColumn("_", F.explode(F.sequence(F.lit(1), C("n").cast("int")))).select(*columns)


def live_seismic_monitor(live: DataFrame, latest: bool = False) -> dict[str, DataFrame]:
    """All six panels by name."""
    rows = latest_versions(live) if latest else live
    return {
        "map": filters.mapped_points(rows),
        "alerts": filters.strong_event_alerts(rows),
        "magnitude_series": aggregates.magnitude_series(rows, ordered=True),
        "intensity_histogram": aggregates.intensity_histogram(rows),
        "events_per_day": aggregates.events_per_day(rows).orderBy("day"),
        "strongest": aggregates.strongest_events(rows),
    }

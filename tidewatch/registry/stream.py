"""Streaming queries (R): a file stream over the staged table, run to its end."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import adapters as A
from tidewatch import fixed, schemas
from tidewatch.operators import aggregates, merge
from tidewatch.plans import silver
from tidewatch.registry.base import query
from tidewatch.registry.common import Domain
from tidewatch.registry.sql import replaced
from tidewatch.session import scratch
from tidewatch.sources import readers
from tidewatch.sources.keyed import KeyedTable
from tidewatch.sources.writers import staged
from tidewatch.streaming import cdc, events

C = F.col

SLICES = 3  # arrivals per feed


def feed(spark, df, name: str, start) -> None:
    """Let the whole frame arrive in ``seq`` order, in slices, and run the stream after each.

    ``start(stream)`` starts the query; as it keeps its checkpoint, every run
    goes on where the last one ended.
    """
    path = scratch(spark, f"feed-{name}")
    low, high = df.agg(F.min("seq"), F.max("seq")).first()
    slice_ = F.floor((C("seq") - low) * SLICES / (high - low + 1))
    for i in range(SLICES):
        df.filter(slice_ == i).write.mode("append").parquet(path)
        start(spark.readStream.schema(df.schema).parquet(path)).awaitTermination()


_KEPT = "coalesce(__deleted, '') <> 'true'"
_NET = (
    "SELECT unid, source_id, action FROM (SELECT s.*, row_number() OVER (PARTITION BY s.unid ORDER BY s.seq) AS n"
    " FROM x_live s JOIN (SELECT unid, max(seq) FILTER (WHERE action <> 'create') AS last,"
    " arg_max(action, seq) FILTER (WHERE action <> 'create') AS how FROM x_live GROUP BY unid) k USING (unid)"
    " WHERE (k.how = 'update' AND s.seq = k.last) OR (s.action = 'create' AND (k.how IS NULL"
    " OR (k.how = 'delete' AND s.seq > k.last)))) WHERE n = 1"
)


def _event_table(spark, name: str) -> KeyedTable:
    schema = T.StructType([*schemas.EVENT_ROW.fields, T.StructField("seq", T.LongType())])
    return KeyedTable(spark, scratch(spark, name), schema, ["unid"], buckets=8)


@query("r1_apply_event_actions", _NET)
def r1(spark, sf_dir):
    """Net effect of all messages on an empty table, as one batch."""
    parsed = readers.parse_event_messages(A.event_messages(spark, sf_dir), carry=("seq",))
    messages = staged(parsed, "messages")  # read three times below
    empty = spark.createDataFrame([], messages.schema)
    return merge.apply_event_actions(empty, messages).select("unid", "source_id", "action")


@query("r1_stream_upserts", _NET)
def r1_stream(spark, sf_dir):
    """The same messages as a stream into a keyed table."""
    table, cp = _event_table(spark, "upserts"), scratch(spark, "cp")
    feed(spark, A.event_messages(spark, sf_dir), "messages", lambda messages: events.upsert_events(
        readers.parse_event_messages(messages, carry=("seq",)), table, cp))
    return table.read().select("unid", "source_id", "action")


_ROW = ", ".join(fixed.EVENT_COLUMNS)


@query("r2_unwrap_cdc", f"SELECT seq, {_ROW}, coalesce(__deleted, 'false') AS __deleted FROM x_live WHERE seq % 41 <> 0")
def r2(spark, sf_dir):
    """Envelopes to rows; deletes are marked, tombstones dropped."""
    return cdc.unwrap_cdc(A.envelopes(spark, sf_dir), carry=("seq",))


_LIVE = f"SELECT {', '.join('time AS event_time' if c == 'time' else c for c in fixed.EVENT_COLUMNS)} FROM x_live WHERE {_KEPT}"


@query("r3_live_events", _LIVE)
def r3(spark, sf_dir):
    """Every kept version appended."""
    path, cp = scratch(spark, "live"), scratch(spark, "cp")
    feed(spark, A.live(spark, sf_dir), "live", lambda rows: cdc.write_cdc_append(cdc.live_events(rows), path, cp))
    return spark.read.parquet(path)


@query("r4_skip_broken", f"SELECT {_ROW} FROM x_live")
def r4(spark, sf_dir):
    """A stream in which every message is followed by a broken one."""
    good = A.event_messages(spark, sf_dir)
    both = good.unionByName(good.withColumn("value", F.substring("value", 1, 9)))
    path, cp = scratch(spark, "unbroken"), scratch(spark, "cp")
    feed(spark, both, "broken", lambda rows: cdc.write_cdc_append(readers.parse_event_messages(rows), path, cp))
    return spark.read.parquet(path)


@query("r4_dead_letters", "SELECT seq, '{\"action\"' AS value FROM x_live")
def r4_dead(spark, sf_dir):
    """The broken messages of the same stream, with offset and text."""
    good = A.event_messages(spark, sf_dir)
    both = good.unionByName(good.withColumn("value", F.substring("value", 1, 9)))
    root = scratch(spark, "letters")
    feed(spark, both, "letters", lambda rows: events.follow_with_dead_letters(
        rows, f"{root}/good", f"{root}/dead", f"{root}/cp"))
    return events.read_batches(spark, f"{root}/dead").select("seq", "value")


@query("a16_buffered_append", _LIVE)
def a16_buffered(spark, sf_dir):
    """A backlog of files taken in batches of one file."""
    rows, root = A.live(spark, sf_dir), scratch(spark, "buffered")
    rows.repartition(5, "seq").write.parquet(f"{root}/in")
    stream = cdc.admit(spark.readStream.schema(rows.schema), files=1).parquet(f"{root}/in")
    cdc.write_cdc_append(cdc.live_events(stream), f"{root}/out", f"{root}/cp", cdc.buffer_trigger(None)).awaitTermination()
    return spark.read.parquet(f"{root}/out")


_SILVER = replaced("y_events", stamps="EARTHQUAKE_TIME LAST_UPDATED_AT LOADED_AT")


@query("r5_merge_revisions", _SILVER)
def r5(spark, sf_dir):
    """Events cleaned up to mid-month, then everything within 24 hours before and after merged in."""
    bronze = Domain(spark, sf_dir).seismic()
    held = silver.silver_seismic_events(bronze.filter("lastupdate < timestamp '2024-01-16'"), A.AS_OF)
    newest = aggregates.high_watermark(held, "LAST_UPDATED_AT")
    fresh = silver.silver_seismic_events(bronze, A.AS_OF, newest)
    return merge.merge_incremental(held, fresh, ["EVENT_ID"])


@query("r5_follow_revisions", _SILVER)
def r5_stream(spark, sf_dir):
    """The cleaned events kept current by a stream."""
    changes = A.seismic(spark, sf_dir)
    schema = silver.silver_seismic_events(changes, A.AS_OF).schema
    table = KeyedTable(spark, scratch(spark, "revisions"), schema, ["EVENT_ID"], buckets=8)
    cp = scratch(spark, "cp")
    feed(spark, changes, "changes", lambda rows: events.follow_revisions(rows, table, cp, A.AS_OF))
    return table.read()


@query("r5_watermarked_revisions", _SILVER)
def r5_watermarked(spark, sf_dir):
    """The same, with the stream's own watermark deciding what is too late."""
    changes = A.seismic(spark, sf_dir)
    schema = silver.silver_seismic_events(changes, A.AS_OF).schema
    table = KeyedTable(spark, scratch(spark, "watermarked"), schema, ["EVENT_ID"], buckets=8)
    cp = scratch(spark, "cp")
    feed(spark, changes, "changes", lambda rows: events.follow_revisions_watermarked(rows, table, cp, A.AS_OF))
    return table.read()


@query("r6_backfill_then_stream", _NET)
def r6(spark, sf_dir):
    """Every start brings the created rows of its own time as history, then the messages; the overlap adds nothing."""
    messages = A.event_messages(spark, sf_dir)
    created = readers.parse_event_messages(messages, carry=("seq",)).filter("action = 'create'")
    low, high = messages.agg(F.min("seq"), F.max("seq")).first()
    slice_ = F.floor((C("seq") - low) * SLICES / (high - low + 1))
    histories = iter([created.filter(slice_ == i) for i in range(SLICES)])
    table, cp = _event_table(spark, "backfilled"), scratch(spark, "cp")
    feed(spark, messages, "messages", lambda rows: events.backfill_then_stream(
        next(histories), readers.parse_event_messages(rows, carry=("seq",)), table, cp))
    return table.read().select("unid", "source_id", "action")


@query("r7_snapshot_then_changes", _LIVE)
def r7(spark, sf_dir):
    """Created rows as the snapshot, the others as changes."""
    rows, path = A.live(spark, sf_dir), scratch(spark, "snapshot-live")
    snapshot, changes = rows.filter("action = 'create'"), rows.filter("action <> 'create'")
    cp = scratch(spark, "cp")
    feed(spark, changes, "changes", lambda new: cdc.snapshot_then_changes(snapshot, new, path, cp))
    return cdc.read_live(spark, path)


def _feed_live(spark, sf_dir, start) -> None:
    feed(spark, A.live(spark, sf_dir), "live", lambda rows: start(cdc.live_events(rows)))


@query(
    "r8_live_histogram",
    "SELECT category, count(*) AS count FROM (SELECT CASE WHEN mag < 2 THEN 'Minor (<2)' WHEN mag < 4 THEN 'Light (2-4)'"
    f" WHEN mag < 6 THEN 'Moderate (4-6)' ELSE 'Strong (6+)' END AS category FROM x_live WHERE {_KEPT}"
    " AND mag IS NOT NULL) GROUP BY category",
)
def r8_histogram(spark, sf_dir):
    """Running magnitude histogram."""
    path, cp = scratch(spark, "histogram"), scratch(spark, "cp")
    _feed_live(spark, sf_dir, lambda live: events.live_counts(live, "histogram", path, cp))
    return events.newest_counts(spark, path)


@query("r8_live_days", f"SELECT substr(time, 1, 10) AS day, count(*) AS earthquakes FROM x_live WHERE {_KEPT} GROUP BY 1")
def r8_days(spark, sf_dir):
    """Running counts per day."""
    path, cp = scratch(spark, "days"), scratch(spark, "cp")
    _feed_live(spark, sf_dir, lambda live: events.live_counts(live, "days", path, cp))
    return events.newest_counts(spark, path)


@query(
    "r9_strong_event_alerts",
    "SELECT lat AS latitude, lon AS longitude, mag AS magnitude, flynn_region AS title FROM x_live"
    f" WHERE {_KEPT} AND mag >= 5.5",
)
def r9(spark, sf_dir):
    """Strong events as they come."""
    path, cp = scratch(spark, "alerts"), scratch(spark, "cp")
    _feed_live(spark, sf_dir, lambda live: events.follow_alerts(live, path, cp))
    return spark.read.parquet(path)


@query(
    "r10_live_strongest",
    f"SELECT source_id, mag, flynn_region FROM x_live WHERE {_KEPT} ORDER BY mag DESC NULLS LAST, source_id LIMIT 10",
)
def r10(spark, sf_dir):
    """The ten strongest so far."""
    table = events.strongest_table(spark, scratch(spark, "strongest"), A.schema_of_live())
    cp = scratch(spark, "cp")
    _feed_live(spark, sf_dir, lambda live: events.follow_strongest(live, table, cp))
    return table.read().select("source_id", "mag", "flynn_region")

"""Jobs that keep tables current from streams.

Each merges micro-batches with ``foreachBatch`` into a keyed table. A batch is
applied once: its id is recorded with the table's new state under a name that
belongs to the checkpoint, and a batch that is run again is skipped. Feeds with
checkpoints of their own never hide each other's batches.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.operators import aggregates, merge
from tidewatch.operators.dedup import latest_events
from tidewatch.operators.filters import drop_soft_deleted, strong_event_alerts
from tidewatch.plans import silver
from tidewatch.sources import readers
from tidewatch.sources.keyed import GONE, KeyedTable

C = F.col


def _run(stream: DataFrame, checkpoint: str, each, trigger: dict | None, mode: str = "append"):
    return (
        stream.writeStream.foreachBatch(each)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def source_of(table: KeyedTable, checkpoint: str) -> str:
    """Name of the feed that a checkpoint belongs to, kept beside it; a fresh checkpoint gets a new one."""
    path = f"{checkpoint.rstrip('/')}-source"
    if not (table.exists(f"{checkpoint.rstrip('/')}/offsets") and table.exists(f"{path}/_SUCCESS")):
        row = table.spark.createDataFrame([(uuid.uuid4().hex,)], "value string").coalesce(1)
        row.write.mode("overwrite").text(path)
    return table.spark.read.text(path).first()[0]


def upsert_events(
    stream: DataFrame, table: KeyedTable, checkpoint: str, sequence: str = "seq", trigger: dict | None = None
):
    """Apply create / update / delete messages to the event table, in sequence order."""
    source = source_of(table, checkpoint)

    def each(batch: DataFrame, batch_id: int) -> None:
        apply_messages(table, batch, sequence, source, batch_id)

    return _run(stream, checkpoint, each, trigger)


def apply_messages(
    table: KeyedTable, messages: DataFrame, sequence: str = "seq", source: str = "batch", batch_id: int | None = None
) -> bool:
    """One merge of messages into the event table.

    The net effect reads the messages several times, so the batch is kept for
    the duration of the merge instead of being fetched again from its source.
    """
    kept = messages.persist()
    try:
        effects = merge.net_actions(kept, "unid", sequence)
        return table.merge(effects, lambda target, rows: merge.changed_rows(target, rows, "unid", GONE), source, batch_id, changes=True)
    finally:
        kept.unpersist()


def backfill_start(table: KeyedTable, as_of: str):
    """From when to fetch history: the newest event ever held, else an hour before ``as_of``; a look into the manifest."""
    newest = table.mark("time")
    if newest is not None:
        return newest
    hour_ago = F.lit(as_of).cast("timestamp") - F.expr("INTERVAL 1 HOUR")
    return table.spark.range(1).select(F.date_format(hour_ago, "yyyy-MM-dd HH:mm:ss")).first()[0]


def backfill_then_stream(
    history: DataFrame, stream: DataFrame, table: KeyedTable, checkpoint: str, sequence: str = "seq",
    trigger: dict | None = None,
):
    """Insert history that the table lacks, then follow the stream.

    Overlap between the two is harmless: history only creates, and a create
    counts only for absent events. So every start may bring its own history;
    one that is repeated brings back only what was deleted meanwhile.
    """
    created = history.withColumn("action", F.lit("create"))
    apply_messages(table, created, sequence)
    return upsert_events(stream, table, checkpoint, sequence, trigger=trigger)


def follow_revisions(
    stream: DataFrame, table: KeyedTable, checkpoint: str, as_of: str, window_hours: int | None = None,
    trigger: dict | None = None,
):
    """Keep the cleaned event table current: the newest version per event wins.

    A version older than the one held does not replace it, whatever order
    the messages arrive in. By default nothing is too late; with
    ``window_hours`` (24 in the batch form) versions updated longer than that
    before the newest one held are left out.
    """

    source = source_of(table, checkpoint)

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = drop_soft_deleted(silver.seismic_rows(batch))
        newest = table.mark("LAST_UPDATED_AT") if window_hours is not None else None
        if newest is not None:
            oldest = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {int(window_hours)} HOURS")
            rows = rows.filter(C("LAST_UPDATED_AT") >= oldest)
        _merge_versions(table, rows, as_of, source, batch_id)

    return _run(stream, checkpoint, each, trigger)


def _merge_versions(table: KeyedTable, rows: DataFrame, as_of: str, source: str, batch_id: int) -> None:
    rows = latest_events(rows).drop("__deleted").withColumn("LOADED_AT", F.lit(as_of).cast("timestamp"))
    table.merge(rows, lambda target, fresh: latest_events(target.unionByName(fresh)), source, batch_id)


def follow_revisions_watermarked(
    stream: DataFrame, table: KeyedTable, checkpoint: str, as_of: str, delay: str = "24 hours", trigger: dict | None = None,
):
    """As :func:`follow_revisions`, with the lateness kept by the stream itself.

    The watermark is the newest update time of earlier batches less ``delay``. Versions behind it are
    dropped before they reach the table; within it each version is merged once, however often it is delivered. The state
    holds one small row per version of the last ``delay``, and forgets it then.
    """
    source = source_of(table, checkpoint)
    versions = drop_soft_deleted(silver.seismic_rows(stream)).withWatermark("LAST_UPDATED_AT", delay)
    versions = versions.dropDuplicatesWithinWatermark(["EVENT_ID", "SOURCE_ID", "LAST_UPDATED_AT"])

    def each(batch: DataFrame, batch_id: int) -> None:
        _merge_versions(table, batch, as_of, source, batch_id)

    return _run(versions, checkpoint, each, trigger)


COUNTS = {"histogram": (aggregates.intensity_histogram, "category"), "days": (aggregates.events_per_day, "day")}


def live_counts(stream: DataFrame, what: str, path: str, checkpoint: str, trigger: dict | None = None):
    """Running dashboard counts (``histogram`` or ``days``) in a keyed table at ``path``.

    A trigger hands on the groups that changed, and they replace what the table holds of them. A new
    checkpoint counts from the start again and ends with the same table. Read it with :func:`newest_counts`.
    """
    count, key = COUNTS[what]
    # a key that is never NULL, as NULL would match nothing in the table
    counted = count(stream).withColumn("_key", F.coalesce(C(key).cast("string"), F.lit("")))
    table = KeyedTable(stream.sparkSession, path, counted.schema, ["_key"], buckets=1)
    source = source_of(table, checkpoint)

    def each(changed: DataFrame, batch_id: int) -> None:
        table.merge(changed, lambda held, rows: rows, source, batch_id)

    return _run(counted, checkpoint, each, trigger, mode="update")


def newest_counts(spark: SparkSession, path: str) -> DataFrame:
    return KeyedTable.open(spark, path).read().drop("_key")


def follow_with_dead_letters(
    messages: DataFrame, good: str, dead: str, checkpoint: str, offset: str = "seq", trigger: dict | None = None
):
    """Event messages that parse go to ``good`` as rows, the others with their offset and text to ``dead``.

    One stream, two sinks: each batch writes a folder of its own on both sides, named by its number and overwritten if it
    is run again. So a batch that failed between the two counts once on either side. Read both with :func:`read_batches`.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        marked = readers.is_event_message(batch).persist()  # taken from the source once; lost blocks are taken again
        try:
            rows = readers.parse_event_messages(marked.filter("_ok"), carry=(offset,))
            rows.write.mode("overwrite").parquet(f"{good}/batch={batch_id}")
            marked.filter("NOT _ok").select(offset, "value").write.mode("overwrite").parquet(f"{dead}/batch={batch_id}")
        finally:
            marked.unpersist()

    return _run(messages, checkpoint, each, trigger)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all batches below ``path``."""
    return spark.read.parquet(path).drop("batch")


def follow_alerts(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Append every strong event to the alert table."""
    return (
        strong_event_alerts(stream).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start(path)
    )


def follow_strongest(
    stream: DataFrame, table: KeyedTable, checkpoint: str, n: int = fixed.STRONGEST_SHOWN, trigger: dict | None = None
):
    """Keep the n strongest rows: each batch's best against the n held so far."""
    best = [C("mag").desc_nulls_last(), C("source_id").asc_nulls_last()]
    source = source_of(table, checkpoint)

    def combine(held: DataFrame, rows: DataFrame) -> DataFrame:
        return held.unionByName(rows).orderBy(*best).limit(n)

    def each(batch: DataFrame, batch_id: int) -> None:
        names = [f.name for f in table.schema.fields]
        top = batch.orderBy(*best).limit(n).select(*names)
        table.merge(top, combine, source, batch_id, whole=True)  # which rows stay depends on all of them

    return _run(stream, checkpoint, each, trigger)


def strongest_table(spark: SparkSession, root: str, live_schema) -> KeyedTable:
    """Table for :func:`follow_strongest`: one bucket, since it holds n rows."""
    return KeyedTable(spark, root, live_schema, ["source_id"], buckets=1)

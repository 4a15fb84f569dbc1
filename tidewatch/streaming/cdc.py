"""Change feeds: source, envelope, soft deletes, append sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from tidewatch import fixed, schemas
from tidewatch.operators.filters import drop_soft_deleted_live

C = F.col

REGISTRY_HEADER_BYTES = 5  # magic byte and schema id before the Avro payload


def strip_registry_header(value: Column) -> Column:
    """Avro payload of a registry-framed message."""
    return F.substring(value, F.lit(REGISTRY_HEADER_BYTES + 1), F.octet_length(value))


def read_cdc_stream(
    spark: SparkSession, servers: str, topic: str, avro_schema: str, max_offsets: int | None = None,
    starting: str = "earliest",
) -> DataFrame:
    """Change rows of a Kafka topic in registry-framed Avro.

    Needs Spark's Kafka and Avro packages on the class path. ``earliest``
    reads the initial snapshot the topic holds and then its changes.
    """
    from pyspark.sql.avro.functions import from_avro

    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    decoded = from_avro(strip_registry_header(C("value")), avro_schema, {"mode": "PERMISSIVE"})
    return skip_broken(reader.load().select(decoded.alias("row"), "partition", "offset"), "row").select(
        "row.*", "partition", "offset"
    )


def admit(reader: DataStreamReader, files: int | None = None, size: str | None = None) -> DataStreamReader:
    """A file-stream reader that hands on a backlog in batches of at most so many files, or of about ``size`` (``64m``).

    What a batch leaves is taken by the next ones; nothing is skipped. A single file beyond the size is a batch of its own.
    Kafka's reader counts records instead, see ``max_offsets`` of :func:`read_cdc_stream`.
    """
    if files is not None and size is not None:
        raise ValueError("give a number of files or a size, not both")
    if files is not None:
        return reader.option("maxFilesPerTrigger", files)
    return reader.option("maxBytesPerTrigger", size) if size is not None else reader


def buffer_trigger(seconds: float | None) -> dict:
    """How often a sink flushes: every so many seconds, or, with None, once for all that is there."""
    return {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}


def skip_broken(df: DataFrame, parsed: str) -> DataFrame:
    """Drop rows whose message did not parse."""
    return df.filter(C(parsed).isNotNull())


def unwrap_cdc(envelopes: DataFrame, text: str = "value", carry: tuple[str, ...] = ()) -> DataFrame:
    """Row state after each change; a delete keeps the old row marked ``__deleted``.

    Tombstones (NULL messages) and messages that are not envelopes carry no
    row and are dropped.
    """
    parsed = envelopes.withColumn("_e", F.from_json(C(text), schemas.CDC_ENVELOPE))
    state = F.coalesce("_e.after", "_e.before")
    return (
        skip_broken(parsed, "_e")
        .withColumn("_row", state)
        .filter(C("_row").isNotNull())
        .select("_row.*", F.when(C("_e.op") == "d", "true").otherwise("false").alias("__deleted"), *carry)
    )


def live_events(changes: DataFrame) -> DataFrame:
    """Append-only live rows: every version that is not a delete; ``time`` is ``event_time``."""
    kept = drop_soft_deleted_live(changes)
    return kept.select(*[C(c).alias("event_time" if c == "time" else c) for c in fixed.EVENT_COLUMNS])


def write_cdc_append(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Start the append sink; by default it takes what is there and ends.

    The sizes of its batches are set where the stream is read (:func:`admit`), their times by ``trigger`` (:func:`buffer_trigger`).
    """
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )


def snapshot_then_changes(snapshot: DataFrame, changes: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Write the table's present rows once, then follow its changes; read both with :func:`read_live`.

    A restart keeps the snapshot it finds: the rows that came since are among
    the changes. Only one that was left unfinished is written anew. The two
    lie in separate folders, since a stream's folder lists its own files only.
    """
    spark = snapshot.sparkSession
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/snapshot/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        live_events(snapshot).write.mode("overwrite").parquet(f"{path}/snapshot")
    return write_cdc_append(live_events(changes), f"{path}/changes", checkpoint, trigger)


def read_live(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/snapshot").unionByName(spark.read.parquet(f"{path}/changes"))

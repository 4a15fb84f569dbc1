"""Batch sinks: slice loads, snapshots, quarantine, layered tables, load metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.operators.filters import conform
from tidewatch.operators.quality import Verdict, judge_snapshot, snapshot_counts, validate_snapshot
from tidewatch.session import scratch

C = F.col


def replace_slices(df: DataFrame, path: str, partition: str) -> None:
    """Write only the partitions present in the frame; the others stay."""
    (
        df.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def replace_day(df: DataFrame, path: str, day: str) -> None:
    """Load a day's reports in place of the day's earlier load.

    The day is the prefix of the raw report text, so rows of other days in
    the frame are not part of the load.
    """
    of_day = df.filter(C("report_date").startswith(day)).withColumn("report_day", F.lit(day))
    replace_slices(of_day, path, "report_day")


def append_load(df: DataFrame, path: str, loaded_at: str) -> None:
    """Append a load with its stamp; duplicates are resolved when cleaning."""
    df.withColumn("_LOADED_AT", F.lit(loaded_at).cast("timestamp")).write.mode("append").parquet(path)


def append_new_files(files: DataFrame, path: str, checkpoint: str, loaded_at: str):
    """Append, with this load's stamp, the rows of all files that no earlier load took, and end.

    ``files`` is a file-source stream, and its checkpoint is the ledger of files taken: one that is offered again, or
    again after a failure, counts once. A file that is replaced under its old name counts as taken.
    """
    stamped = files.withColumn("_LOADED_AT", F.lit(loaded_at).cast("timestamp"))
    sink = stamped.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return sink.trigger(availableNow=True).start(path)


def write_snapshot(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Write the conformed snapshot unless the target exists already."""
    conform(df, columns or fixed.VESSEL_COLUMNS).write.mode("ignore").option("header", True).csv(path)


def route_quarantine(df: DataFrame, good: str, quarantine: str) -> Verdict:
    """Validate, then write to the normal or the quarantine place."""
    verdict = validate_snapshot(df)
    write_snapshot(df, good if verdict.ok else quarantine)
    return verdict


def split_quarantine(df: DataFrame, path: str, rule: Column, required: list[str] | None = None) -> Verdict:
    """Write good and bad rows below ``path`` in one pass, and judge the load by what was counted on the way.

    Rows for which ``rule`` is not true are bad. Folders ``verdict=good`` and ``verdict=bad`` hold the conformed rows. The
    counters of :func:`snapshot_counts` are observed while the rows are written, so nothing is read twice.
    """
    watch = Observation("quarantine")
    good = F.coalesce(rule, F.lit(False))
    watched = df.observe(watch, *snapshot_counts(df), F.count_if(~good).alias("bad"))
    rows = watched.withColumn("verdict", F.when(good, "good").otherwise("bad"))
    conform(rows, [*(required or fixed.VESSEL_COLUMNS), "verdict"]).write.mode("overwrite").partitionBy("verdict").parquet(path)
    counted = dict(watch.get)
    bad = counted.pop("bad")
    verdict = judge_snapshot(counted, df.columns, required)
    if bad:
        verdict.warnings.append(f"{bad} of {counted['rows']} rows quarantined")
    verdict.metrics = counted | {"bad": bad}
    return verdict


def read_verdict(spark: SparkSession, path: str, verdict: str) -> DataFrame:
    """One side of :func:`split_quarantine`."""
    return spark.read.parquet(path).filter(C("verdict") == verdict).drop("verdict")


def write_recommendations(df: DataFrame, path: str, history: bool = False) -> None:
    """Replace the table by this run; with history, only this run's day."""
    if history:
        replace_slices(df, path, "RUN_DATE")
    else:
        df.write.mode("overwrite").parquet(path)


def layer_table(layer: str | None, name: str, default: str = "default") -> str:
    """Qualified table name; a layer name is trimmed and upper-cased."""
    return f"{layer.strip().upper() if layer is not None else default}.{name}"


def materialize_table(df: DataFrame, layer: str | None, name: str, location: str | None = None) -> DataFrame:
    """Full refresh of a managed table; returns a reader of it.

    ``location`` is where the layer's database is created if it is new.
    """
    spark = df.sparkSession
    table = layer_table(layer, name)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rsplit('.', 1)[0]}{place}")
    df.write.mode("overwrite").saveAsTable(table)
    return spark.table(table)


def materialize_path(df: DataFrame, path: str) -> DataFrame:
    """Write a table and continue from the files, which cuts the lineage.

    Hashed keys are hex text of which the default codec saves nothing, zstd half.
    """
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a new table in the shared folder.

    For results that are read more than once, such as a table whose size is
    measured before it is joined; a lost executor costs a file read, not the
    work behind it.
    """
    return materialize_path(df, scratch(df.sparkSession, purpose))


def observed(df: DataFrame, name: str = "load") -> tuple[DataFrame, Observation]:
    """The frame with a row counter that fills while it is written."""
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("rows")), watch


def load_stats(spark: SparkSession, path: str, rows: int | None = None) -> dict:
    """Files and bytes below a path, with the row count of the load."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    total = files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")).first()
    return {"files": total["files"], "bytes": total["bytes"] or 0, "rows": rows}

"""Batch readers and message parsers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import fixed, schemas

C = F.col


def read_ports(spark: SparkSession, path: str) -> DataFrame:
    """Port directory CSV, by position; malformed lines are skipped.

    Every line is parsed in full, so that which lines are skipped does not
    depend on the columns a query selects. For the same reason the filter
    touches a data column: Spark parses nothing for a bare row count.
    """
    return _ports(spark.read, path)


def stream_ports(spark: SparkSession, folder: str, by_name: bool = False) -> DataFrame:
    """The directory files of a folder as a stream, parsed as by :func:`read_ports`; see ``writers.append_new_files``.

    A file is known by its path, with ``by_name`` by its name alone, wherever below the folder it lies.
    """
    return _ports(spark.readStream.option("fileNameOnly", by_name).option("recursiveFileLookup", True), folder)


def _ports(reader, path: str) -> DataFrame:
    raw = (
        reader.schema(T.StructType([*schemas.PORTS.fields, T.StructField("_bad", T.StringType())]))
        .option("header", True)
        .option("enforceSchema", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_bad")
        .option("columnPruning", False)
        .csv(path)
    )
    parsed = C("OID_").isNull() | (C("OID_") >= float("-inf"))
    return raw.filter(C("_bad").isNull() & parsed).drop("_bad")


def vessels_path(root: str, day: str) -> str:
    """Where a day's snapshot lies: ``year=/month=/vessels_<day>.csv``."""
    year, month, _ = day.split("-")
    return f"{root.rstrip('/')}/year={year}/month={month}/vessels_{day}.csv"


def read_vessels(spark: SparkSession, root: str, day: str, ingested_at: str) -> DataFrame:
    """One day's all-text snapshot with its load stamp; empty fields are NULL."""
    return read_vessel_files(spark, vessels_path(root, day), ingested_at)


def read_vessel_files(spark: SparkSession, path: str | list[str], ingested_at: str) -> DataFrame:
    raw = (
        spark.read.schema(schemas.VESSELS)
        .option("header", True)
        .option("enforceSchema", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    return raw.withColumn("_INGESTED_AT", F.lit(ingested_at).cast("timestamp"))


def load_seed(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Port name aliases: a CSV when given, else the built-in list."""
    if path:
        return spark.read.schema(schemas.ALIASES).option("header", True).csv(path)
    return spark.createDataFrame(fixed.PORT_ALIASES, schemas.ALIASES)


def _flat(properties: str, unid: Column, action: Column) -> list[Column]:
    own = {"unid": unid, "action": action}
    return [own[c].alias(c) if c in own else C(f"{properties}.{c}").alias(c) for c in fixed.EVENT_COLUMNS]


def parse_geojson_events(documents: DataFrame, text: str = "value") -> DataFrame:
    """One row per feature of backfill documents; the action is ``create``."""
    features = F.from_json(C(text), schemas.FEATURE_COLLECTION)["features"]
    return documents.select(F.explode(features).alias("f")).select(
        _flat("f.properties", C("f.id"), F.lit("create"))
    )


def read_geojson_events(spark: SparkSession, path: str) -> DataFrame:
    """Backfill files, one document per file."""
    docs = spark.read.schema(schemas.FEATURE_COLLECTION).option("multiLine", True).json(path)
    return docs.select(F.explode("features").alias("f")).select(_flat("f.properties", C("f.id"), F.lit("create")))


def _has_event(parsed: str) -> Column:
    return C(f"{parsed}.data").isNotNull() & (C(f"{parsed}.data.id").isNotNull() | C(f"{parsed}.data.properties").isNotNull())


def is_event_message(messages: DataFrame, name: str = "_ok", text: str = "value") -> DataFrame:
    """The messages with a column that says whether :func:`parse_event_messages` gives a row for them; never NULL."""
    parsed = messages.withColumn("_m", F.from_json(C(text), schemas.EVENT_MESSAGE))
    return parsed.withColumn(name, F.coalesce(_has_event("_m"), F.lit(False))).drop("_m")


def parse_event_messages(messages: DataFrame, text: str = "value", carry: tuple[str, ...] = ()) -> DataFrame:
    """Flat event rows from feed messages, batch or stream.

    Messages without data (or not JSON at all) are dropped; a missing action
    means ``create``. ``carry`` names columns to keep, such as an offset.
    """
    # as a list of one, since Spark would parse the text again for every condition that it moves below a plain column
    parsed = messages.select(*carry, F.explode(F.array(F.from_json(C(text), schemas.EVENT_MESSAGE))).alias("_m")).filter(_has_event("_m"))
    action = F.lower(F.coalesce("_m.action", F.lit("create")))
    return parsed.select(*_flat("_m.data.properties", C("_m.data.id"), action), *carry)

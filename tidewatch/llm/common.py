"""Helpers shared by the operators: staging, word expressions, row identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import scratch

#: Words are maximal runs of characters other than space, tab, LF, VT, FF and CR.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: later steps start from files all executors can reach."""
    spark, path = df.sparkSession, scratch(df.sparkSession, purpose)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 2_000) -> None:
    """Let Spark hand texts to Python in batches of at most ``rows``: the default of 10,000 takes tens of megabytes on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def whole(text: str | Column = "text") -> Column:
    """The text, or the empty string for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def n_words(text: str | Column = "text") -> Column:
    """Number of words, 0 for null."""
    return F.regexp_count(whole(text), F.lit(WORD)).cast("bigint")


def id_text(doc_id: str | Column = "doc_id") -> Column:
    """The id as text, empty for null."""
    return F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))


def crc_mod(doc_id: str, m: int) -> Column:
    """crc32 of the id's text modulo ``m``; a null id counts as empty text."""
    return F.crc32(id_text(doc_id).cast("binary")) % m


def tie_order(docs: DataFrame) -> list[Column]:
    """Order among rows equal in id and text, given as fields of a struct ``row``."""
    return [F.col(f"row.{c}") for c in ("source", "lang", "n_chars") if c in docs.columns] or [F.lit(0)]

"""Registration of queries and portable output types."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.registry.sql import with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame, rounded: dict[str, int] | None = None) -> DataFrame:
    """Dates and timestamps as ISO text and the named doubles rounded, so engines compare equal."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif rounded and f.name in rounded:
            c = F.round(c, rounded[f.name])
        out.append(c.alias(f.name))
    return df.select(out)


def query(name: str, sql: str | None = None, rounded: dict[str, int] | None = None):
    """Register a query; ``sql`` may use the tables of :mod:`tidewatch.registry.sql`."""

    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(fn(spark, sf_dir), rounded)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return fn

    return wrap

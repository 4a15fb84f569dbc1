"""Hash and text keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import fixed


def index_text(x: Column | str) -> Column:
    """Port index as text without a fraction part."""
    return (F.col(x) if isinstance(x, str) else x).cast("bigint").cast("string")


def surrogate_key(*texts: Column) -> Column:
    """MD5 over the texts joined by ``-``; NULL parts use a fixed placeholder.

    Callers format doubles and timestamps first, so that a key never depends
    on how an engine prints them.
    """
    parts = [F.coalesce(t.cast("string"), F.lit(fixed.NULL_KEY_PLACEHOLDER)) for t in texts]
    return F.md5(F.concat_ws("-", *parts))


def stamp_text(x: Column | str) -> Column:
    return F.date_format(x, "yyyy-MM-dd HH:mm:ss")


def pair_id(event_id: Column | str, port_index: Column | str) -> Column:
    event = F.col(event_id) if isinstance(event_id, str) else event_id
    return F.concat(event, F.lit("-"), index_text(port_index))

"""Keyed merges as plain DataFrame expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

C = F.col


def merge_incremental(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows without a partner in the batch, plus the whole batch.

    A NULL key part never matches, so such target rows stay and such batch
    rows are added. The result has the union of both column sets.
    """
    kept = _anti(target, batch, keys)
    return kept.unionByName(batch, allowMissingColumns=True)


def _anti(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Left anti join that keeps NULL-keyed rows out of the shuffle.

    They can match nothing, and would otherwise all meet in one task.
    """
    known = F.lit(True)
    for k in keys:
        known = known & C(k).isNotNull()
    probe = batch.select(*keys).filter(known).distinct()
    matched_out = target.filter(known).join(probe, keys, "left_anti").select(*target.columns)
    return matched_out.unionByName(target.filter(~known))


def sync_all_columns(merged: DataFrame, batch: DataFrame) -> DataFrame:
    """The batch's column set: new columns are kept, removed ones are dropped."""
    return merged.select(*[C(f"`{c}`") for c in batch.columns])


def net_actions(messages: DataFrame, key: str = "unid", sequence: str = "seq") -> DataFrame:
    """One row per key with what a run of messages does to it.

    ``ACTION`` is lower-cased; create inserts if absent, update replaces,
    delete removes, anything else is ignored. The result column ``_effect``
    is ``put`` (row wins over the target), ``add`` (row counts only if the
    target has none) or ``drop``.

    Per key the last update or delete decides: an update wins itself; after a
    delete the first later create wins, if any; without either the first
    create is an add. The two aggregates below have partial steps, so a hot
    key costs one row per map task.
    """
    known = messages.withColumn("action", F.lower("action")).filter(
        C("action").isin("create", "update", "delete") & C(key).isNotNull()
    )
    row = F.struct(*[C(f"`{c}`") for c in known.columns])
    # the aggregates hold one row each; sequence numbers are unique per key
    decisive = C("action") != "create"
    last = known.groupBy(key).agg(
        F.max(F.when(decisive, C(sequence))).alias("_last"),
        F.max_by(F.when(C("action") == "update", row), F.when(decisive, C(sequence))).alias("_update"),
    )
    creates = known.filter(C("action") == "create")
    late = (
        creates.join(last.select(key, "_last"), key)
        .filter(C("_last").isNull() | (C(sequence) > C("_last")))
        .groupBy(key)
        .agg(F.min_by(F.struct(*[C(f"`{c}`") for c in known.columns]), C(sequence)).alias("_create"))
    )
    picked = last.join(late, key, "left").select(
        F.coalesce("_update", "_create", F.struct(*[
            (C(key) if c == key else F.lit(None).cast(known.schema[c].dataType)).alias(c) for c in known.columns
        ])).alias("row"),
        F.when(C("_update").isNotNull() | (C("_last").isNotNull() & C("_create").isNotNull()), "put")
        .when(C("_last").isNotNull(), "drop")
        .otherwise("add")
        .alias("_effect"),
    )
    return picked.select("row.*", "_effect")


def apply_effects(target: DataFrame, effects: DataFrame, key: str = "unid") -> DataFrame:
    """Target after the net effects of :func:`net_actions`; one join of the two by key."""
    names = target.columns
    held = target.filter(C(key).isNotNull()).select(C(key).alias("_k"), F.struct(*names).alias("_t"))
    new = effects.select(C(key).alias("_k"), F.struct(*names).alias("_e"), "_effect")
    after = F.when(C("_effect") == "put", C("_e")).when(
        C("_effect").isNull() | (C("_effect") == "add"), F.coalesce("_t", "_e")
    )
    merged = held.join(new, "_k", "full_outer").select(after.alias("r")).filter(C("r").isNotNull()).select("r.*")
    # rows without a key match nothing and stay out of the shuffle
    return merged.unionByName(target.filter(C(key).isNull()))


def changed_rows(target: DataFrame, effects: DataFrame, key: str, gone: str) -> DataFrame:
    """The rows that :func:`apply_effects` adds or replaces, and with ``gone`` set the keys it removes.

    Of the target only the keys are read, and what stays as it is is not among the rows.
    """
    held = target.filter(C(key).isNotNull()).select(C(key).alias("_k"), F.lit(True).alias("_held"))
    # one column of a compressed table looks small enough to broadcast long after it isn't
    both = effects.join(held.hint("merge"), C(key) == C("_k"), "left")
    there = C("_held").isNotNull()
    changes = both.filter((C("_effect") == "put") | ((C("_effect") == "add") & ~there) | ((C("_effect") == "drop") & there))
    return changes.select(*target.columns, (C("_effect") == "drop").alias(gone))


def apply_event_actions(target: DataFrame, messages: DataFrame, key: str = "unid", sequence: str = "seq") -> DataFrame:
    """Target after the messages, in sequence order."""
    return apply_effects(target, net_actions(messages, key, sequence), key)

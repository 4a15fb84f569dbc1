"""From raw documents to packed sequences, one operator per stage.

Every stage reads what its predecessor kept; its result is written before the
next one starts. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import language_id, mixing, near_duplicates, packing, quality_rules
from tidewatch.llm.common import stage, table


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; those without letters, or unlike every learned language, go."""
    return language_id.in_a_language(docs)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and every certified cutoff."""
    return quality_rules.good_documents(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_duplicates.without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences: bin_id, doc_id, piece, start, n_words, position, bin_words."""
    return packing.pack(docs)


STAGES = [
    ("language ID", keep_languages),
    ("quality rules", keep_good),
    ("near duplicates", drop_near_duplicates),
    ("source mix", mix_sources),
    ("packing", pack),
]

#: Language profiles, hashed signatures and packing have no SQL form; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)

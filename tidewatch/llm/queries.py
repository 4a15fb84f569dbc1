"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import (
    centroids,
    language_id,
    language_model,
    licences,
    mixing,
    near_duplicates,
    neighbours,
    packing,
    quality_rules,
    sharding,
    sql,
    suffixes,
    vocabulary,
    warc,
)
from tidewatch.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op7_mix_sources": sql.OP7,
    "op8_rendezvous_shards": sql.OP8,
    "op9_quality_rules": sql.OP9,
    "op10_warc": sql.OP10,
    "op11_centroid_clusters": sql.OP11,
    "op12_source_divergence": sql.OP12,
    "op13_suffix_repeats": sql.OP13,
}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents under a model of those not held out."""
    return language_model.score_documents(table(spark, sf_dir, "documents"))


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2,048 words, near copies apart."""
    return packing.pack_apart(table(spark, sf_dir, "documents"))


@query
def op3_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every twentieth one."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op4_licence_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of all documents."""
    return licences.scan(table(spark, sf_dir, "documents"))


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return language_id.identify(table(spark, sf_dir, "documents"))


@query
def op6_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates of every document."""
    c = near_duplicates.classes(table(spark, sf_dir, "documents"))
    return c.select("doc_id", "class_id", "kept", "class_texts")


@query
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    d = mixing.mix(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 24)


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals and verdict of every document."""
    return quality_rules.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, written and read back through the index."""
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url", "payload")


@query
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every usable vector."""
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language, and the words they use most."""
    return vocabulary.audit(table(spark, sf_dir, "documents"))


@query
def op13_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes that repeat earlier ones."""
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline from raw documents to packed sequences."""
    return corpus_pipeline.run(spark, sf_dir)

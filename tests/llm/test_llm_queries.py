"""Registered queries against their SQL, and their contracts' columns."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tools"))

from compare import compare, duck  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tidewatch.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_deleted_interpolation": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op3_projection_forest": "query_id rank vec_id score",
    "op5_language_id": "doc_id held_out lang_pred score",
    "op6_dart_minhash": "doc_id class_id kept class_texts",
    "op7_mix_sources": "doc_id size source_size target taken",
    "op8_rendezvous_shards": "doc_id size text_crc32 law shard slot grown_shard",
    "op9_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op10_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op11_centroid_clusters": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
    "op12_source_divergence": "lang source part item value rank",
    "op13_suffix_repeats": "doc_id n_bytes n_removed n_spans kept_sha256",
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    ok, found = compare(spark, duck(SF), name, QUERIES[name], ORACLES[name], SF)
    assert ok, found


@pytest.mark.parametrize("name", sorted(set(COLUMNS) - set(ORACLES)))
def test_columns(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns == COLUMNS[name].split() and df.count() > 0


def test_all_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {*(f"op{k}" for k in range(1, 14)), "pipeline"}
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())

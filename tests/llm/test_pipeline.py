from collections import Counter

import corpus_pipeline as P
from tidewatch.llm import mixing, near_duplicates, packing, quality_rules
from tidewatch.llm.common import stage

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [n for n, _ in P.STAGES] == ["language ID", "quality rules", "near duplicates", "source mix", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for _, step in P.STAGES:
        seen.append(stage(step(spark, seen[-1], SF), "test"))
    assert all(d.columns == columns for d in seen[:5])
    rows = [Counter(tuple(r) for r in d.collect()) for d in seen]
    for before, after in zip(rows[:4], rows[1:4]):
        assert after <= before and after
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert sum(rows[2].values()) == quality_rules.assess(seen[1], labels).where("kept").count()
    assert sum(rows[3].values()) == near_duplicates.classes(seen[2]).where("kept").count()
    taken = Counter({r["doc_id"]: r["copies"] for r in mixing.mix(seen[3]).collect()})
    assert Counter(r[0] for r in rows[4].elements()) == +taken
    words = lambda d: sum(r["n_words"] for r in d.collect())
    assert words(seen[5]) == words(packing.pack(seen[4]))


def test_ugly(spark, ugly, tmp_path):
    sf = str(tmp_path)
    ugly.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    rows = P.run(spark, sf).collect()
    assert {r["doc_id"] for r in rows} - {None} <= {r["doc_id"] for r in ugly.collect()} and rows


def test_empty(spark, empty, tmp_path):
    sf = str(tmp_path)
    empty.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    assert P.run(spark, sf).collect() == []

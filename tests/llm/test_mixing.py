import re
from collections import Counter, defaultdict

import pytest
from tidewatch.llm.mixing import mix, mixed_documents


def plain_targets(sizes, weights=(1, 2, 3), cap=3):
    """Targets by sharing and sharing again."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, target = float(sum(sizes.values())), set(order), {}
    while free:
        share = left / sum(w[s] for s in free)
        over = {s for s in free if share * w[s] >= cap * sizes[s]}
        if not over:
            target |= {s: share * w[s] for s in free}
            break
        for s in over:
            target[s] = float(cap * sizes[s])
            left -= target[s]
        free -= over
    return target


def check(rows, docs):
    """Each source within half of its smallest free document of its target, or with none left that it could still take."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = Counter((r["doc_id"], r["source"], size(r["text"])) for r in docs)
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in rows) == want
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
    target = plain_targets(dict(sizes))
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
    for s in sizes:
        most = {}
        for r in rows:
            if r["source"] == s and r["size"]:
                level = r["size"].bit_length()
                most[level] = max(most.get(level, 0), r["copies"])
        free = [r["size"] for r in rows if r["source"] == s and r["size"] and r["copies"] < min(3, most[r["size"].bit_length()])]
        if taken[s] > target[s]:  # the document that closed the gap was the smallest free one before
            free = [max(r["size"] for r in rows if r["source"] == s and r["copies"] and r["size"] <= min(free, default=r["size"]))]
        assert abs(taken[s] - target[s]) <= max(1, min(free, default=0) / 2, 0.01 * target[s]), (s, taken[s], target[s], free)


def test_ugly(ugly):
    rows = mix(ugly).collect()
    check(rows, ugly.collect())
    key = lambda r: str((r["doc_id"], r["size"], r["taken"]))
    assert sorted(map(key, rows)) == sorted(map(key, mix(ugly.repartition(5)).collect()))


def test_real(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check(mix(docs).collect(), docs.collect())


def test_documents_are_repeated(spark, ugly):
    full = Counter(tuple(r) for r in mixed_documents(ugly).collect())
    want = Counter()
    for r in mix(ugly).collect():
        want[r["doc_id"], r["source"]] += r["copies"]
    assert Counter((r[0], r[3]) for r in full.elements()) == +want
    assert set(full) <= {tuple(r) for r in ugly.collect()}


def test_longer_texts_are_likelier(spark):
    rows = [(i, "w " * (10 if i % 2 else 200), f"s{i % 3}") for i in range(6_000)]
    got = mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).where("source = 's0'").collect()
    share = lambda n: sum(r["copies"] for r in got if r["size"] == n) / sum(r["size"] == n for r in got)
    assert 1.3 < share(200) / share(10) < 3


def test_empty(empty):
    assert mix(empty).collect() == [] and mixed_documents(empty).collect() == []

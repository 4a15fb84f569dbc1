import numpy as np
from pyspark.sql import functions as F
from tidewatch.llm.neighbours import LEAVES, Forest, lengthened, nearest


def plain(rows, k=20, every=20):
    good = {}
    for i, v in rows:
        if i is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good.setdefault((i, tuple(v)), None)
    sizes = [len(v) for _, v in good]
    d = max(set(sizes), key=lambda s: (sizes.count(s), -s)) if sizes else 0
    good = [(i, np.array(v, np.float64)) for i, v in good if len(v) == d]
    out = {}
    for q, x in good:
        if q % every == 0:
            best = sorted(((-float(np.cumsum(x * y)[-1]), i) for i, y in good if i != q))[:k]
            out[q] = [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return out


def compare(vectors):
    want = plain([(r["vec_id"], r["embedding"]) for r in vectors.collect()])
    got = {}
    for r in nearest(vectors, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append(tuple(r)[:4])
    return {q: sorted(x, key=lambda r: r[1]) for q, x in got.items()}, {q: x for q, x in want.items() if x}


def test_ties_copies_and_bad_vectors(spark):
    r = np.random.default_rng(1)
    rows = [(i, r.normal(size=6).astype(np.float32).tolist()) for i in range(120)]
    rows += [(i, rows[3][1]) for i in range(200, 280)] + [(200, rows[3][1])]
    rows += [(300, None), (320, []), (340, [0.0] * 6), (360, [1.0, None] + [0.0] * 4), (380, [float("nan")] * 6)]
    rows += [(400, [float("inf")] + [0.0] * 5), (None, rows[0][1]), (420, [1.0, 2.0]), (440, (np.array(rows[5][1]) * 100).tolist())]
    vectors = spark.createDataFrame([(*x, "n") for x in rows], "vec_id bigint, embedding array<float>, entry string")
    got, want = compare(vectors)
    assert got == want


def test_few(spark):
    one = spark.createDataFrame([(20, [1.0, 0.0])], "vec_id bigint, embedding array<float>")
    assert nearest(one, F.col("vec_id") % 20 == 0).collect() == []
    two = spark.createDataFrame([(20, [1.0, 0.0]), (1, [0.5, 0.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in nearest(two, F.col("vec_id") % 20 == 0).collect()] == [(20, 1, 1, 0.5)]
    assert nearest(two.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got, want = compare(vectors)
    assert got.keys() == want.keys()
    found = [len({x[2] for x in got[q]} & {x[2] for x in want[q]}) / 20 for q in want]
    assert np.mean(found) >= 0.9
    few = {}
    for r in nearest(vectors, F.col("vec_id") % 20 == 0, leaf_rows=64, leaves=80).collect():
        few.setdefault(r["query_id"], []).append(r["vec_id"])
    found = [len(set(few[q]) & {x[2] for x in want[q]}) / 20 for q in want]
    assert np.mean(found) >= 0.7  # leaves of a thirtieth of such data, which have no structure


def test_share_of_full_and_half_full_leaves():
    r = np.random.default_rng(5)
    x = r.normal(size=(10_000, 64))
    x = lengthened(x / np.linalg.norm(x, axis=1, keepdims=True), 1.0)
    for rows in (8_190, 8_210):  # leaves of 64 and of 32
        forest = Forest(x[:rows], leaf_rows=64)
        sizes, at, q = np.bincount(forest.place(x[:rows]).ravel()), forest.place(x), x[:100]
        recall = []
        for i, seen in enumerate(forest.search(q, LEAVES)):
            assert sizes[seen].sum() >= 0.85 * rows
            hit = np.zeros(forest.leaves, bool)
            hit[seen] = True
            scores = x[:, :64] @ q[i, :64]
            scores[i] = -1
            recall.append(hit[at[np.argsort(-scores)[:20]]].any(1).mean())
        assert np.mean(recall) >= 0.94


def test_many_ties_and_doubles(spark):
    """More distinct vectors of one score than a query asks for, and numbers that a float can't hold."""
    r = np.random.default_rng(5)
    rows = [(0, [1.0] + [0.0] * 7), (20, [0.1] * 8)]
    rows += [(int(i), [0.5, *r.normal(size=7).tolist()]) for i in r.permutation(np.arange(1, 400)) if i % 20]
    rows += [(1_000 + i, [0.25 + i * 1e-12] + [0.0] * 7) for i in range(30)]
    for kind in ("double", "float"):
        vectors = spark.createDataFrame([(i, [float(np.float32(x)) for x in v] if kind == "float" else v) for i, v in rows],
                                        f"vec_id bigint, embedding array<{kind}>").repartition(4)
        got, want = compare(vectors)
        assert got == want

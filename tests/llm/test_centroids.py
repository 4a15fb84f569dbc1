import hashlib
import math
import random

from tidewatch.llm.centroids import cluster_vectors

SCHEMA = "vec_id bigint, embedding array<double>, cluster string, v string, distance string, at string"


def plain(rows, dimensions, k, rounds):
    """(vec_id, cluster, distance, cluster inertia, inertia, centroid hash) of every usable row."""
    kept = [
        (i, [math.floor(256 * x) for x in e])
        for i, e, *_ in rows
        if e is not None and len(e) == dimensions and all(x is not None and math.isfinite(x) and abs(x) < 1 << 20 for x in e)
    ]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    start = sorted(kept, key=lambda r: (sha(f"2:{'' if r[0] is None else r[0]}"), r[1]))
    centroids = [v for _, v in start[:k]]

    def place():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        at = place()
        for n in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(kept, at, strict=True) if c == n]
            if mine:
                centroids[n] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    at = place()
    of = lambda n: sum(d for d, c in at if c == n)
    return [
        (i, c, d, of(c), sum(x for x, _ in at), sha(",".join(map(str, centroids[c]))))
        for (i, _), (d, c) in zip(kept, at, strict=True)
    ]


def check(spark, rows, dimensions, k, rounds):
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(str, map(tuple, cluster_vectors(df, dimensions, k, rounds).collect())))
    assert got == sorted(map(str, plain(rows, dimensions, k, rounds)))
    return got


def test_random_vectors(spark):
    r = random.Random(4)
    rows = [(i, [r.gauss(i % 5, 0.8) for _ in range(6)], *"abcd") for i in range(300)]
    check(spark, rows, 6, 7, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [1.0], [1.0, None, 2.0], [nan, 0.0, 0.0], [0.0, inf, 0.0], [0.0, -inf, 0.0], [1e300, 0.0, 0.0], [1.0] * 4]
    good = [[0.1, -0.1, 0.0], [0.1, -0.1, 0.0], [-0.001, 0.001, 0.5], [3.0, 3.0, 3.0], [1e5, -1e5, 0.0]]
    rows = [(i, e, *"abcd") for i, e in enumerate(odd + good)]
    rows += [(None, [0.5, 0.5, 0.5], *"abcd"), (None, [0.7, 0.5, 0.5], *"abcd"), (12, [9.0, 9.0, 9.0], *"abcd")]
    rows += [(77, [0.5, 0.5, 0.5], *"abcd")] * 3  # repeated rows, and centroids that start equal
    assert len(check(spark, rows, 3, 40, 5)) == len(good) + 6
    check(spark, rows, 3, 3, 2)


def test_ties_go_to_the_smaller_number(spark):
    check(spark, [(i, [float(x)], *"abcd") for i, x in enumerate([0, 2, 4, 1, 3, 1, 3])], 1, 3, 1)


def test_empty(spark):
    df = cluster_vectors(spark.createDataFrame([], SCHEMA))
    assert df.collect() == []
    assert df.dtypes == cluster_vectors(spark.createDataFrame([(1, [0.5] * 64, *"abcd")], SCHEMA)).dtypes


def test_no_python_in_tasks(spark):
    df = cluster_vectors(spark.createDataFrame([(i, [i / 9] * 64, *"abcd") for i in range(50)], SCHEMA))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

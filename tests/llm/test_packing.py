import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F
from tidewatch.llm.packing import best_fit, conflict_bits, pack, pack_apart
from tidewatch.llm.queries import QUERIES


def plain(sizes, keys, limits, capacity):
    """Best fit by looking at every bin."""
    bins = []
    for i in sorted((i for i in range(len(sizes)) if sizes[i]), key=lambda i: -sizes[i]):
        fits = []
        for b, members in enumerate(bins):
            left = capacity - sum(sizes[m] for m in members)
            clash = any(
                k[i] is not None and sum(k[m] == k[i] for m in members) >= limit for k, limit in zip(keys, limits, strict=True)
            )
            if left >= sizes[i] and not clash:
                fits.append((left, b))
        if fits:
            bins[min(fits)[1]].append(i)
        else:
            bins.append([i])
    return bins


def test_tightest_compatible_bin():
    for seed in range(20):
        r = random.Random(seed)
        n = 150
        sizes = [r.choice([0, r.randint(1, 100)]) for _ in range(n)]
        keys = [[r.choice(["hot", "hot", "a", "b", None]) for _ in range(n)], [r.choice([*range(60), None]) for _ in range(n)]]
        for limits in ([1, 1], [3, 1]):
            assert best_fit(sizes, conflict_bits(keys, limits), 100) == plain(sizes, keys, limits, 100)


def test_whole_documents(ugly):
    rows = pack(ugly, 100, block_rows=16).collect()
    want = Counter()
    for r in ugly.select("doc_id", "text").collect():
        want[r["doc_id"], len((r["text"] or "").replace("\x00", "x").split()) and len([w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", r["text"])])] += 1
    got, bins = Counter(), defaultdict(list)
    pieces = defaultdict(int)
    for r in rows:
        if r["bin_id"] is None:
            assert r["n_words"] == 0
        else:
            bins[r["bin_id"]].append(r)
        pieces[r["doc_id"]] += r["n_words"]
    totals = Counter()
    for (i, n), c in want.items():
        totals[i] += n * c
    assert dict(pieces) == dict(totals)
    for members in bins.values():
        assert sum(m["n_words"] for m in members) == members[0]["bin_words"] <= 100
        assert sorted(m["position"] for m in members) == list(range(len(members)))
        assert all(m["start"] == m["piece"] * 100 for m in members)


def test_copies_never_meet(spark):
    docs = spark.createDataFrame([(i, "a b c" if i % 2 else f"x{i} y", f"s{i % 5}") for i in range(300)], "doc_id bigint, text string, source string")
    rows = pack(docs.coalesce(1), 50).where("doc_id % 2 = 1").groupBy("bin_id").count()
    assert rows.agg(F.max("count")).first()[0] == 1


def test_near_copies_never_meet(spark, tmp_path):
    base = [f"w{j}" for j in range(100)]
    rows = []
    for i in range(240):
        near = i % 3 == 0
        words = [*base[: i % 100], f"other{i}", *base[i % 100 + 1 :]] if near else [f"x{i}y{j}" for j in range(30)]
        rows.append((None if i % 9 == 0 else i, " ".join(words), None, f"s{i}", 0))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    packed = QUERIES["op2_best_fit_packing"](spark, str(tmp_path)).collect()
    near = Counter(r["bin_id"] for r in packed if r["n_words"] == 100)
    assert len(packed) == 240 and sum(near.values()) == 80 and max(near.values()) == 1


def test_empty(empty):
    assert pack(empty).collect() == []
    assert pack_apart(empty).collect() == []


def test_bins_of_blocks_never_share_a_number(spark, monkeypatch):
    """However many bins a block has, the next block's numbers begin behind them."""
    from pyspark.sql import functions as F
    from tidewatch.llm import packing

    docs = spark.range(0, 300, 1, 1).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"))
    size = (F.col("doc_id") % 7 + 1) * 10_000_000
    got = packing.pack(docs, size=size, cluster=F.col("doc_id"), block_rows=50)
    full = got.groupBy("bin_id").agg(F.sum("n_words").alias("n"), F.max("bin_words").alias("m"))
    assert full.where("n > 2048 or n <> m").count() == 0
    assert got.agg(F.sum("n_words")).first()[0] == sum((i % 7 + 1) * 10_000_000 for i in range(300))

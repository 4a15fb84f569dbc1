import hashlib
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F
from tidewatch.llm.sharding import shard_documents, shard_of


def plain(key, n):
    return max(range(n), key=lambda i: (int(hashlib.md5(f"shard/{i}/{key}".encode()).hexdigest()[:13], 16), -i))


def test_against_plain_hashing(ugly):
    got = shard_documents(ugly, 24).collect()
    want = Counter()
    for r in ugly.select("doc_id", "text").collect():
        b, key = (r["text"] or "").encode(), "" if r["doc_id"] is None else str(r["doc_id"])
        want[r["doc_id"], len(b) + 8, zlib.crc32(b), plain(key, 24), plain(key, 25)] += 1
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 24)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_weights_and_growth(spark):
    keys = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    w = [1.0, 2.0, 0.0, 5.0]
    rows = keys.select(shard_of(F.col("k"), w).alias("a"), shard_of(F.col("k"), [*w, 2.0]).alias("b")).collect()
    n = Counter(r["a"] for r in rows)
    assert n[2] == 0 and all(abs(n[i] / 20_000 - w[i] / 8) < 0.02 for i in (0, 1, 3))
    moved = [r for r in rows if r["a"] != r["b"]]
    assert all(r["b"] == 4 for r in moved) and abs(len(moved) / 20_000 - 0.2) < 0.02


def test_empty(empty):
    assert shard_documents(empty).collect() == []

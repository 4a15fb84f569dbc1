import base64
import gzip
import hashlib
import os
import re

from pyspark.sql import functions as F
from tidewatch.llm import warc
from tidewatch.session import scratch


def plain(rows, least=0):
    """Expected (page_id, bytes, digest, type, refers_to) of every row."""
    by = {}
    for i, url, html in rows:
        by.setdefault((html or "").encode(), []).append((i is None, i or 0, url is not None, url or "", i))
    out = []
    for body, members in by.items():
        members.sort(key=lambda m: m[:4])
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        for k, m in enumerate(members):
            again = k and len(body) >= least
            out.append((m[4], len(body), digest, "revisit" if again else "response", members[0][4] if again else None))
    return sorted(out, key=str)


def result(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()), key=str)


ROWS = [
    (5, "http://a.example.org/x", "same"),
    (3, "http://b.example.org/y?q=1#f", "same"),
    (9, "http://a.example.org/x", "same"),
    (9, "http://a.example.org/x", "same"),
    (None, "http://c.example.org:8080/", "same"),
    (None, None, None),
    (1, "http://u:p@A.Example.org", ""),
    (2, "not a url \n\x00", "ünï 漢字"),
    (4, "http://a.example.org/x", "x" * 3_000_000),
    (-7, "https://z.example.org/é", "\r\n\r\nWARC/1.1\r\n"),
    *[(100 + k, f"http://h{k % 7}.example.net/{k}", f"page {k % 90}") for k in range(250)],
]


def test_round_trip(spark):
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id bigint, url string, html string, key string")
    assert result(warc.round_trip(pages)) == plain(ROWS)
    assert result(warc.round_trip(pages, 5)) == plain(ROWS, 5)
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_payloads_come_back(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r["payload"] for r in warc.round_trip(pages).where("record_type = 'response'").collect()}
    assert got == {r["page_id"]: r["html"].encode() for r in pages.collect()}


def test_archives_are_plain_warc(spark):
    pages = spark.createDataFrame(ROWS[:9], "page_id bigint, url string, html string")
    root = scratch(spark, "warc-test")
    warc.write_archives(pages, root)
    records = b"".join(gzip.open(os.path.join(root, f)).read() for f in sorted(os.listdir(root)) if f.endswith(".warc.gz"))
    n = 0
    while records:
        head, _, rest = records.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: re")
        size = int(re.search(rb"\nContent-Length: (\d+)", head)[1])
        assert rest[size : size + 4] == b"\r\n\r\n"
        records = rest[size + 4 :]
        n += 1
    assert n == 9


def test_lookup_of_single_keys(spark):
    rows = [(k, f"http://site{k % 50}.example.org/p{k // 50}", f"body {k}") for k in range(3_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(5)
    root = scratch(spark, "warc-test")
    ranges = warc.write_archives(pages, root, block_lines=16)
    wanted = [r for r in rows if r[0] % 97 == 0]
    keys = spark.createDataFrame(wanted, "page_id bigint, url string, html string")
    keys = keys.unionByName(spark.createDataFrame([(0, "http://nowhere.org/", ""), (99_999, "http://site1.example.org/p0", "")], keys.schema))
    keys = keys.select(warc.url_key(F.col("url")).alias("key"), "page_id")
    got = {r["page_id"]: r["payload"].decode() for r in warc.lookup(keys, root, ranges).collect()}
    assert got == {r[0]: r[2] for r in wanted}


def test_url_keys(spark):
    urls = ["http://A.b.Org/x?y#z", "https://u:p@b.org:81/", "b.org", None, "http://h/"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(warc.url_key(F.col("u"))).collect()]
    assert got == ["org,b,a)/x?y", "org,b):81/", "org,b)", ")", "h)/"]

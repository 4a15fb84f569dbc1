"""WARC archives with a two-level capture index.

Every task writes its pages to archives, one gzip member per record, and says
where each record lies. These captures, sorted by reversed-host URL key, make
the index: each range of keys is a file of compressed blocks of capture
lines, with a sparse directory of the blocks' first keys at its end. A lookup
finds the range, then the block, by binary search, reads that block's byte
range, searches it, and reads the byte range of the record.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stage, whole
from tidewatch.session import scratch

BLOCK_LINES = 1_000
ARCHIVE_BYTES = 1 << 30
LEVEL = 1
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string,"
    " refers_to bigint, payload binary"
)


def url_key(url: Column) -> Column:
    """Reversed host, ")" and the rest without fragment: http://a.b.org/x?y#z becomes org,b,a)/x?y."""
    scheme = r"^[A-Za-z][A-Za-z0-9+.\-]*://"
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), "#[^#]*$", ""), scheme + r"([^/?#@]*@)?", "")
    host = F.lower(F.regexp_extract(bare, r"^[^/?:]*", 0))
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_replace(bare, r"^[^/?:]*", ""))


def storage(root: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder: a local path, or any URI pyarrow knows."""
    if re.match(r"file:/", root):
        return pafs.LocalFileSystem(), "/" + root[5:].lstrip("/")
    return pafs.FileSystem.from_uri(root) if "://" in root else (pafs.LocalFileSystem(), root)


def place(key: str, page_id: int | None) -> tuple[str, str]:
    """What captures are ordered by; null ids first."""
    return key, "" if page_id is None else f"{page_id + (1 << 63):020d}"


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    return str(uuid.UUID(bytes=hashlib.md5(json.dumps([page_id, url, digest]).encode()).digest()))


def clean(value: str) -> str:
    """A header value: blanks and control characters percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) <= 32 or ord(c) == 127 else c for c in value)


def record(page_id, url, payload: bytes, digest: str, first: tuple | None) -> bytes:
    """One WARC record; ``first`` is (page_id, url) of the response a revisit refers to."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if first else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{record_id(page_id, url, digest)}>"
        if not first
        else f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {clean(url or '')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
        f"Page-ID: {'' if page_id is None else page_id}",
    ]
    if first:
        head += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: <urn:uuid:{record_id(*first, digest)}>",
            f"WARC-Refers-To-Target-URI: {clean(first[1] or '')}",
            f"Refers-To-Page-ID: {'' if first[0] is None else first[0]}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    c = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def parsed(data: bytes) -> dict:
    """Fields of a record read back; a response's payload is checked against its length and digest."""
    head, _, block = data.partition(b"\r\n\r\n")
    h = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(h["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = h["WARC-Type"]
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"damaged record of {h['WARC-Target-URI']}")
    number = lambda x: int(x) if x else None
    return {
        "page_id": number(h["Page-ID"]),
        "url": h["WARC-Target-URI"],
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number(h.get("Refers-To-Page-ID")),
        "payload": payload if kind == "response" else None,
    }


class ArchiveWriter:
    """Archives of one task; :meth:`add` returns where a record lies."""

    def __init__(self, root: str):
        self.fs, self.path = storage(root)
        self.fs.create_dir(self.path, recursive=True)
        self.out, self.name, self.at = None, "", 0

    def add(self, data: bytes) -> tuple[str, int, int]:
        if self.out is None or self.at >= ARCHIVE_BYTES:
            self.close()
            self.name, self.at = f"{uuid.uuid4().hex}.warc.gz", 0
            self.out = self.fs.open_output_stream(f"{self.path}/{self.name}", compression=None)
        z = member(data)
        self.out.write(z)
        self.at += len(z)
        return self.name, self.at - len(z), len(z)

    def close(self) -> None:
        if self.out:
            self.out.close()
            self.out = None


class IndexWriter:
    """Index file of one sorted range."""

    def __init__(self, root: str, block_lines: int):
        self.fs, self.path = storage(root)
        self.name, self.block_lines = f"{uuid.uuid4().hex}.cdx", block_lines
        self.out = self.fs.open_output_stream(f"{self.path}/{self.name}")
        self.at, self.lines, self.directory = 0, [], []

    def add(self, line: list) -> None:
        self.lines.append(line)
        if len(self.lines) == self.block_lines:
            self.flush()

    def flush(self) -> None:
        if self.lines:
            z = member("\n".join(map(json.dumps, self.lines)).encode())
            self.out.write(z)
            self.directory.append([*self.lines[0][:2], self.at, len(z)])
            self.at += len(z)
            self.lines = []

    def close(self) -> tuple:
        """(first key, first place of the id, index file, offset of its directory, its length)."""
        self.flush()
        z = member("\n".join(map(json.dumps, self.directory)).encode())
        self.out.write(z)
        self.out.close()
        return *self.directory[0][:2], self.name, self.at, len(z)


class Reader:
    """Lookups in the ranges of one folder; keeps the last directory, block and file at hand."""

    def __init__(self, root: str, ranges: list[tuple]):
        self.fs, self.path = storage(root)
        self.ranges = ranges  # (first key, first id, index file, directory offset, length), ascending
        self.firsts = [tuple(r[:2]) for r in ranges]
        self.kept: dict = {}
        self.file = (None, None)

    def read(self, name: str, offset: int, length: int) -> bytes:
        if self.file[0] != name:
            if self.file[1]:
                self.file[1].close()
            self.file = (name, self.fs.open_input_file(f"{self.path}/{name}"))
        return zlib.decompress(self.file[1].read_at(length, offset), 31)

    def lines(self, kind: str, name: str, offset: int, length: int) -> tuple[list, list]:
        if self.kept.get(kind, (None,))[0] != (name, offset):
            rows = [json.loads(x) for x in self.read(name, offset, length).decode().split("\n")]
            self.kept[kind] = ((name, offset), [tuple(r[:2]) for r in rows], rows)
        return self.kept[kind][1:]

    def find(self, key: str, page_id) -> Iterator[bytes]:
        """All records of a key and id."""
        wanted = place(key, page_id)
        for r in range(max(0, bisect_left(self.firsts, wanted) - 1), len(self.ranges)):
            if self.firsts[r] > wanted:
                return
            name = self.ranges[r][2]
            firsts, blocks = self.lines("directory", *self.ranges[r][2:])
            for b in range(max(0, bisect_left(firsts, wanted) - 1), len(blocks)):
                if firsts[b] > wanted:
                    return
                places, captures = self.lines("block", name, *blocks[b][2:])
                for c in range(bisect_left(places, wanted), len(captures)):
                    if places[c] != wanted:
                        return
                    yield self.read(*captures[c][2:])


def write_archives(pages: DataFrame, root: str, min_bytes: int = 0, block_lines: int = BLOCK_LINES) -> list[tuple]:
    """Write a record per row of ``pages`` (page_id, url, html) below ``root``; returns the ranges for :func:`lookup`.

    Of rows with equal payloads of at least ``min_bytes`` bytes, the one with
    the smallest page_id (null last; then the smallest url) is a response,
    the others revisit it; of fully equal rows one is. Null html is an empty
    payload, a null url an empty key. Files have names of their own for each
    attempt, and only those of the attempt that counts are listed, so a
    repeated task does no harm. The payloads are shuffled once. What reaches
    the driver is one row per range of the index.
    """
    payload = whole("html").cast("binary")
    base = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("sha1"),
        url_key(F.col("url")).alias("key"),
        F.monotonically_increasing_id().alias("uid"),
    )
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url", "uid")
    shared = base.where(F.octet_length("payload") >= min_bytes).groupBy(F.col("sha1").alias("sha1_"))
    shared = shared.agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    rows = base.join(shared.select("sha1_", "first"), F.col("sha1") == F.col("sha1_"), "left").select(
        "page_id",
        "url",
        "payload",
        "sha1",
        "key",
        F.col("first.page_id").alias("first_id"),
        F.col("first.url").alias("first_url"),
        F.coalesce(F.col("uid") != F.col("first.uid"), F.lit(False)).alias("again"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = ArchiveWriter(root)
        for batch in batches:
            places = []
            for r in batch.drop_columns(["key"]).to_pylist():
                digest = base64.b32encode(bytes.fromhex(r["sha1"])).decode()
                first = (r["first_id"], r["first_url"]) if r["again"] else None
                places.append(out.add(record(r["page_id"], r["url"], r["payload"], digest, first)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["key"],
                    pa.array([place("", i)[1] for i in batch["page_id"].to_pylist()], pa.string()),
                    *[pa.array([p[k] for p in places], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
                ],
                names=["key", "id", "archive", "at", "length"],
            )
        out.close()

    captures = stage(rows.mapInArrow(write, "key string, id string, archive string, at bigint, length bigint"), "captures")
    captures = captures.repartitionByRange("key", "id", "archive", "at").sortWithinPartitions("key", "id", "archive", "at")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out = out or IndexWriter(root, block_lines)
                out.add(list(line))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in out.close()], names=["key", "id", "name", "at", "length"]
            )

    found = stage(captures.mapInArrow(index, "key string, id string, name string, at bigint, length bigint"), "ranges")
    return sorted(tuple(r) for r in found.collect())


def lookup(captures: DataFrame, root: str, ranges: list[tuple]) -> DataFrame:
    """The records of ``captures`` (key, page_id), each distinct one looked up once, in key order."""
    # by number: sizes of keys say nothing about the records that are read for them
    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = captures.repartitionByRange(n, "key", "page_id").sortWithinPartitions("key", "page_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, last = Reader(root, ranges), None
        schema = pa.schema(
            [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
             ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
        )
        for batch in batches:
            rows, size = [], 0
            for key, page_id in zip(batch["key"].to_pylist(), batch["page_id"].to_pylist(), strict=True):
                if (key, page_id) != last:
                    last = (key, page_id)
                    for data in reader.find(key, page_id):
                        rows.append(parsed(data))
                        size += len(data)
                        if size > 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema)

    return keys.mapInArrow(run, READ)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages, then read every capture back through the index: one row per record."""
    root = scratch(pages.sparkSession, "warc")
    ranges = write_archives(pages, root, min_bytes)
    captures = pages.select(url_key(F.col("url")).alias("key"), F.col("page_id").cast("bigint").alias("page_id"))
    return lookup(captures, root, ranges)

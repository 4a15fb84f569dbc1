import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from tidewatch.llm import suffixes
from tidewatch.llm.suffixes import remove_repeats


def words(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice(("th", "er", "on", "an", "ré")) for _ in range(r.randint(1, 4))) for _ in range(n))



def plain(rows, width):
    """As the operator, by a table of all windows."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    rank = lambda i: float("inf") if i is None else i
    for i, t in texts:
        for p in range(len(t) - width + 1):
            w = t[p : p + width]
            first[w] = min(first.get(w, float("inf")), rank(i))
    out = []
    for i, t in texts:
        gone = bytearray(len(t) + 1)
        for p in range(len(t) - width + 1):
            if first[t[p : p + width]] < rank(i):
                gone[p : p + width] = b"\1" * width
        rest = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        spans = sum(1 for k in range(len(t)) if gone[k] and not gone[k - 1])
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(rest).hexdigest(), rest))
    return out


def check(df, width=50, seed=16):
    got = [(*r[:5], bytes(r[5])) for r in remove_repeats(df, width, seed, keep_text=True).collect()]
    want = plain([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()], width)
    assert sorted(map(str, got)) == sorted(map(str, want))
    return got


@pytest.fixture
def short_runs(monkeypatch):
    monkeypatch.setattr(suffixes, "HELD_BYTES", 3_000)
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 700)


def test_ugly(spark, ugly):
    more = [(200, None), (300, "a" * 5_000), (301, "ab" * 900), (302, "a" * 49), (303, "a" * 50)]
    more += [(None, words(90, 3))] * 40 + [(None, words(91, 3)), (7, words(80, 3)), (-5, words(60, 3) + "\x00\x00" + words(50, 4))]
    df = ugly.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id bigint, text string"))
    assert sum(r[2] > 0 for r in check(df.repartition(5))) > 10
    assert remove_repeats(ugly).columns == "doc_id n_bytes n_removed n_spans kept_sha256".split()


@pytest.mark.parametrize("seed", range(4))
def test_small_alphabets(spark, short_runs, seed):
    r = random.Random(seed)
    passages = ["".join(r.choice("ab\x00é") for _ in range(r.randint(5, 60))) for _ in range(20)]
    texts = ["".join(r.choice(passages)[r.randint(0, 4) :] for _ in range(r.randint(0, 12))) for _ in range(150)]
    rows = [(r.choice([k, k, k, None, 3]), t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    check(df, 12, 4)
    check(df, 9, 9)


def test_shared_passages_and_copies(spark, short_runs):
    r = random.Random(9)
    passage = words(30, 1)
    texts = [words(40, k) + " " + passage + " " + words(20, 1_000 + k) for k in range(60)]
    for k in range(0, 60, 2):
        w = texts[k].split()
        w[r.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += [texts[5]] * 50 + [texts[7][3:]] * 3
    rows = list(enumerate(texts))
    r.shuffle(rows)
    got = check(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    assert sum(r[2] for r in got) > 0.5 * sum(r[1] for r in got if r[0] >= 60)


def test_real(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"))


def test_merge_keeps_known_prefixes():
    """Suffixes of several runs come out sorted, each with the length it shares with the one before."""
    r = random.Random(2)
    runs = []
    for k in range(5):
        texts = ["".join(r.choice("ab") for _ in range(80)).encode() for _ in range(6)]
        batch = pa.RecordBatch.from_arrays([pa.array(range(6 * k, 6 * k + 6)), pa.array(texts, pa.binary())], names=["doc_id", "text"])
        rows = [(x["m"], x["body"]) for part in suffixes.text_writer(1)(iter([batch])) for x in part.to_pylist()]
        home = suffixes.Home(rows, 16, 5, 1)
        runs += [suffixes.Run(n, m, body) for _, n, m, body in suffixes.runs_of(home, 1, 16)]
    out = [(runs[w].now, lcp) for w, lcp in suffixes.merged(runs)]
    assert [x for x, _ in out] == sorted(x for x, _ in out) and len(out) > 100
    for (x, _), (y, lcp) in zip(out, out[1:], strict=False):
        assert lcp == suffixes.common_prefix(x, y, 0)


def test_windows_choose_by_content():
    data = np.frombuffer(words(400, 3).encode(), np.uint8)
    both = np.concatenate([data, data[::-1], data])
    place, lo, hi, _ = suffixes.chosen(both, np.zeros(len(both), np.int64), 50, 16)
    offsets = {}
    for p, a, b in zip(place, lo, hi, strict=True):
        for i in range(a, b + 1):
            w = both[p - i : p - i + 50].tobytes()
            assert offsets.setdefault(w, i) == i
    assert sum(hi - lo + 1) == len(both) - 49


def test_empty(empty):
    assert remove_repeats(empty).collect() == []

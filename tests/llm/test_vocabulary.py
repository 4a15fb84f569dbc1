import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from tidewatch.llm import vocabulary
from tidewatch.llm.vocabulary import Transducer, audit, shares


def plain(rows, least, top):
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    docs = [(la or "", so or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(t or ""))) for t, la, so in rows]
    df = defaultdict(Counter)
    for la, _, terms in docs:
        df[la].update(set(terms))
    kept = {la: sorted((t for t, n in c.items() if n >= least), key=str.encode) for la, c in df.items()}
    count = defaultdict(Counter)
    for la, so, terms in docs:
        count[la, so].update(t for t in terms if t in set(kept[la]))
    out = []
    for la, so in count:
        terms, v = kept[la], len(kept[la])
        p = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * v) for t in terms}  # noqa: E731, B023
        mine, whole = p(count[la, so]), p(sum((c for (x, _), c in count.items() if x == la), Counter()))
        pairs = [(sum(abs(mine[t] - q[t]) for t in terms), s) for (x, s), c in count.items() if x == la and s != so for q in [p(c)]]
        over = [(mine[t] - whole[t], t) for t in terms if count[la, so][t] and mine[t] > whole[t]]
        for part, found in (("pair", pairs), ("term", over)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(la, so, part, item, value, r + 1) for r, (value, item) in enumerate(found) if part == "pair" or r < top]
    return out


def check(df, least, top=50):
    got = sorted(map(tuple, audit(df, least, top).collect()))
    want = sorted(plain([(r["text"], r["lang"], r["source"]) for r in df.select("text", "lang", "source").collect()], least, top))
    assert got == want
    return got


@pytest.mark.parametrize("seed", range(3))
def test_transducer(seed):
    r = random.Random(seed)
    terms = sorted({"".join(r.choice("abé漢z") for _ in range(r.randint(1, 7))).encode() for _ in range(2_000)})
    t = Transducer.from_bytes(Transducer.build(terms).to_bytes())
    others = ["".join(r.choice("abéy") for _ in range(r.randint(1, 8))).encode() for _ in range(300)]
    words = terms + others
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    lens = np.array([len(w) for w in words])
    got = t.ordinals(vocabulary.CLASS[data], np.cumsum(lens + 1) - lens - 1, lens)
    place = {w: k for k, w in enumerate(terms)}
    assert got.tolist() == [place.get(w, -1) for w in words]
    assert [t.term(k) for k in range(len(terms))] == terms
    assert vocabulary.automaton_size(t) == len(terms)


def test_transducer_is_minimal():
    """No two states have the same continuations."""
    terms = sorted(a + b + c for a in (b"", b"un", b"re") for b in (b"do", b"make", b"tie") for c in (b"", b"s", b"ing"))
    t = Transducer.build(terms)

    def language(s):
        begin, out = int(t.first[s * vocabulary.WORDS]), {b""} if t.final[s] else set()
        n = int(np.bitwise_count(t.bitmap[s * vocabulary.WORDS : (s + 1) * vocabulary.WORDS]).sum())
        for a in range(begin, begin + n):
            out |= {bytes([t.letter[a]]) + w for w in language(int(t.target[a]))}
        return frozenset(out)

    all_languages = [language(s) for s in range(len(t.final))]
    assert len(set(all_languages)) == len(all_languages) and all_languages[0] == frozenset(terms)


def test_shares_are_exact():
    r = random.Random(1)
    for _ in range(300):
        total = r.randint(1, 9 * 10**15)
        n = r.randint(0, total)
        assert shares(np.array([n]), np.array([total]))[0] == 1 + 10**9 * n // total


def test_ugly(spark, ugly):
    check(ugly, 1)
    check(ugly, 3, 5)
    check(ugly, 1_000)  # no language keeps a term


def test_small_slices_and_loads(spark, ugly, monkeypatch):
    monkeypatch.setattr(vocabulary, "SLICE_TERMS", 40)
    monkeypatch.setattr(vocabulary, "BROADCAST_BYTES", 30_000)
    monkeypatch.setattr(vocabulary, "HELD_TERMS", 100)
    monkeypatch.setattr(vocabulary, "HELD_CELLS", 100)
    monkeypatch.setattr(vocabulary, "BLOCK_BYTES", 1_000)
    check(ugly, 2)


def test_ties_and_case(spark):
    rows = [("Zeta zeta ALPHA É é x1y", "en", "a"), ("beta Beta alpha-zeta", "en", "b"), (None, "en", "c"), ("alpha", None, None), ("", "xx", "a")]
    assert ("xx", "a") not in {r[:2] for r in check(spark.createDataFrame(rows * 2, "text string, lang string, source string"), 1)}


def test_real(spark):
    got = check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), 5)
    assert len(got) > 1_000


def test_empty(empty):
    assert audit(empty).collect() == []

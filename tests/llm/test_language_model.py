import math
import re
import zlib
from collections import Counter

import numpy as np
from tidewatch.llm.language_model import learn_weights, score_documents, squeeze, unsqueeze

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def toks(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), "\n"]


def crc(i):
    return zlib.crc32(("" if i is None else str(i)).encode())


def brute(rows):
    """Scores by plain counting, weights from plain events."""
    train = [(i, toks(t)) for i, t in rows if crc(i) % 5 != 1]
    uni, bi, fit_uni, fit_bi = Counter(), Counter(), Counter(), Counter()
    dev = []
    for i, t in train:
        pairs = list(zip(["<s>", *t], t))
        uni.update(["<s>", *t]), bi.update(pairs)
        if crc(i) % 20 == 2:
            dev += pairs
        else:
            fit_uni.update(["<s>", *t]), fit_bi.update(pairs)
    n = sum(len(t) for _, t in train)
    n_fit = sum(c for w, c in fit_uni.items() if w != "<s>")
    v = sum(w != "<s>" for w in uni)
    bucket = lambda c: math.frexp(c)[1] if c else 0
    level = lambda p: 1 + math.floor(-2 * math.log2(p)) if p > 0 else 0
    cells = {}
    for a, b in dev:
        p2 = fit_bi[a, b] / fit_uni[a] if fit_uni[a] else 0.0
        p1 = fit_uni[b] / max(n_fit, 1)
        c = cells.setdefault((bucket(fit_uni[a]) << 20) + (level(p2) << 10) + level(p1), [0, 0.0, 0.0])
        c[0] += 1
        c[1] += p2
        c[2] += p1
    w = learn_weights([(k, *x) for k, x in sorted(cells.items())], v)
    out = []
    for i, text in rows:
        t = toks(text)
        score = 0.0
        for a, b in zip(["<s>", *t], t):
            c = uni[a]
            l2, l1, l0 = w[bucket(c)]
            p = l2 * (bi[a, b] / c if c else 0) + l1 * (uni[b] / max(n, 1)) + l0 / (v + 1)
            score += math.log10(p / (1 if c else l1 + l0))
        base = sum(math.log10((uni[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t)
        out.append((i, crc(i) % 5 == 1, len(t), sum(uni[x] > 0 for x in t), n, base, score))
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    np.testing.assert_allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


def test_against_plain_counts(ugly):
    rows = [(r["doc_id"], r["text"]) for r in ugly.select("doc_id", "text").collect()]
    same(score_documents(ugly).collect(), brute(rows))


def test_real_texts_and_gain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = score_documents(docs).collect()
    same(got, brute(rows))
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_empty(empty):
    assert score_documents(empty).collect() == []


def test_probabilities_sum_to_one():
    w = learn_weights([((3 << 20) + (2 << 10) + 5, 10, 4.0, 0.5), ((3 << 20) + 7, 4, 0.0, 0.01)], 50)
    assert np.allclose(w.sum(1), 1) and (w > 0).all()


def test_squeeze():
    a = np.array([0, 1, 254, 255, 256, 10**12])
    assert (unsqueeze(squeeze(a), len(a)) == a).all()

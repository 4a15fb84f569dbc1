import math
import random
import re
from collections import Counter

import pytest
from tidewatch.llm import quality_rules as Q


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if windows[w[i], w[i + 1], w[i + 2]] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
    return (*n, n[0] < 50 or 100 * n[4] > 50 * n[0])


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def check(docs, labels):
    got = Q.assess(docs, labels).collect()
    want = Counter((r["doc_id"], *plain(r["text"])) for r in docs.select("doc_id", "text").collect())
    assert Counter((r["doc_id"], *(r[c] for c in COLUMNS)) for r in got) == want
    return got


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")


def test_signals(spark, ugly, no_labels):
    got = check(ugly, no_labels)
    assert all(r["kept"] != r["base_failed"] for r in got)
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), no_labels)


def test_repeats(spark, no_labels):
    texts = ["a b c a b c a b c", "a a a a", "a a a", "x a b c y a b c", "a b", "a b c d a b c d e a b c", "a\x0bb\x0cc a b c"]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").selectExpr("*", "'en' as lang"), no_labels)


def test_binomial_bound():
    for n, p in ((50, 0.1), (2_000, 0.01), (300, 0.5)):
        total = 0.0
        for k in range(n):
            total += math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
            if k < n * p:
                assert Q.binomial_cdf(k, n, p) == pytest.approx(total, rel=1e-9)


def test_path():
    steps = Q.path()
    now = [100] * 4
    for signal, cutoff in steps:
        assert cutoff == now[signal] - 1
        now[signal] = cutoff
    assert now == [0] * 4
    first = Q.first_steps()
    for signal, level in ((0, 100), (1, 37), (2, 1), (3, 70)):
        t = first[signal][level]
        assert steps[t - 1] == (signal, level - 1)
    assert all(f[0] == len(steps) + 1 for f in first)


def test_certified_step():
    never, last = len(Q.path()) + 1, len(Q.path())
    assert Q.certified_step({never: 500}, {10: 5, 60: 3}, 0.02, 0.0125) == 60
    assert Q.certified_step({never: 180}, {10: 5}, 0.02, 0.0125) == 0  # too few to certify anything
    assert Q.certified_step({}, {10: 5}, 0.02, 0.05) == 0
    # two good ones lost only pay for more than forty bad ones
    assert Q.certified_step({never: 1_000, 30: 2}, {10: 5, 40: 39}, 0.02, 0.0125) == 10
    assert Q.certified_step({never: 1_000, 30: 2}, {10: 5, 40: 60}, 0.02, 0.0125) == 40
    # nothing behind the first failure
    assert Q.certified_step({never: 1_000, 30: 25}, {40: 10_000}, 0.02, 0.0125) == 0
    assert Q.certified_step({never: 1_000}, {last: 1}, 0.02, 0.0125) == last


def test_no_stratum_loses_more_than_promised():
    """Many holdouts: the share in which any stratum's true loss exceeds ALPHA stays within DELTA."""
    r, never, strata = random.Random(6), len(Q.path()) + 1, 4
    # a small stratum, large ones, and one unlike the rest whose good documents look bad early
    shape = [(230, 0.0004, 1), (500, 0.0004, 1), (2_000, 0.0004, 1), (500, 0.002, 1)]
    failed, runs = 0, 150
    for _ in range(runs):
        worst = 0.0
        for n, slope, first in shape:
            # the true share lost at step t is slope * (t - first + 1)
            draws = [never if (u := r.random()) >= slope * (never - first) else first + int(u / slope) for _ in range(n)]
            step = Q.certified_step(Counter(draws), {t: 10_000 for t in range(1, never)}, Q.ALPHA, Q.DELTA / strata)
            worst = max(worst, slope * max(0, step - first + 1))
        failed += worst > Q.ALPHA
    assert failed <= runs * Q.DELTA + 3 * math.sqrt(runs * Q.DELTA)


def test_certified_cutoffs_reject_junk(spark):
    clean = " ".join(f"word{k}" for k in range(60))
    rows = [(i, f"{clean} n{i}", "en" if i % 2 else "de") for i in range(6_000)]
    rows += [(10_000 + i, " ".join(f"w{k}x{i}###" for k in range(60)), "en") for i in range(40)]
    rows += [(20_000 + i, " ".join(f"w{k}x{i}###" for k in range(60)), "rare") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(8)
    labels = docs.selectExpr("doc_id", "cast(doc_id < 10000 as int) as quality", "0 as toxic").unionByName(
        spark.createDataFrame([(None, 1, 0), (1, None, 0), (3, 1, 1), (3, 1, 1)], "doc_id bigint, quality int, toxic int")
    )
    kept = {r["doc_id"] for r in Q.assess(docs, labels).where("kept").collect()}
    assert kept == {r[0] for r in rows if r[0] < 10_000 or r[2] == "rare"}
    assert {r["doc_id"] for r in Q.good_documents(docs, labels).collect()} == kept


def test_stage_keeps_columns(ugly, empty, no_labels):
    kept = Q.good_documents(ugly, no_labels)
    assert kept.columns == ugly.columns
    want = Q.assess(ugly, no_labels).where("kept").count()
    assert kept.count() == want
    assert Q.assess(empty, no_labels).collect() == [] and Q.good_documents(empty, no_labels).collect() == []


def test_no_python_in_the_plan(ugly, no_labels):
    for df in (Q.assess(ugly, no_labels), Q.good_documents(ugly, no_labels)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))

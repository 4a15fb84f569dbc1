import random
from collections import defaultdict

import numpy as np
import pytest
from tidewatch.llm.near_duplicates import classes, dart_signatures, prefix_pairs, without_near_duplicates


def plain(rows, threshold=0.8):
    """Class of every row by comparing all pairs that share a shingle."""
    def words(t):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").replace("\x0b", " ").replace("\x0c", " ")

    import re
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", words(t))
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    by, common = defaultdict(list), defaultdict(int)
    for i, s in enumerate(sets):
        for x in s or [None]:
            for j in by[x]:
                common[j, i] += 1
            by[x].append(i)
    for (i, j), c in common.items():
        if not sets[i] and not sets[j] or c >= threshold * (len(sets[i]) + len(sets[j]) - c):
            up[max(find(i), find(j))] = min(find(i), find(j))
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append(r[0])
    return groups


def check(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = classes(docs).collect()
    want = sorted(str((min((i for i in g if i is not None), default=None), sorted(map(str, g)))) for g in plain(rows).values())
    assert sum(r["kept"] for r in got) == len(want)
    # repeated ids may give two classes one class_id
    pairs = lambda classes: sorted(str((c, i)) for c, members in classes for i in members)
    groups = [(min((i for i in g if i is not None), default=None), g) for g in plain(rows).values()]
    assert pairs((r["class_id"], [r["doc_id"]]) for r in got) == pairs(groups)


def test_ugly(ugly):
    check(ugly)
    kept = without_near_duplicates(ugly)
    assert kept.columns == ugly.columns
    assert kept.count() == classes(ugly).where("kept").count()


def edited(w, times, r):
    w = list(w)
    for _ in range(times):
        w[r.randrange(len(w))] = f"new{r.random()}"
    return " ".join(w)


def test_groups_and_chains(spark):
    r = random.Random(1)
    texts = []
    for g in range(12):
        base = [f"g{g}w{r.randrange(9999)}" for _ in range(200)]
        texts += [edited(base, r.randrange(5), r) for _ in range(10)]
    chain = [f"c{k}" for k in range(300)]
    for k in range(15):  # each is like the next one only
        chain[k * 10 : k * 10 + 6] = [f"n{k}{j}" for j in range(6)]
        texts.append(" ".join(chain))
    passage = " ".join(f"p{k}" for k in range(60))
    texts += [passage + " " + " ".join(f"u{d}x{k}" for k in range(60)) for d in range(40)]
    r.shuffle(texts)
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))


def test_real(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"))


def test_signatures_estimate_weighted_similarity():
    r = np.random.default_rng(3)
    n, k = 400, 2_000
    h = r.integers(0, 1 << 62, n, dtype=np.int64).astype(np.uint64)
    a, b = r.choice([0.5, 1.0, 2.25, 4.0], n), r.choice([0.5, 1.0, 2.25, 4.0], n)
    s = dart_signatures(np.tile(h, 2), np.repeat([0, 1], n), np.concatenate([a, b]), 2, k)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((s[0] == s[1]).mean() - true) < 4 * np.sqrt(true * (1 - true) / k)
    assert (s != 0).all()
    one = dart_signatures(h[:1], np.zeros(1, int), np.ones(1), 1, 50)
    assert len(set(one.ravel().tolist())) == 50


def test_weighted_classes(spark):
    rows = [(1, "a b c d e " * 50), (2, "a b c d e " * 49), (3, "a b c d e " * 10), (4, "f g h i j " * 10)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["class_id"] for r in classes(docs, weighted=True).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}
    got = {r["doc_id"]: r["class_id"] for r in classes(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}


def test_empty(empty):
    assert classes(empty).collect() == [] and without_near_duplicates(empty).collect() == []


def test_many_repeats_of_two_near_texts(spark):
    """Repeated rows cost one comparison, not one per pair of rows."""
    r = random.Random(8)
    base = [f"w{r.randrange(9999)}" for _ in range(150)]
    a, b = " ".join(base), " ".join([*base[:-1], "other"])
    rows = [(None, a), (None, b), (5, a), (6, "one more text of its own words here")]
    docs = spark.createDataFrame(rows * 3_000, "doc_id bigint, text string").repartition(6)
    got = classes(docs).groupBy("class_id").agg({"*": "count", "class_texts": "max"}).collect()
    assert {(x["class_id"], x["count(1)"], x["max(class_texts)"]) for x in got} == {(5, 9_000, 2), (6, 3_000, 1)}


@pytest.mark.parametrize("weighted", [False, True])
def test_prefix_pairs_lose_nothing(spark, weighted):
    """All pairs of different components at the threshold or above are found, those exactly at it too."""
    r = random.Random(9)
    rows = []
    for node in range(240):
        base = random.Random(node % 12)
        words = [base.randrange(1, 90) for _ in range(40)]
        for _ in range(r.randrange(6)):
            words[r.randrange(40)] = r.randrange(1, 90)
        times = defaultdict(int)
        for w in words[: r.randrange(5, 41)] if node % 3 else words:
            times[w] += 1
        rows.append((node, node % 7 if node % 2 else node, sorted(times), [times[w] for w in sorted(times)]))
    rows += [(300, 300, [1, 2, 3, 4], [1] * 4), (301, 301, [1, 2, 3, 4, 5], [1] * 5)]  # 4 of 5
    sets = spark.createDataFrame(rows, "node bigint, comp bigint, shingles array<bigint>, times array<bigint>")
    got = [(x["a"], x["b"]) for x in prefix_pairs(sets, 0.8, weighted).collect()]
    assert len(got) == len(set(got))
    bags = {n: dict(zip(s, t if weighted else [1] * len(s), strict=True)) for n, _, s, t in rows}
    comp = {n: c for n, c, _, _ in rows}
    want = set()
    for a in bags:
        for b in bags:
            if a < b and comp[a] != comp[b]:
                common = sum(min(k, bags[b].get(s, 0)) for s, k in bags[a].items())
                if 5 * common >= 4 * (sum(bags[a].values()) + sum(bags[b].values()) - common):
                    want.add((a, b))
    assert len(want) > 50 and want <= set(got)
    assert all(comp[a] != comp[b] for a, b in got)


def test_a_large_family_leaves_few_pairs_to_the_filter(spark, monkeypatch):
    """Members that a family's first text misses find it by their neighbours, before all pairs of components are listed."""
    from tidewatch.llm import near_duplicates

    listed = []

    def counting(*args):
        found = prefix_pairs(*args)
        listed.append(found.count())
        return found

    monkeypatch.setattr(near_duplicates, "prefix_pairs", counting)
    r = random.Random(4)
    base = [f"w{k}" for k in range(150)]
    docs = [(k, edited(base, r.choice([1, 2, 3, 4]), r)) for k in range(400)]
    check(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert listed[0] < 12_000  # 21,213 without the neighbours, 9,173 with them


def test_common_passage_gives_no_pairs(spark):
    """What many texts share below the threshold costs no comparison, and a large component isn't compared with itself."""
    shared = list(range(70))
    rows = [(k, k, [*shared, *range(10_000 * (k + 1), 10_000 * (k + 1) + 30)]) for k in range(600)]
    rows += [(k, 1000, [*range(-99, 0), k]) for k in range(1000, 1600)] + [(2000, 2000, [*range(-99, 0), 1000])]
    sets = spark.createDataFrame([(*x, [1] * 100) for x in rows], "node bigint, comp bigint, shingles array<bigint>, times array<bigint>")
    got = {(x["a"], x["b"]) for x in prefix_pairs(sets, 0.8, False).collect()}
    assert (1000, 2000) in got and got <= {(k, 2000) for k in range(1000, 1600)}

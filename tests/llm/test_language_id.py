import numpy as np
from tidewatch.llm import language_id as L


def plain_bundle(text, d):
    """The bundle of one text, trigram by trigram."""
    s = f" {text} "
    v = {c: L.letter_vectors(np.array([ord(c)]), d)[0] for c in s}
    out = np.zeros(d)
    for a, b, c in zip(s, s[1:], s[2:]):
        out += np.roll(v[a], 2) * np.roll(v[b], 1) * v[c]
    return out


def test_bundles():
    texts = ["the other one", "a", "漢字 かな", "", "öü " * 500 + "x"]
    got = L.bundles(texts, 256)
    for t, g in zip(texts, got):
        np.testing.assert_allclose(g, plain_bundle(t, 256) if t else np.zeros(256), atol=1e-3)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    langs = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in L.identify(docs).collect() if r["held_out"]]
    assert len(held) > 200 and np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in held)


def test_ugly(ugly):
    rows = L.identify(ugly).collect()
    assert len(rows) == ugly.count()
    by = {r["doc_id"]: r for r in rows}
    for i in (4, 5, 6, 12):
        assert (by[i]["lang_pred"], by[i]["score"]) == (("und", 0.0))
    assert by[9]["lang_pred"] != "und"
    kept = L.in_a_language(ugly)
    assert kept.columns == ugly.columns
    gone = {r["doc_id"] for r in ugly.collect()} - {r["doc_id"] for r in kept.collect()}
    assert gone == {4, 5, 6, 12}
    assert set(map(tuple, kept.collect())) <= set(map(tuple, ugly.collect()))


def test_inputs_of_a_prediction(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    from pyspark.sql import functions as F
    from tidewatch.llm.common import crc_mod

    other = docs.withColumn("lang", F.when(crc_mod("doc_id", 3) == 1, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("z"))
    assert sorted(L.identify(docs).collect()) == sorted(L.identify(other).collect())


def test_empty_and_nothing_to_learn(spark, empty):
    assert L.identify(empty).collect() == [] and L.in_a_language(empty).collect() == []
    docs = spark.createDataFrame([(1, "some words", None)], "doc_id bigint, text string, lang string")
    assert [(r["lang_pred"], r["score"]) for r in L.identify(docs).collect()] == [("und", 0.0)]
    assert L.in_a_language(docs).count() == 1


def test_unlike_every_language(spark):
    import random

    r = random.Random(3)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = [
        " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 9))) for _ in range(n))
        for n in (10, 30, 100, 1000)
        for _ in range(25)
    ]
    odd += [
        "今天天气很好，我们一起去公园散步，然后在湖边的小餐馆吃午饭。",
        "오늘은 날씨가 좋아서 우리는 공원에 산책하러 갔습니다.",
        "วันนี้อากาศดีมากเราจึงไปเดินเล่นในสวนสาธารณะด้วยกัน",
        "आज मौसम बहुत अच्छा है इसलिए हम बगीचे में टहलने गए।",
        "Dzisiaj jest bardzo ładna pogoda, więc poszliśmy na spacer do parku.",
        "Сегодня очень хорошая погода, поэтому мы пошли гулять в парк.",
        "Σήμερα ο καιρός είναι πολύ καλός και πήγαμε βόλτα στο πάρκο.",
        "الطقس جميل جدا اليوم لذلك ذهبنا للتنزه في الحديقة",
        "מזג האוויר היום יפה מאוד ולכן הלכנו לטייל בפארק",
        "今日はとても天気がいいので、公園へ散歩に行きました。",
    ]
    new = spark.createDataFrame([(-1 - i, t, None, "odd", len(t)) for i, t in enumerate(odd)], docs.schema)
    kept = [r["doc_id"] for r in L.in_a_language(docs.unionByName(new)).select("doc_id").collect()]
    assert sum(i < 0 for i in kept) <= 1
    some = docs.where(r"regexp_like(text, '\\p{L}')").count()
    assert sum(i >= 0 for i in kept) >= 0.99 * some


def test_large_alphabets_take_little_memory():
    """Bundles of texts with very many distinct trigrams, within a bound that doesn't grow with the alphabet."""
    import tracemalloc

    r = np.random.default_rng(2)
    texts = ["".join(map(chr, r.integers(0x4E00, 0x9FA0, 2_000))) for _ in range(256)]
    tracemalloc.start()
    L.bundles(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 260 << 20

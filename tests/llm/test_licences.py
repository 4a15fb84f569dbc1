import pytest
from tidewatch.llm import licences


@pytest.fixture(scope="module")
def model(spark):
    return licences.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def scanned(spark, model, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = licences.scan(docs, model).where("confirmed").collect()
    return {(r["doc_id"], r["paragraph"], r["family"]) for r in rows}


def test_notices_in_texts(spark, model):
    filler = "thered onst the inan, ofther thanst edthe. " * 30
    texts, want = [], set()
    for f, notices in licences.TEMPLATES.items():
        for n in notices:
            want.add((len(texts), 1, f))
            texts.append(f"{filler}\n{n}\n{filler}")
    got = scanned(spark, model, texts)
    assert len(want - got) <= 1 and len(got - want) <= 1


def test_changed_notices(spark, model):
    texts = [
        "released under the MIT license",
        "*  Licensed under the Apache License, Version 2.0 (see LICENSE)",
        "This work is licensed under the GNU General Public License, version 3 or later.",
    ]
    assert {(i, f) for i, _, f in scanned(spark, model, texts)} == {(0, "mit"), (1, "apache-2.0"), (2, "gpl")}


def test_two_notices_in_a_line(spark, model):
    texts = ["Released under the MIT License. Licensed under the Apache License, Version 2.0.", "Licensed under the MIT License. All rights reserved."]
    got = {(i, f) for i, _, f in scanned(spark, model, texts)}
    assert got >= {(0, "mit"), (0, "apache-2.0"), (1, "mit")}


def test_other_texts(spark, model):
    texts = [*licences.OTHERWISE, "He was released from the hospital.", "The work of the public was free.", None, "", "...", "le la des"]
    assert scanned(spark, model, texts) == set()


def test_real(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    families = {t: f for f, ts in licences.TEMPLATES.items() for t in ts}
    want = {
        (r["doc_id"], k, families[line])
        for r in docs.collect()
        for k, line in enumerate((r["text"] or "").split("\n"))
        if line in families
    }
    got = {(r["doc_id"], r["paragraph"], r["family"]) for r in licences.scan(docs, model).where("confirmed").collect()}
    assert want and want == got


def test_long_paragraph(spark, model):
    text = "thered onst " * 400 + "Released under the MIT License. " + "inan edthe " * 400
    rows = licences.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), model).collect()
    assert all(len(r["text"].split()) <= licences.WINDOW for r in rows)
    parts = licences.paragraphs(spark.createDataFrame([(1, text)], "doc_id bigint, text string"))
    assert any("MIT License." in r["text"] for r in parts.collect())
    assert {r["family"] for r in rows if r["confirmed"]} == {"mit"}


def test_ugly_and_empty(ugly, empty, model):
    assert all(r["family"] != licences.UNKNOWN for r in licences.scan(ugly, model).collect())
    assert licences.scan(empty).collect() == []


def test_no_python_in_the_plan(ugly, model):
    plan = licences.scan(ugly, model)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))

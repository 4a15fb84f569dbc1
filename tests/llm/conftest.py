import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, score string, row string, h string, node string, band string, letters string, shard string, copies string"


def words(n, seed, stems=("th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha")):
    r = random.Random(seed)
    return " ".join("".join(r.choice(stems) for _ in range(r.randint(1, 4))) for _ in range(n))


def row(i, text, lang="en", source="s1"):
    return (i, text, lang, source, None if text is None else len(text), *["x"] * 9)


def ugly_rows():
    """Null and empty texts, blanks, ties, repeated rows, null keys, a very long text, odd characters."""
    base = words(120, 1)
    w = base.split()
    return [
        row(1, base),
        row(2, base, source="s2"),
        row(3, " ".join(["other", *w[1:]])),
        row(4, None),
        row(5, ""),
        row(6, " \t\n\x0b\x0c\r "),
        row(None, words(80, 2), None, None),
        row(None, None, None, None),
        row(7, words(90, 3), "de"),
        row(7, words(90, 3), "de"),
        row(7, words(95, 4), "de", None),
        row(8, words(30_000, 5), "fr", "s3"),
        row(9, "one"),
        row(10, "Ünï cödé 漢字 😀 a\x00b c " + words(60, 6), "es", "s3"),
        row(11, ("same line here\n" * 40) + words(70, 7), "en", "s3"),
        row(12, "### $$$ %%% 12 34"),
        *[row(100 + k, words(60 + k, 50 + k), ("en", "de", None)[k % 3], ("s1", "s2", None)[k % 3]) for k in range(30)],
    ]


@pytest.fixture(scope="session")
def ugly(spark):
    return spark.createDataFrame(ugly_rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)

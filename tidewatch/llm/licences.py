"""Licence notices by a trained paragraph classifier.

Paragraphs (lines, cut into overlapping windows of words where long) become
sparse counts of word unigrams and bigrams. A multinomial logistic regression
with one class per licence family and one for everything else scores them; its
confidence is calibrated on held-out paragraphs, and what stays below the
threshold is unknown. A predicted notice counts as confirmed if it covers, or is
covered by, a template of its family.

Training and scoring use Spark ML and SQL functions only.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stage, whole

# Customary notices of licence families, as they are written in the wild.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "This project is released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Licensed under the 3-clause BSD license.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
        "Licensed under CC BY-NC-ND 4.0.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Released under the GNU GPL, version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, you can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright 2020 Example Inc. All rights reserved.",
        "No part of this publication may be reproduced, distributed or transmitted in any form without the prior written permission of the publisher.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.",
    ],
    "public-domain": [
        "This work is dedicated to the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Released into the public domain under CC0 1.0 Universal.",
        "This is free and unencumbered software released into the public domain.",
    ],
}
# Sentences that use the words of notices for other things.
OTHERWISE = [
    "The driving licence was renewed last week without any trouble.",
    "The band released the album under a new name in version and form.",
    "You may not use this entrance after nine in the evening.",
    "Permission to land was granted to any person on board.",
    "The general public is invited free of charge to the opening.",
    "All seats are reserved for members of the foundation.",
    "He has the right to the domain and the work of the public library.",
    "The restaurant is licensed to sell beer and wine until midnight.",
    "A copy of the notice can be found in the hall near the source of the river.",
    "The law grants rights to the author and to the publisher of a work.",
    "The university MIT is in Massachusetts, and the Apache are a people of the southwest.",
    "The following conditions are met by the software that the group modified.",
]
UNKNOWN = "unknown"
#: Words of a paragraph classified together, and the step from one window to the next.
WINDOW, STEP = 100, 80
#: Background paragraphs the classifier is fitted on, about (a documented bound; scoring covers all).
BACKGROUND_ROWS = 4_000
VOCABULARY = 1 << 14
#: Least calibrated probability of a family, and least overlap with a template.
CONFIDENT, ALIKE = 0.5, 0.8
#: Every HOLD-th training paragraph is kept for calibration.
HOLD = 5


def tokens(text: Column) -> Column:
    """Lower-cased words; digits may hold dots (4.0)."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:\.\p{N}+)*"), 0)


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, paragraph, part, text): lines with a word, cut into windows of WINDOW words."""
    lines = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.posexplode(F.split(whole("text"), "\n")).alias("paragraph", "line"),
    )
    words = F.split(F.btrim(F.col("line"), F.lit(" \t\n\x0b\x0c\r")), r"[\x20\x09-\x0D]+")
    lines = lines.select("doc_id", "paragraph", words.alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("w") - 1 - (WINDOW - STEP)), F.lit(STEP))
    parts = lines.select("doc_id", "paragraph", "w", F.posexplode(starts).alias("part", "s"))
    text = F.array_join(F.slice("w", F.col("s") + 1, WINDOW), " ")
    return parts.select("doc_id", "paragraph", "part", text.alias("text")).where("text <> ''")


def with_grams(rows: DataFrame) -> DataFrame:
    """``rows`` with their words and the sparse features' names, grams: each word and word pair once."""
    t = rows.withColumn("words", tokens(F.col("text")))
    pairs = F.when(
        F.size("words") > 1,
        F.zip_with(
            F.slice("words", F.lit(1), F.greatest(F.size("words") - 1, F.lit(0))),
            F.slice("words", F.lit(2), F.greatest(F.size("words") - 1, F.lit(0))),
            lambda a, b: F.concat_ws(" ", a, b),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return t.withColumn("grams", F.concat("words", pairs))


def examples(spark, docs: DataFrame) -> DataFrame:
    """(label, text): windows of the templates, misleading sentences, and a bounded sample of background paragraphs."""
    families = sorted(TEMPLATES)
    known = [(families.index(f), t) for f in families for t in TEMPLATES[f]] + [(len(families), t) for t in OTHERWISE]
    cells = F.array(*[F.struct(F.lit(i).cast("double").alias("label"), F.lit(t).alias("text")) for i, t in known])
    base = spark.range(1).select(F.explode(cells).alias("x")).select("x.*").withColumn("w", F.split("text", " "))
    n = F.size("w")
    # all windows of a half, three quarters and all of a notice, at least three words
    lengths = F.array_distinct(F.transform(F.array(F.lit(2), F.lit(3), F.lit(4)), lambda q: F.greatest(F.least(n, F.lit(3)), F.floor(n * q / 4).cast("int"))))
    base = base.withColumn("n", F.explode(lengths)).withColumn("s", F.explode(F.sequence(F.lit(1), n - F.col("n") + 1)))
    windows = base.select("label", F.array_join(F.slice("w", F.col("s"), F.col("n")), " ").alias("text"))
    # a notice often follows or precedes other words; whole templates count for more than their parts
    whole_ones = base.where(F.col("n") == n).select("label", "text", F.explode(F.sequence(F.lit(1), F.lit(10))).alias("i"))
    total = docs.count()
    share = min(1.0, BACKGROUND_ROWS / max(total, 1))
    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    background = paragraphs(some).select("text").withColumn("r", F.xxhash64("text")).orderBy("r").limit(BACKGROUND_ROWS)
    notices = F.array(*[F.array_distinct(tokens(F.lit(t))) for i, t in known if i < len(families)])
    own = F.array_distinct(tokens(F.col("text")))
    alike = F.exists(notices, lambda t: F.size(F.array_intersect(t, own)) >= 0.6 * F.size(t))
    background = background.where(~alike).select(F.lit(float(len(families))).alias("label"), "text")
    rows = windows.unionByName(whole_ones.drop("i")).unionByName(background)
    return rows.withColumn("hold", F.pmod(F.xxhash64("text"), F.lit(HOLD)) == 0)


class Classifier:
    """A fitted vocabulary and regression, and the temperature of its scores."""

    def __init__(self, vectors: CountVectorizerModel, regression: LogisticRegressionModel, temperature: float):
        self.vectors, self.regression, self.temperature = vectors, regression, temperature
        self.families = [*sorted(TEMPLATES), UNKNOWN]

    def margins(self, rows: DataFrame) -> DataFrame:
        out = self.regression.transform(self.vectors.transform(with_grams(rows)))
        out = out.withColumn("margins", vector_to_array("rawPrediction")).withColumn("top", F.array_max("margins"))
        out = out.drop("features", "rawPrediction", "probability", "prediction", "grams")
        # the row number keeps filters above the scores; pushed below, they would work them out once per use
        return out.withColumn("nr", F.monotonically_increasing_id())

    def predict(self, rows: DataFrame) -> DataFrame:
        """Those of ``rows`` that a family is predicted for, with family, probability, similarity and confirmed."""
        m = self.margins(rows)
        top = F.col("top")
        # the largest margin first; the rest is worked out for rows that aren't unknown by it
        m = m.withColumn("at", (F.array_position("margins", top) - 1).cast("int"))
        t = F.lit(self.temperature)
        total = F.aggregate("margins", F.lit(0.0), lambda a, x: a + F.exp((x - top) / t))
        names = F.array(*[F.lit(f) for f in self.families])
        m = m.withColumn("probability", 1.0 / total)
        m = m.withColumn(
            "family",
            F.when(F.col("probability") >= CONFIDENT, F.element_at(names, F.col("at") + 1)).otherwise(F.lit(UNKNOWN)),
        )
        own = F.array_distinct("words")
        similarity = F.lit(0.0)
        for f in sorted(TEMPLATES):
            best = F.greatest(F.lit(0.0), *[
                F.size(F.array_intersect(words, own)) / F.least(F.size(words), F.greatest(F.size(own), F.lit(3)))
                for words in (F.array_distinct(tokens(F.lit(x))) for x in TEMPLATES[f])
            ])
            similarity = F.when(F.col("family") == f, best).otherwise(similarity)
        m = m.withColumn("similarity", similarity).withColumn("confirmed", F.col("similarity") >= ALIKE)
        return m.where((F.col("nr") >= 0) & (F.col("family") != UNKNOWN)).drop("margins", "top", "nr", "words", "at")


def fit(docs: DataFrame) -> Classifier:
    """Fit on templates and at most BACKGROUND_ROWS background paragraphs; calibrate on the part held out."""
    rows = stage(with_grams(examples(docs.sparkSession, docs)), "licence-examples")
    train = rows.where("not hold")
    vectors = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=VOCABULARY, minDF=1, binary=True)
    vectors = vectors.fit(train.where(F.col("label") < len(TEMPLATES)))
    regression = LogisticRegression(family="multinomial", regParam=1e-3, elasticNetParam=0.5, maxIter=80)
    regression = regression.fit(vectors.transform(train))
    model = Classifier(vectors, regression, 1.0)
    held = model.margins(rows.where("hold").drop("words", "grams"))
    own = F.element_at("margins", (F.col("label") + 1).cast("int"))
    top = F.col("top")
    temperatures = [0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0]

    def loss(t: float) -> Column:
        return F.avg(F.log(F.aggregate("margins", F.lit(0.0), lambda a, x: a + F.exp((x - top) / t))) - (own - top) / t)

    losses = held.agg(*[loss(t).alias(str(t)) for t in temperatures]).first()
    known = [(x, t) for x, t in zip(losses, temperatures, strict=True) if x is not None]
    model.temperature = min(known)[1] if known else 1.0
    return model


def without_template(words: str = "words") -> Column:
    """The words of a row without the most similar template of its family, each of its words taken out once."""
    own = F.array_distinct(F.col(words))
    best = F.array().cast("array<string>")
    for f in sorted(TEMPLATES):
        known = [F.array_distinct(tokens(F.lit(x))) for x in TEMPLATES[f]]
        likeness = [F.struct((F.size(F.array_intersect(t, own)) / F.size(t)).alias("share"), F.size(t).alias("n"), t.alias("t")) for t in known]
        best = F.when(F.col("family") == f, F.array_max(F.array(*likeness))["t"]).otherwise(best)
    again = lambda w, i: F.array_position(F.col(words), w) != i + 1
    return F.filter(F.col(words), lambda w, i: ~F.array_contains(best, w) | again(w, i))


def scan(docs: DataFrame, model: Classifier | None = None) -> DataFrame:
    """One row per notice: doc_id, paragraph (line number from 0), part, text, family, probability, similarity, confirmed.

    A window can hold a second notice: the words of the templates of the family found are taken out and the
    rest is classified once more; it counts if a template of another family confirms it.
    Null and empty texts have no paragraphs; ids may be null or repeated, and
    each row is scanned. An empty table gives no rows. Long paragraphs are covered by overlapping
    windows, so a notice may be found in two parts. Other columns are not read.
    """
    model = model or fit(docs)
    first = stage(model.predict(paragraphs(docs)), "licence-notices")
    rest = first.withColumn("words", tokens(F.col("text"))).select(
        "doc_id", "paragraph", "part", F.col("text").alias("whole"), F.col("family").alias("before"),
        F.array_join(without_template(), " ").alias("text"),
    )
    second = model.predict(rest.where("text <> ''")).where("confirmed and family <> before")
    return first.unionByName(second.drop("text", "before").withColumnRenamed("whole", "text").select(*first.columns))

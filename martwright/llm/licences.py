"""Licence scans: a trained paragraph classifier, confirmed against templates.

Paragraphs are parted by blank lines and by lines that end a sentence; lines that wrap are joined. Every
paragraph of every document is scored by the model, whatever its words. Those taken for a licence are
compared with the templates, equal ones once.

A multinomial logistic regression over word 1- and 2-grams tells licence families and ``unknown``; its
weights are sparse, as most are driven to zero. It learns from the templates below, whole, in parts and
with words around them, and from paragraphs of the corpus for ``unknown`` (at most ``NEGATIVES`` of
``SAMPLE_DOCS`` documents, those that hash lowest, none of which looks like a template). Its probabilities
are calibrated on a fold that it did not learn from, by a logistic regression of "the family is right" on
their log odds; ``error`` is the expected calibration error on a third fold. A paragraph whose calibrated
probability is below ``LEAST`` is unknown. Other predictions are confirmed if the paragraph has most of a
template's word pairs, or a template of the family most of the paragraph's; predictions that no template
confirms are reported as such and name no family.

DataFrame functions and ``pyspark.ml`` throughout: nothing runs in Python on the executors. Templates,
vocabulary and model have a fixed size. Word pairs meet the templates in a broadcast list of the pairs
that templates have. Verdicts, a few bytes each, are gathered by document.

Nulls and odd inputs: a null or empty text has no paragraphs. Repeated rows are one document for
the count of its rows and each get a row. A null doc_id stays null. An empty table gives an empty
result, and a model can be fitted on one. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import functools
import itertools
import random
import re

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, NGram, RegexTokenizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import looked_up, stored, texts, unused_name

UNKNOWN = "unknown"
SAMPLE_DOCS = 400
NEGATIVES = 4000
FOLDS = 6  # the first calibrates, the second measures, the others are learned from
LEAST = 0.5
CONFIRMED = 0.6
# Fixed: words and parts of words by which licence notices are known.
CUES = ("licen", "copyright", "permission", "redistribut", "gnu ", "mozilla", "creative commons", "unencumber", "waived", "rights reserved", "spdx", "proprietary", "unauthori", "public domain")
WORD = "[^a-z0-9.+]+|[.](?![0-9])"
# How the notices of common licences read.
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU GPL v2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "cc-by-sa": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "cc-by-nc": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "public-domain": (
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "proprietary": (
        "All rights reserved. No part of this publication may be reproduced without prior written permission.",
        "Copyright, all rights reserved.",
        "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
    ),
}
# Speak of licences and name no family.
UNDECIDED = (
    "See the license for details.",
    "The license of this software is described elsewhere.",
    "You need a driving license and a fishing license.",
    "He has a license to operate heavy machinery in this state.",
    "Licensed premises under new management.",
    "The copyright office moved to a new building.",
    "Copyright law is hard to understand for the public.",
    "This work is licensed under terms that the author chose.",
    "The permission was granted by the local authority.",
    "The general public was not admitted to the software fair.",
    "The source of the river lies in the mountains.",
    "A new version of the software was released.",
)


def words(text: str) -> list[str]:
    return [w for w in re.split(WORD, text.lower()) if w]


def _examples(seed: int = 11) -> list[tuple[str, str, int]]:
    """(paragraph, family, fold) from the templates: whole, in halves, and between other words."""
    draw, found = random.Random(seed), []
    noise = "file project code page notes text work data authors version www info read this see".split()
    whole = [(t, f) for f, ts in TEMPLATES.items() for t in ts] + [(t, UNKNOWN) for t in UNDECIDED]
    for text, family in whole:
        split = text.split()
        parts = [split] * 8
        if len(split) > 12 and family != UNKNOWN:
            parts += [split[: len(split) * 2 // 3]] * 3
        for part in parts:
            before, after = (draw.choices(noise, k=draw.randrange(4)) for _ in range(2))
            kept = [w for w in part if draw.random() > 0.04]
            found.append((" ".join([*before, *kept, *after]), family))
    return [(t, f, i % FOLDS) for i, (t, f) in enumerate(found)]


def cued(text: Column | str) -> Column:
    """Whether a text has a cue, wherever it stands."""
    lowered = F.lower(text)
    return functools.reduce(Column.__or__, (F.contains(lowered, F.lit(cue)) for cue in CUES))


def all_paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, paragraph) of every paragraph that is not blank, in lower case."""
    docs = texts(docs).select("doc_id", F.lower("text").alias("text"))
    joined = F.regexp_replace("text", r"(?<![.!?:;\s])[ \t\r]*\n[ \t]*(?=\S)", " ")
    rows = docs.select("doc_id", F.explode(F.split(joined, r"[\r\n]+")).alias("paragraph"))
    return rows.select("doc_id", F.btrim("paragraph", F.lit(" \t")).alias("paragraph")).where("paragraph != ''")


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, paragraph) of every paragraph with a cue, in lower case."""
    return all_paragraphs(docs).where(cued("paragraph"))


def _tokens(column: str) -> Column:
    return F.filter(F.split(F.lower(F.col(column)), WORD), lambda w: w != "")


def _pairs(tokens: Column) -> Column:
    """The distinct pairs of neighbouring words."""
    ahead = F.slice(tokens, 2, F.greatest(F.size(tokens), F.lit(1)))
    pairs = F.zip_with(F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0))), ahead, lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.filter(pairs, lambda p: p.isNotNull()))


def _templates() -> list[tuple[str, list[str]]]:
    return [(f, sorted({f"{a} {b}" for a, b in itertools.pairwise(words(t))})) for f, ts in TEMPLATES.items() for t in ts]


def likenesses(rows: DataFrame) -> DataFrame:
    """(paragraph, family, likeness): for distinct paragraphs and every family they share a word pair with,
    the largest share of word pairs in common with one of its templates.

    Shares are of the template's pairs, or of the paragraph's if it has three.
    """
    known = [(f, i, len(pairs), pair) for i, (f, pairs) in enumerate(_templates()) for pair in pairs]
    listed = rows.sparkSession.createDataFrame(known, "family string, template int, own int, pair string")
    pairs = rows.select("paragraph", _pairs(_tokens("paragraph")).alias("pairs"))
    pairs = pairs.select("paragraph", F.size("pairs").alias("n"), F.explode("pairs").alias("pair"))
    common = pairs.join(F.broadcast(listed), "pair").groupBy("paragraph", "n", "family", "template", "own").agg(F.count("*").alias("common"))
    share = F.greatest(F.col("common") / F.col("own"), F.when(F.col("n") >= 3, F.col("common") / F.col("n")).otherwise(0.0))
    return common.groupBy("paragraph", "family").agg(F.max(share).alias("likeness"))


class Scanner:
    """The fitted model and its calibration: probability = 1 / (1 + exp(-(slope * log odds + base)))."""

    def __init__(self, model: PipelineModel, slope: float = 1.0, base: float = 0.0, error: float | None = None) -> None:
        self.model, self.slope, self.base, self.error = model, slope, base, error

    def odds(self, rows: DataFrame) -> DataFrame:
        """With ``family``, the likeliest one besides unknown, and the log ``odds`` the model gives it."""
        scored = self.model.transform(rows).withColumn("p", vector_to_array("probability"))
        named = (F.struct(F.get("p", F.lit(i)).alias("p"), F.lit(f).alias("f")) for i, f in enumerate(TEMPLATES))
        scored = scored.withColumn("best", F.array_max(F.array(*named)))
        p = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), F.col("best.p")))
        return scored.select(*rows.columns, F.col("best.f").alias("family"), F.log(p / (1 - p)).alias("odds"))

    def probabilities(self, rows: DataFrame) -> DataFrame:
        """With ``family`` and its calibrated ``probability``."""
        found = self.odds(rows)
        return found.withColumn("probability", 1 / (1 + F.exp(-(self.slope * F.col("odds") + self.base)))).drop("odds")


def _sample(docs: DataFrame) -> DataFrame:
    """Paragraphs of the corpus that look like no template, with a fold: the negatives.

    All lines of the sampled documents count, with and without cues.
    """
    chosen = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    sampled = stored(docs.join(F.broadcast(chosen), "doc_id", "left_semi"), "licence-sample")
    lines = sampled.select(F.explode(F.split(F.lower("text"), "[\\r\\n]+")).alias("paragraph"))
    rows = lines.union(paragraphs(sampled).select("paragraph")).where("paragraph != ''").distinct()
    rows = stored(rows.orderBy(F.xxhash64("paragraph"), "paragraph").limit(NEGATIVES), "licence-negatives")
    alike = likenesses(rows).where(F.col("likeness") >= CONFIRMED).select("paragraph").distinct()
    rows = rows.join(alike, "paragraph", "left_anti")
    return rows.withColumn("fold", F.pmod(F.xxhash64("paragraph"), F.lit(FOLDS)).cast("int"))


def _label(column: str, families: list[str]) -> Column:
    return F.coalesce(*(F.when(F.col(column) == f, F.lit(float(i))) for i, f in enumerate(families)))


def _right(scanner: Scanner, rows: DataFrame) -> DataFrame:
    found = scanner.odds(rows.select("paragraph", F.col("family").alias("truth")))
    return found.select("odds", "family", "truth", (F.col("family") == F.col("truth")).cast("double").alias("label"))


def fit(docs: DataFrame) -> Scanner:
    """A scanner from the templates and a bounded sample of the documents."""
    spark, families = docs.sparkSession, [*TEMPLATES, UNKNOWN]
    examples = spark.createDataFrame(_examples(), "paragraph string, family string, fold int").coalesce(1)
    negatives = _sample(texts(docs))
    rows = stored(examples.union(negatives.select("paragraph", F.lit(UNKNOWN), "fold")), "licence-examples")
    rows = rows.withColumn("label", _label("family", families))
    tokens = {t: words(t) for ts in [*TEMPLATES.values(), UNDECIDED] for t in ts}
    known = sorted({w for ws in tokens.values() for w in ws})
    terms = known + sorted({f"{a} {b}" for ws in tokens.values() for a, b in itertools.pairwise(ws)})
    stages = [
        RegexTokenizer(inputCol="paragraph", outputCol="words", pattern=WORD),
        NGram(n=2, inputCol="words", outputCol="two"),
        SQLTransformer(statement="SELECT *, concat(words, two) AS terms FROM __THIS__"),
        CountVectorizerModel.from_vocabulary(terms, "terms", "features", binary=True),
        LogisticRegression(family="multinomial", elasticNetParam=1.0, regParam=0.001, maxIter=60),
    ]
    scanner = Scanner(Pipeline(stages=stages).fit(rows.where("fold > 1")))
    odds = VectorAssembler(inputCols=["odds"], outputCol="features")
    fitted = LogisticRegression(regParam=0.001).fit(odds.transform(_right(scanner, rows.where("fold = 0"))))
    scanner.slope, scanner.base = float(fitted.coefficients[0]), float(fitted.intercept)
    scanner.error = calibration_error(scanner, rows.where("fold = 1"))
    return scanner


def calibration_error(scanner: Scanner, rows: DataFrame, bins: int = 10) -> float:
    """The mean gap between probability and share of right families, over bins of probability.

    ``rows`` have a paragraph and its true ``family``.
    """
    found = scanner.probabilities(rows.select("paragraph", F.col("family").alias("truth")))
    place = F.least(F.floor(F.col("probability") * bins), F.lit(bins - 1)).alias("bin")
    right = F.avg((F.col("family") == F.col("truth")).cast("double"))
    gaps = found.groupBy(place).agg(F.abs(right - F.avg("probability")).alias("gap"), F.count("*").alias("n"))
    return gaps.agg(F.sum(F.col("gap") * F.col("n")) / F.sum("n")).first()[0] or 0.0


def verdicts(rows: DataFrame, scanner: Scanner) -> DataFrame:
    """(paragraph, family, probability, likeness, confirmed) of those of the distinct paragraphs that are
    taken for a licence."""
    found = scanner.probabilities(rows).where(F.col("probability") >= LEAST)
    found = found.join(likenesses(rows), ["paragraph", "family"], "left").na.fill({"likeness": 0.0})
    return found.withColumn("confirmed", F.col("likeness") >= CONFIRMED)


def likely(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """(doc_id, paragraph) of the paragraphs that the model takes for a licence; all are scored.

    The probability passes a generator, through which no filter is pushed: else the model would be asked
    once more for each of its mentions in the condition.
    """
    scored = scanner.probabilities(all_paragraphs(docs))
    scored = scored.select("doc_id", "paragraph", F.explode(F.array("probability")).alias("probability"))
    return scored.where(F.col("probability") >= LEAST).drop("probability")


def scan(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """(doc_id, paragraph, family, probability, likeness, confirmed) of paragraphs taken for a licence."""
    rows = stored(likely(docs, scanner), "licence-paragraphs")
    counted = stored(rows.groupBy("paragraph").agg(F.count("*").alias("n")), "licence-distinct")
    named = stored(verdicts(counted.select("paragraph"), scanner).join(counted, "paragraph"), "licence-verdicts")
    columns = ["family", "probability", "likeness", "confirmed"]
    keyed = named.select(F.xxhash64("paragraph").alias("key"), F.length("paragraph").alias("length"), F.crc32("paragraph").alias("crc"), *columns, "n")
    key = ["key", "length", "crc"]
    rows = rows.select("*", F.xxhash64("paragraph").alias("key"), F.length("paragraph").alias("length"), F.crc32("paragraph").alias("crc"))
    return looked_up(rows, keyed, key, columns, weight="n").where(F.col("family").isNotNull()).drop(*key)


def report(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """(doc_id, licences, n_confirmed, n_unconfirmed, probability) of every row.

    ``licences`` are the confirmed families, sorted and comma-joined; ``probability`` is the highest
    of a confirmed paragraph. Rows with one doc_id are one document and get the same values.
    """
    key, confirmed = unused_name(docs), F.col("confirmed")
    gathered = scan(docs, scanner).groupBy(F.col("doc_id").alias(key)).agg(
        F.array_join(F.sort_array(F.collect_set(F.when(confirmed, F.col("family")))), ",").alias("licences"),
        F.sum(confirmed.cast("long")).alias("n_confirmed"),
        F.sum((~confirmed).cast("long")).alias("n_unconfirmed"),
        F.round(F.max(F.when(confirmed, F.col("probability"))), 4).alias("probability"),
    )
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"))
    rows = rows.join(gathered, rows["doc_id"].eqNullSafe(gathered[key]), "left").drop(key)
    return rows.na.fill({"licences": "", "n_confirmed": 0, "n_unconfirmed": 0})

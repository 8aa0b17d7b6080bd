"""Licence notices in texts, by a trained paragraph classifier, confirmed by templates.

A paragraph is a line of a text. Its features are its distinct words (lower-cased runs of a-z and 0-9) and
pairs of neighbouring words, as far as templates hold them and ordinary lines rarely do. A sparse multinomial logistic regression tells licence families and
``unknown`` apart. It is learned from the templates below and all their stretches of some words, against
lines of a bounded sample of the texts at hand (``sample``, the expected number of texts). A family needs a
probability above ``unknown`` and above a bar that ``FALSE_ALARMS`` of held-out ordinary lines reach.
A prediction counts as confirmed if the line and one of the family's templates share most of the
words of the shorter one, all version numbers (3 is 3.0), and all words that tell licences apart or deny (``TELLING``): what
is one word or number away from a template is another licence, or none.

Only DataFrame functions work on the texts. Most lines hold no word or pair that speaks clearly for
a family against ``unknown``; they are ``unknown`` whatever else they hold, and one pattern over the
line finds that out. The rest are scored once for each distinct line, by a join with the
weights, whose number the vocabulary bounds.

Null and empty texts have no paragraphs. Rows without an id are scanned like others. Repeated rows
give repeated results. Without texts to sample, the model knows templates only.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabularium.llm.tables import keep

#: Wordings by which texts name their licence.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        ' associated documentation files (the "Software"), to deal in the Software without restriction',
        "The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in'
        " compliance with the License.",
        "Released under the Apache 2.0 license.",
    ],
    "Apache-1.1": [
        "Licensed under the Apache Software License, Version 1.1.",
        "Licensed under the Apache License, Version 1.1.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation, either version 3 of the License",
        "Licensed under the GPL v3.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation; either version 2 of the License",
        "Licensed under the GPL v2.",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " Lesser General Public License as published by the Free Software Foundation, either version 3 of the License",
        "Licensed under the LGPL v3.",
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "Licensed under the LGPL v2.1.",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " Affero General Public License as published by the Free Software Foundation, either version 3 of the License",
        "Licensed under the AGPL v3.",
    ],
    "BSD": [
        "Released under the BSD License.",
        "Licensed under the 3-clause BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "MPL-1.1": [
        "The contents of this file are subject to the Mozilla Public License Version 1.1",
        "Licensed under the Mozilla Public License, version 1.1.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-ND-4.0": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "CC-BY-NC-SA-4.0": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-ND-4.0": [
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ],
}
UNKNOWN = "unknown"

#: Words that tell a licence from its neighbours, or a grant from its denial.
TELLING = [
    "lesser", "library", "affero", "lgpl", "agpl", "nc", "nd", "sa", "noncommercial", "noderivatives", "noderivs",
    "sharealike", "not", "never", "neither", "unlike", "formerly", "previously",
]
#: What stands before the number of a version.
VERSION = (
    r"(?:version|v|license|licence|gpl|apache|mpl|by|nc|nd|sa|attribution|noncommercial|noderivatives|sharealike)"
    r"[^a-z0-9]{0,3}([0-9]+(?:\.[0-9]+)*)"
)

#: Expected number of texts whose lines stand for ordinary ones.
SAMPLE = 400
#: Penalty of the regression, and the share of it that makes for sparse weights.
PENALTY, SPARSE = 0.0005, 0.5
#: Words and pairs that a larger share of ordinary lines hold are not looked at.
COMMON = 0.01
#: Lengths in words of stretches of templates to learn from.
STRETCHES = (4, 6, 9, 14)
FALSE_ALARMS = 0.001
#: Share of the shorter side's distinct words that line and template must share, and how many at least.
SHARED, SHARED_WORDS = 0.8, 3


def words(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), "[^a-z0-9]+"), lambda w: w != "")


def grams(word: Column) -> Column:
    """Distinct words and pairs of neighbouring words."""
    pairs = F.zip_with(
        F.slice(word, 1, F.greatest(F.size(word) - 1, F.lit(0))),
        F.slice(word, 2, F.greatest(F.size(word) - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.array_distinct(F.concat(word, pairs))


class Classifier(NamedTuple):
    """``weights`` by word or pair, a number for each of ``families``; the last family is unknown."""

    families: list[str]
    weights: dict[str, list[float]]
    bias: list[float]
    bar: float

    def telling(self) -> set[str]:
        """Grams without which a line cannot be anything but unknown.

        All others together, were they all there, would not make up for the bias of any family.
        """
        lead = [b - self.bias[-1] for b in self.bias[:-1]]
        gains = {g: [max(0.0, x - w[-1]) for x in w[:-1]] for g, w in self.weights.items()}
        weakest = sorted((g for g in gains if max(gains[g]) > 0), key=lambda g: (max(gains[g]), g))
        for k, gram in enumerate(weakest):
            lead = [a + b for a, b in zip(lead, gains[gram], strict=True)]
            if max(lead) >= 0:
                return set(weakest[k:])
        return set()

    def pattern(self) -> str:
        """Matches the lower-cased lines that may be anything but unknown."""
        if any(b >= self.bias[-1] for b in self.bias[:-1]):
            return ""
        telling = self.telling()
        single = {g for g in telling if " " not in g}
        pairs = {g for g in telling - single if not single & set(g.split(" "))}
        found = [g.replace(" ", "[^a-z0-9]+") for g in sorted(single | pairs)]
        return f"(?<![a-z0-9])(?:{'|'.join(found)})(?![a-z0-9])" if found else "(?!)"


def templates(spark: SparkSession) -> DataFrame:
    """``family, template``."""
    rows = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    return spark.createDataFrame(rows, "family string, template string")


def _positives(spark: SparkSession) -> DataFrame:
    """``family, words`` of whole templates and their stretches; what two families share is left out."""
    whole = templates(spark).select("family", words(F.col("template")).alias("whole"))
    parts = whole.select("family", F.col("whole").alias("words"))
    for length in STRETCHES:
        starts = F.sequence(F.lit(1), F.size("whole") - length + 1)
        cut = F.transform(starts, lambda at: F.slice(F.col("whole"), at, length))  # noqa: B023
        parts = parts.unionAll(whole.where(F.size("whole") >= length).select("family", F.explode(cut)))
    shared = parts.groupBy("words").agg(F.collect_set("family").alias("families"))
    return shared.where("size(families) = 1").select(F.col("families")[0].alias("family"), "words")


def _matches(line: Column, template: Column) -> Column:
    """Whether two lists of distinct words share most of the shorter one."""
    common = F.size(F.array_intersect(line, template))
    return (common >= SHARED_WORDS) & (common >= SHARED * F.least(F.size(line), F.size(template)))


def _versions(line: Column) -> Column:
    """The version numbers that a line names, in order, without zeros at their ends."""
    found = F.regexp_extract_all(F.lower(line), F.lit(VERSION), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(found, lambda v: F.regexp_replace(v, r"(\.0+)+$", ""))))


def _told(word: Column) -> Column:
    """Which of the telling words are among distinct ones, in order."""
    return F.array_sort(F.array_intersect(word, F.array(*map(F.lit, TELLING))))


def _ordinary(docs: DataFrame, sample: int) -> DataFrame:
    """``family, words`` of the lines of some texts, by their hash, that match no template."""
    buckets = 1 << 24
    known = docs.where("text is not null")
    cut = min(buckets, -(-buckets * sample // max(1, known.count())))
    chosen = known.where(F.pmod(F.xxhash64(F.lit(3), "text"), F.lit(buckets)) < cut).select("text").distinct()
    lines = chosen.select(F.explode(F.split("text", "\n")).alias("line")).distinct()
    lines = lines.select(words(F.col("line")).alias("words")).where("size(words) > 0")
    own = [F.array_distinct(words(F.lit(text))) for texts in TEMPLATES.values() for text in texts]
    known_one = F.exists(F.array(*own), lambda t: _matches(F.array_distinct("words"), t))
    return lines.where(~known_one).select(F.lit(UNKNOWN).alias("family"), "words")


def _vocabulary(examples: DataFrame, ordinary: int) -> list[str]:
    """Words and pairs of templates, but those of too many of the sampled ordinary lines."""
    is_ordinary = (F.col("label") == ordinary).cast("int")
    n = examples.agg(F.sum(is_ordinary)).first()[0] or 0
    counts = examples.select(F.explode("grams").alias("gram"), is_ordinary.alias("ordinary")).groupBy("gram")
    found = counts.agg(F.sum("ordinary").alias("n"), F.min("ordinary").alias("only")).where(
        (F.col("only") == 0) & (F.col("n") <= COMMON * n)
    )
    return sorted(row.gram for row in found.select("gram").collect())


def learn(docs: DataFrame, sample: int = SAMPLE) -> Classifier:
    """A classifier for ``text``; the sampled lines and the vocabulary are bounded."""
    spark = docs.sparkSession
    families = [*sorted(TEMPLATES), UNKNOWN]
    label = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    examples = (
        _positives(spark)
        .unionByName(_ordinary(docs, sample))
        .select(label.cast("double").alias("label"), grams(F.col("words")).alias("grams"))
        .withColumn("held", (F.pmod(F.xxhash64("grams"), F.lit(4)) == 0) & (F.col("label") == len(families) - 1))
    )
    examples = keep(examples, "examples")
    vocabulary = _vocabulary(examples, len(families) - 1)
    counted = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features").setBinary(True)
    fit = LogisticRegression(
        family="multinomial", regParam=PENALTY, elasticNetParam=SPARSE, maxIter=80, standardization=False
    ).fit(counted.transform(examples.where("not held")).select("label", "features").coalesce(1))
    rows = fit.coefficientMatrix.toArray().T.tolist()
    bias = fit.interceptVector.toArray().tolist()
    if len(bias) < len(families):  # no ordinary line: nothing speaks for unknown
        rows, bias = [[*w, 0.0] for w in rows], [*bias, 0.0]
    weights = {g: w for g, w in zip(vocabulary, rows, strict=True) if any(w)}
    unheard = Classifier(families, weights, bias, 0.0)
    held = examples.where("held").select(F.concat_ws("\n", "grams").alias("line"), "grams")
    bar = _scored(held, unheard).agg(F.percentile_approx("probability", 1 - FALSE_ALARMS, 10_000)).first()[0]
    return unheard._replace(bar=max(0.5, bar or 0.0))


def _scored(lines: DataFrame, model: Classifier) -> DataFrame:
    """``line, family, probability`` of the likeliest family but unknown, from ``line, grams``."""
    spark = lines.sparkSession
    k = len(model.families)
    table = spark.createDataFrame(list(model.weights.items()), "gram string, weights array<double>")
    sums = (
        lines.select("line", F.explode("grams").alias("gram"))
        .join(F.broadcast(table), "gram")
        .groupBy("line")
        .agg(*[F.sum(F.col("weights")[i]).alias(f"w{i}") for i in range(k)])
    )
    logits = [F.col(f"w{i}") + model.bias[i] for i in range(k)]
    odds = F.transform(F.array(*logits), lambda x: F.exp(x - F.greatest(*logits)))
    total = F.aggregate(odds, F.lit(0.0), lambda a, x: a + x)
    best = F.array_max(F.slice(odds, 1, k - 1))
    family = F.element_at(F.array(*map(F.lit, model.families)), F.array_position(odds, best).cast("int"))
    return sums.select("line", family.alias("family"), (best / total).alias("probability"))


def find_licences(docs: DataFrame, model: Classifier) -> DataFrame:
    """``doc_id, paragraph, line, family, probability, confirmed``: every paragraph that is not unknown.

    ``paragraph`` is the number of the line in its text, from 0.
    """
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("paragraph", "line"))
    pattern = model.pattern()
    if pattern:
        lines = lines.where(F.lower("line").rlike(pattern))
    lines = keep(lines, "lines")
    distinct = lines.select("line").distinct().withColumn("words", words(F.col("line")))
    scored = _scored(distinct.select("line", grams(F.col("words")).alias("grams")), model)
    named = scored.where((F.col("probability") > model.bar) & (F.col("probability") > 0.5))
    own = templates(docs.sparkSession).select(
        "family", F.array_distinct(words(F.col("template"))).alias("template"), _versions(F.col("template")).alias("versions")
    )
    word = F.array_distinct(words(F.col("line")))
    matches = _matches(word, F.col("template")) & (_told(word) == _told(F.col("template")))
    matches &= _versions(F.col("line")) == F.col("versions")
    confirmed = (
        named.join(F.broadcast(own), "family")
        .groupBy("line", "family", "probability")
        .agg(F.max(matches).alias("confirmed"))
    )
    return lines.join(keep(confirmed, "named"), "line").select(
        "doc_id", "paragraph", "line", "family", "probability", "confirmed"
    )

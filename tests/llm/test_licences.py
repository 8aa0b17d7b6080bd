import pytest
from awkward import awkward_rows, documents
from pyspark.sql import functions as F
from tabularium.llm import licences as c

ORDINARY = [
    "The weather was fine. We walked along the river and talked of this and that.",
    "Prices rose in the second quarter, the office said.\nNobody expected it at all.",
    "She put the book on the table and left the room without a word.",
    "A recipe for bread: flour, water, salt and time. Mix it and wait.",
] * 30


@pytest.fixture(scope="module")
def model(spark):
    return c.learn(documents(spark, ORDINARY))


def test_notices_are_found_and_confirmed(spark, model):
    texts = {
        "MIT": "Some text.\nReleased under the MIT License.\nMore text.",
        "Apache-2.0": "licensed under the Apache License, version 2.0",
        "GPL-3.0": "x\ny\nThis work is licensed under the GNU General Public License, version 3.",
        "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
        "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " provided that the following conditions are met:",
    }
    found = c.find_licences(documents(spark, list(texts.values())), model).collect()
    assert {r.doc_id: r.family for r in found if r.confirmed} == dict(enumerate(texts))
    lines = [t.split("\n") for t in texts.values()]
    assert all(lines[r.doc_id][r.paragraph] == r.line and 0.5 < r.probability <= 1 for r in found)


def test_ordinary_lines_are_unknown(spark, model):
    assert c.find_licences(documents(spark, ORDINARY), model).where("confirmed").collect() == []


def test_lines_that_the_pattern_leaves_out_are_unknown(spark, model):
    texts = [*ORDINARY[:4], "under the license", "free software", "the work is public", "a b c", "copy of the terms"]
    lines = documents(spark, texts).select(F.col("text").alias("line"), c.grams(c.words(F.col("text"))).alias("grams"))
    out = c._scored(lines.where(~F.lower("line").rlike(model.pattern())), model)
    assert out.where(F.col("probability") > 0.5).collect() == []
    assert model.telling() <= model.weights.keys()


def test_a_prediction_without_a_template_is_not_confirmed(spark, model):
    text = "mit license " + " ".join(f"w{k}" for k in range(40))
    found = c.find_licences(documents(spark, [text, "Released under the MIT License."]), model).collect()
    assert [r.doc_id for r in found if r.confirmed] == [1]


def test_awkward_rows(spark, model):
    docs = awkward_rows(spark)
    assert c.find_licences(docs, model).collect() == []
    assert c.find_licences(docs.limit(0), model).collect() == []
    notice = docs.limit(1).withColumn("text", F.lit("Licensed under CC BY-NC 4.0."))
    found = c.find_licences(notice.unionAll(notice).withColumn("doc_id", F.lit(None).cast("long")), model)
    assert [(r.doc_id, r.family) for r in found.collect()] == [(None, "CC-BY-NC-4.0")] * 2


def test_learning_from_no_text(spark):
    model = c.learn(documents(spark, []))
    found = c.find_licences(documents(spark, ["Released under the MIT License."]), model).collect()
    assert [r.family for r in found if r.confirmed] == ["MIT"]


LOOK_ALIKES = {
    "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0",
    "This work is licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0",
    "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
    "This work is licensed under the GNU General Public License, version 4.": None,
    "This project is not licensed under the terms of the MIT license.": None,
    "Licensed under the Mozilla Public License, version 1.1.": "MPL-1.1",
    "Licensed under the Apache License, Version 1.1.": "Apache-1.1",
    "Licensed under the Apache License, Version 1.0.": None,
    "Licensed under CC BY-NC-ND 4.0.": "CC-BY-NC-ND-4.0",
    "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
    "Licensed under CC BY-NC 3.0.": None,
    "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.":
    "CC-BY-NC-ND-4.0",
    "Licensed under the LGPL v2.1.": "LGPL-2.1",
    "Licensed under the LGPL v3.": "LGPL-3.0",
    "Licensed under the GPL version 3.0": "GPL-3.0",
    "licensed under the apache license version 2": "Apache-2.0",
    "Never released under the MIT License.": None,
}


def test_look_alikes_are_their_own_family_or_not_confirmed(spark, model):
    found = c.find_licences(documents(spark, list(LOOK_ALIKES)), model).where("confirmed").collect()
    assert {r.line: r.family for r in found} == {line: family for line, family in LOOK_ALIKES.items() if family}


def test_every_template_is_confirmed_as_its_family(spark, model):
    every = [(text, family) for family, texts in c.TEMPLATES.items() for text in texts]
    found = c.find_licences(documents(spark, [text for text, _ in every]), model).where("confirmed").collect()
    assert {r.line: r.family for r in found} == dict(every)

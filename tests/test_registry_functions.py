"""Ids, labels and dates."""

import random

import pytest
from pyspark.sql import functions as F
from tabularium.functions import branch_label, compact_date, full_id, status_label


def values(spark, items, type_, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {type_}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_full_id(spark):
    rows = spark.createDataFrame(
        [("32998915", "0001", "80"), (None, "0001", "80"), ("1", None, "80"), ("1", "2", None)],
        "a string, b string, c string",
    )
    ids = [r[0] for r in rows.select(full_id(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert ids == ["32998915000180", None, None, None]


def test_branch_label(spark):
    labels = values(spark, [1, 2, 0, None], "int", branch_label)
    assert labels == ["Matriz", "Filial", "Filial", "Filial"]


def test_status_label(spark):
    labels = values(spark, ["01", "02", "03", "04", "08", "2", "", None], "string", status_label)
    assert labels == ["Nula", "Ativa", "Suspensa", "Inapta"] + ["Baixada"] * 4


DATES = {
    "20190218": ("2019-02-18", "2019-02-18"),
    "00010101": ("0001-01-01", "0001-01-01"),
    "99990101": ("9999-01-01", "9999-01-01"),
    "20200229": ("2020-02-29", "2020-02-29"),
    "00000000": (None, None),
    "0": (None, None),
    "": (None, None),
    None: (None, None),
    "20190230": (None, None),
    "20191301": (None, None),
    "201902181": (None, None),
    "2019-2-1": (None, None),
    "00000218": (None, "0000-02-18"),
    "20190218xyz": ("2019-02-18", None),
    "20190218 ": ("2019-02-18", None),
    "20190218\nx": ("2019-02-18", None),
    "2019021": ("2019-02-01", None),
    "199706021": ("1997-06-21", None),
    " 20001013": (None, None),
    "+120190218": (None, None),
    "-20190218": (None, None),
}


@pytest.mark.parametrize("mode", ["legacy", "strict"])
def test_compact_date(spark, mode):
    dates = values(spark, DATES, "string", lambda c: compact_date(c, mode).cast("string"))
    assert dict(zip(DATES, dates)) == {k: v[mode == "strict"] for k, v in DATES.items()}


def test_compact_date_mode_is_checked():
    with pytest.raises(ValueError):
        compact_date(F, "lenient")


def ragged_texts():
    random.seed(11)
    for _ in range(20_000):
        text = f"{random.choice([random.randint(1600, 9999), 2000])}"
        text += f"{random.randint(0, 13):02d}{random.randint(0, 32):02d}"
        kind = random.random()
        if kind < 0.4:
            at = random.randrange(9)
            text = text[:at] + random.choice("0129x/T.") + text[at + random.randint(0, 1) :]
        elif kind < 0.7:
            text = text[: random.randint(0, 8)] + random.choice(["", "0", "00", "1", "a", "31", "000"])
        yield text


def test_compact_date_equals_the_legacy_parser_policy(spark):
    texts = spark.createDataFrame([(t,) for t in set(ragged_texts())], "s string")
    ours = {r[0]: r[1] for r in texts.select("s", compact_date(F.col("s")).cast("string")).collect()}
    settings = {"spark.sql.ansi.enabled": "false", "spark.sql.legacy.timeParserPolicy": "LEGACY"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        legacy = texts.select("s", F.to_date("s", "yyyyMMdd").cast("string")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert ours == {r[0]: r[1] for r in legacy}
    assert sum(v is not None for v in ours.values()) > 1000

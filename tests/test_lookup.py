"""Lookups: no match, NULL, repeats, and codes that hold most of the rows."""

import random

import pytest
from pyspark.sql import functions as F
from tabularium.operators import few_used, filter_activity, hot_codes, lookup, used_codes

FACTS = [(1, "00"), (2, "0"), (3, None), (4, "99"), (5, "00"), (6, None)]
CODES = [("00", "NONE"), ("01", "ONE"), (None, "NULL?")]


@pytest.fixture
def shuffled(spark):
    """Joins that are too large to broadcast or to end in one task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def tables(spark, codes=CODES):
    facts = spark.createDataFrame(FACTS, "id int, code string")
    return facts, spark.createDataFrame(codes, "codigo string, descricao string")


def found(df):
    assert df.columns == ["id", "code", "label"]
    return sorted((r.id, r.label) for r in df.collect())


EXPECTED = [(1, "NONE"), (2, None), (3, None), (4, None), (5, "NONE"), (6, None)]
HOT = [(), ("00",), (None,), ("00", None), ("99", "01", "zz")]


@pytest.mark.parametrize("hot", HOT)
def test_rows_stay_and_unmatched_are_null(spark, hot):
    assert found(lookup(*tables(spark), "code", "label", hot=hot)) == EXPECTED


@pytest.mark.parametrize("hot", HOT)
def test_same_when_shuffled(spark, shuffled, hot):
    assert found(lookup(*tables(spark), "code", "label", hot=hot, slices=3)) == EXPECTED


@pytest.mark.parametrize("hot", HOT)
def test_repeated_code_fans_out(spark, hot):
    twice = [*CODES, ("00", "NONE AGAIN")]
    rows = found(lookup(*tables(spark, twice), "code", "label", hot=hot, slices=3))
    assert rows.count((1, "NONE")) == rows.count((1, "NONE AGAIN")) == 1
    assert len(rows) == len(EXPECTED) + 2


def test_random_tables_against_brute_force(spark, shuffled):
    random.seed(2)
    letters = ["a", "b", "c", "d", None]
    facts = [(i, random.choices(letters, [20, 3, 1, 1, 10])[0]) for i in range(500)]
    codes = [(random.choice(letters), str(i)) for i in range(12)]
    expected = sorted(
        (i, label)
        for i, code in facts
        for label in [d for c, d in codes if c == code and code is not None] or [None]
    )
    tables = (
        spark.createDataFrame(facts, "id int, code string").repartition(5),
        spark.createDataFrame(codes, "codigo string, descricao string"),
    )
    hot = hot_codes(tables[0], "code", 0.1)
    assert set(hot) == {"a", None}
    for chosen in ((), hot):
        rows = lookup(*tables, "code", "label", hot=chosen, slices=5).collect()
        assert sorted(((r.id, r.label) for r in rows), key=str) == sorted(expected, key=str)


def test_label_may_be_the_code_column_of_another_lookup(spark):
    facts, codes = tables(spark)
    twice = lookup(lookup(facts, codes, "code", "a"), codes, "code", "b")
    assert twice.filter("a = 'NONE' and b = 'NONE'").count() == 2


def skewed(spark):
    code = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None))
    return spark.range(90_000).withColumn("code", code.otherwise(F.col("id").cast("string")))


def test_hot_codes_finds_large_shares(spark):
    assert set(hot_codes(skewed(spark), "code")) == {"hot", None}
    assert hot_codes(skewed(spark).limit(0), "code") == []


def test_hot_rows_spread_over_tasks(spark, shuffled):
    facts = skewed(spark)
    codes = spark.createDataFrame([("hot", "H"), ("2", "two")], "codigo string, descricao string")
    spread = lookup(facts, codes, "code", "label", hot=hot_codes(facts, "code"))
    tasks = spread.groupBy("label", F.spark_partition_id().alias("task")).count()
    rows = tasks.collect()
    assert sum(r["count"] for r in rows if r.label == "H") == 30_000
    assert sum(r["count"] for r in rows if r.label == "two") == 1
    assert sum(r["count"] for r in rows) == 90_000
    assert max(r["count"] for r in rows) < 15_000


def test_without_hot_codes_spark_splits_the_skewed_partition(spark, shuffled):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        codes = spark.createDataFrame([("hot", "H"), ("2", "two")], "codigo string, descricao string")
        facts = skewed(spark).repartition(8)
        joined = lookup(facts, codes, "code", "label")
        assert sum(r.label == "H" for r in joined.collect()) == 30_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_used_codes(spark):
    facts, codes = tables(spark, [*CODES, ("00", "AGAIN")])
    assert sorted(tuple(r) for r in used_codes(facts, codes, "code").collect()) == [
        ("00", "AGAIN"),
        ("00", "NONE"),
    ]


def test_used_codes_are_all_that_a_lookup_needs(spark):
    facts, codes = tables(spark)
    used = used_codes(facts, codes, "code")
    assert used.columns == codes.columns and used.count() == 1
    assert found(lookup(facts, used, "code", "label")) == EXPECTED
    assert used_codes(facts, codes.limit(0), "code").count() == 0


def test_few_codes_in_use_need_no_shuffle_of_the_facts(spark, shuffled):
    facts = spark.createDataFrame([(k, str(k % 3)) for k in range(50)] + [(50, None), (51, "none")], "id int, code string")
    codes = spark.createDataFrame([(str(k), f"d{k}") for k in (*range(40), 1)] + [(None, "x")], "codigo string, descricao string")
    plain = lookup(facts, codes, "code", "label")
    joined = lookup(facts, few_used(facts, codes, "code", few=10), "code", "label")
    assert sorted(map(str, joined.collect())) == sorted(map(str, plain.collect()))
    assert len(joined.collect()) == 52 + 17
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_small_tables_and_many_codes_in_use_stay_as_they_are(spark):
    facts, codes = tables(spark)
    assert few_used(facts, codes, "code", few=3) is codes
    every = codes.select(F.col("codigo").alias("code"))
    assert few_used(every, codes, "code", few=1) is codes


def test_rows_without_a_code_are_spread_unasked(spark, shuffled):
    codes = spark.createDataFrame([("2", "two")], "codigo string, descricao string")
    joined = lookup(skewed(spark).where("code is null or code = '2'"), codes, "code", "label")
    rows = joined.groupBy("label", F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in rows) == 30_001
    assert max(r["count"] for r in rows) < 15_000


def test_shares_out_of_range_are_refused(spark):
    with pytest.raises(ValueError):
        hot_codes(skewed(spark), "code", 1e-6)


def test_filter_activity(spark):
    facts = spark.createDataFrame([("8630504",), ("1",), (None,)], "cd_cnae_fiscal string")
    assert filter_activity(facts).count() == 1
    assert filter_activity(facts, ["1", "8630504"]).count() == 2
    assert filter_activity(facts, []).count() == 0

import os

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tabularium.llm import components, tables


def test_released_tables_are_gone_and_others_stay(spark):
    one, two = (tables.keep(spark.range(5), "test") for _ in range(2))
    folders = [frame._kept_at for frame in (one, two)]
    tables.release(one)
    tables.release(one)  # once more does nothing
    assert [os.path.exists(f) for f in folders] == [False, True]
    assert two.count() == 5
    begin = tables.mark()
    three, four = (tables.keep(spark.range(2), "test") for _ in range(2))
    folder = three._kept_at
    tables.release_since(spark, begin, four)
    assert not os.path.exists(folder) and four.count() == 2 and two.count() == 5
    tables.release(two, four)
    assert tables.mark() == begin - 1


def test_components_keep_their_last_table_only(spark):
    begin = tables.mark()
    links = spark.range(20).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = components.components(links)
    assert tables.mark() - begin <= 2
    assert {r.component for r in found.collect()} == {0} and found.count() == 21


def test_a_stage_leaves_its_result_only(spark, tmp_path, monkeypatch):
    def stage(spark, docs, sf_dir):
        return tables.keep(docs.where("doc_id > 1"), "within").where("doc_id < 8")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", stage), ("two", stage)])
    spark.range(10).withColumnRenamed("id", "doc_id").write.parquet(f"{tmp_path}/documents.parquet")
    begin = tables.mark()
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert tables.mark() == begin + 1
    assert sorted(r.doc_id for r in out.collect()) == list(range(2, 8))


def test_a_table_that_is_gone_is_not_read(spark):
    kept = tables.keep(spark.range(3), "test")
    tables.release(kept)
    with pytest.raises(Exception, match="(?i)does not exist|not.found"):
        kept.count()

"""Tables published by versions, laid out for readers that filter, and counted as they are written."""

import os
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tabularium.__main__ import main
from tabularium.checks import inputs
from tabularium.layouts import ESTABLISHMENTS
from tabularium.operators import Counts
from tabularium.plans import load_silver, silver_from_folder
from tabularium.sources import (
    current_version,
    publish,
    publish_silver,
    read_entity,
    read_silver,
    vacuum,
    versions,
    write_silver,
)

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def silver(spark):
    return silver_from_folder(spark, inputs.raw_folder(spark, SF_DIR))


def failing(frame):
    """The rows, of which one fails its task when it is written; others are written before."""
    bad = F.raise_error(F.lit("planted failure")).cast("string")
    return frame.repartition(4).withColumn("uf", F.when(F.col("cep") == "00000007", bad).otherwise(F.col("uf")))


def test_a_failed_publish_leaves_the_table_as_it_was(spark, silver, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(Exception, match="planted failure"):
        publish_silver(failing(silver), path)
    assert current_version(spark, path) is None
    first = publish_silver(silver.where("uf = 'BA'"), path)
    rows = read_silver(spark, path).count()
    begun = read_silver(spark, path)
    with pytest.raises(Exception, match="planted failure"):
        publish_silver(failing(silver), path)
    assert current_version(spark, path) == first
    assert read_silver(spark, path).count() == rows > 0
    # nothing of the failed version is left
    assert sorted(os.listdir(path)) == sorted([Path(first).name, "_current", "._current.crc"])
    publish_silver(silver, path)
    assert read_silver(spark, path).count() == 1500
    assert begun.count() == rows  # a job that began before can end


def test_old_versions_go_after_the_commit(spark, silver, tmp_path):
    path = str(tmp_path / "table")
    one_row = silver.limit(1)
    made = [publish_silver(one_row, path, retain=2) for _ in range(4)]
    assert versions(spark, path) == made[:1:-1]
    assert sorted(n for n in os.listdir(path) if n.startswith("version")) == sorted(Path(m).name for m in made[2:])
    assert publish_silver(one_row, path, retain=1) == current_version(spark, path)
    assert len(versions(spark, path)) == 1
    with pytest.raises(ValueError):
        publish_silver(one_row, path, retain=0)


def test_killed_publishers_leave_what_vacuum_deletes(spark, silver, tmp_path):
    path = str(tmp_path / "table")
    kept = publish_silver(silver.limit(1), path)
    silver.limit(1).write.parquet(f"{path}/version-19990101T000000-killed")
    assert vacuum(spark, path) == ["version-19990101T000000-killed"]
    assert vacuum(spark, path) == []
    assert current_version(spark, path) == kept
    assert read_silver(spark, path).count() == 1
    assert vacuum(spark, str(tmp_path / "none")) == []


def test_plain_and_published_tables_are_not_mixed(spark, silver, tmp_path):
    plain, published = str(tmp_path / "plain"), str(tmp_path / "published")
    write_silver(silver.limit(1), plain)
    publish_silver(silver.limit(1), published)
    with pytest.raises(ValueError, match="not published"):
        publish_silver(silver, plain)
    with pytest.raises(ValueError, match="published by versions"):
        write_silver(silver, published)
    assert read_silver(spark, plain).count() == read_silver(spark, published).count() == 1


def test_any_writer_can_publish(spark, tmp_path):
    path = str(tmp_path / "numbers")
    publish(spark, path, lambda folder: spark.range(3).write.json(folder))
    publish(spark, path, lambda folder: spark.range(5).write.json(folder))
    assert spark.read.json(current_version(spark, path)).count() == 5


def row_groups(path):
    """Of each row group of a table: its number of rows, and ranges by column."""
    for file in Path(path).rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for k in range(meta.num_row_groups):
            group = meta.row_group(k)
            columns = [group.column(c) for c in range(group.num_columns)]
            yield file, group.num_rows, {
                c.path_in_schema: (c.statistics.min, c.statistics.max) for c in columns if c.statistics and c.statistics.has_min_max
            }


def test_clustered_rows_let_readers_skip_row_groups(spark, tmp_path):
    silver = silver_from_folder(spark, inputs.raw_folder(spark, "/root/testdata/sf0.01"))
    silver = silver.repartition(4, "cep").sortWithinPartitions(F.md5("cep"))
    path, plain = str(tmp_path / "clustered"), str(tmp_path / "plain")
    write_silver(silver, path, by="uf", cluster=["cd_cnae_fiscal"], blooms=["cep"], row_group_bytes=20_000)
    write_silver(silver, plain, row_group_bytes=20_000)
    low, high = "0000100", "0000140"

    def read(groups):
        groups = list(groups)
        return [g for g in groups if g[2]["cd_cnae_fiscal"][0] <= high and g[2]["cd_cnae_fiscal"][1] >= low], groups

    hit, every = read(row_groups(path))
    assert len(every) >= 50 and len(hit) < 0.1 * len(every)
    hit, every = read(row_groups(plain))
    assert len(hit) > 0.9 * len(every)  # in no order, any row group may hold them
    wanted = read_silver(spark, path).where(F.col("cd_cnae_fiscal").between(low, high))
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(cd_cnae_fiscal), GreaterThanOrEqual(cd_cnae_fiscal" in plan
    assert wanted.count() == silver.where(F.col("cd_cnae_fiscal").between(low, high)).count() > 0
    assert read_silver(spark, path).where("uf = 'SP' and cep = '00000001'").count() == 1


def test_a_hot_activity_is_several_ranges(spark, silver, tmp_path):
    path = str(tmp_path / "hot")
    hot = silver.withColumn("cd_cnae_fiscal", F.lit("8630504"))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"  # it would join ranges of so few rows
    spark.conf.set(coalesce, "false")
    try:
        write_silver(hot, path, cluster=["cd_cnae_fiscal"])
    finally:
        spark.conf.unset(coalesce)
    sizes = [rows for _, rows, _ in row_groups(path)]
    assert sum(sizes) == 1500 and len(sizes) > 2 and max(sizes) < 1500 / 2


@pytest.mark.parametrize("options", [{"cluster": ["unknown"]}, {"blooms": ["unknown"]}, {"by": "unknown"}])
def test_unknown_columns_are_refused(silver, tmp_path, options):
    with pytest.raises(ValueError, match="unknown"):
        write_silver(silver, str(tmp_path / "table"), **options)


def test_bloom_filters_are_written(spark, silver, tmp_path):
    with_blooms, without = str(tmp_path / "with"), str(tmp_path / "without")
    write_silver(silver.coalesce(1), with_blooms, blooms=["cnpj"])
    write_silver(silver.coalesce(1), without)
    size = [sum(f.stat().st_size for f in Path(p).glob("*.parquet")) for p in (with_blooms, without)]
    assert size[0] > size[1] + 100_000


def test_counts_come_from_the_scan_that_writes(spark, tmp_path):
    raw, path, counts = inputs.raw_folder(spark, SF_DIR), str(tmp_path / "silver"), str(tmp_path / "counts")
    found = load_silver(spark, raw, path, counts=counts, retain=1, layout={"by": "uf"}, only_activities=["0000004", "0000400"])
    assert {r.name: r.n for r in spark.read.parquet(counts).collect()} == found
    table = read_silver(spark, path)
    assert found["rows_read"] == 1500
    assert found["rows_written"] == table.count() > 0
    assert table.where("cnae_fiscal is not null").count() > 0
    assert found["unmatched_cd_cnae_fiscal"] == table.where("cnae_fiscal is null").count() > 0
    assert load_silver(spark, raw, str(tmp_path / "uncounted")) is None


def test_counters_add_no_scan_and_no_shuffle(spark):
    facts = read_entity(spark, inputs.raw_folder(spark, SF_DIR), ESTABLISHMENTS)
    counts = Counts({"cd_cnae_fiscal": "uf"})
    plan = counts.written(counts.read(facts))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_jobs_publish_and_count(spark, tmp_path):
    raw, path, counts = inputs.raw_folder(spark, SF_DIR), str(tmp_path / "silver"), str(tmp_path / "counts")
    options = ["--retain", "1", "--counts", counts, "--by", "uf", "--cluster", "cd_cnae_fiscal", "--blooms", "cnpj"]
    for _ in range(2):
        assert main(["transform", raw, path, *options], spark) == 0
    assert len(versions(spark, path)) == 1
    assert read_silver(spark, path).count() == 1500
    assert spark.read.parquet(counts).where("name = 'rows_written'").first().n == 1500

"""Inputs that grow: no file of theirs, and no task that writes one, grows with them."""

import datetime

import pytest
from pyspark.sql import functions as F
from tabularium.checks import inputs
from tabularium.sources import archived_lines, list_archives, read_members


@pytest.fixture
def tables(spark, tmp_path):
    """A hundred orders, one of them without a customer and one twice."""
    orders = spark.range(100).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") != 7, F.col("id") % 9).alias("o_custkey"),
        F.lit(datetime.datetime(2020, 1, 2)).alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority"),
    )
    orders = orders.unionAll(orders.where("o_orderkey = 3"))
    customers = spark.range(9).select(F.col("id").alias("c_custkey"), F.concat(F.lit("C"), "id").alias("c_name"))
    nations = spark.createDataFrame([(0, "BRAZIL")], "n_nationkey long, n_name string")
    parts = spark.createDataFrame([(0, "bolt")], "p_partkey long, p_name string")
    for name, table in {"orders": orders, "customer": customers, "nation": nations, "part": parts}.items():
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def lines(spark, folder, **options):
    return sorted(row.line for row in archived_lines(read_members(spark, folder, ["Estabelecimentos"], **options)).collect())


def test_a_larger_table_has_more_archives(spark, tables, monkeypatch):
    monkeypatch.setattr(inputs, "ARCHIVE_ROWS", 10, raising=False)
    folder = inputs.archive_folder(spark, tables)
    archives = {row.entity: row["count"] for row in list_archives(spark, folder).groupBy("entity").count().collect()}
    assert archives == {"Estabelecimentos": 11, "Motivos": 4, "Cnaes": 4}
    assert len(lines(spark, folder)) == 101 and len(set(lines(spark, folder))) == 100

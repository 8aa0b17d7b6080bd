"""The silver table on disk."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tabularium.layouts import DOCUMENTED_SILVER, SILVER
from tabularium.operators.counts import Counts
from tabularium.sources.versions import current_version, publish


def write_silver(
    silver: DataFrame,
    path: str,
    by: str | None = None,
    cluster: Iterable[str] = (),
    blooms: Iterable[str] = (),
    row_group_bytes: int | None = None,
    counts: Counts | None = None,
) -> None:
    """Write Parquet, replacing the whole of ``path``.

    Without ``by`` and ``cluster`` each task writes what it read and nothing is shuffled. With ``by``,
    such as ``uf``, the rows are first brought together by that column; the rebalance lets Spark split a
    value that holds a large share of the rows over several tasks, and join small ones.

    ``cluster`` names columns, such as ``cd_cnae_fiscal``, that readers filter by: rows are dealt out in
    ranges of ``by`` and these, and sorted in each file, so that the statistics of row groups
    (``row_group_bytes`` each) let a reader skip most of them. The id comes last in the order, so that a value
    which holds a large share of the rows is several ranges and not one task. ``blooms`` names columns that
    get Bloom filters, for single values of a column that the rows are not in order of, such as ``cnpj``.

    ``counts`` are gathered from the rows as they are written.

    Read such a table with ``read_silver``: Spark moves the column to the end and takes codes made
    of digits for numbers unless it is told the schema. A table that is published by versions is replaced with
    ``publish_silver``; here it is an error.
    """
    cluster, blooms = list(cluster), list(blooms)
    for name in (*([by] if by else []), *cluster, *blooms):
        if name not in silver.columns:
            raise ValueError(f"no column {name}")
    if current_version(silver.sparkSession, path) is not None:
        raise ValueError(f"{path} is published by versions")
    if cluster:
        order = list(dict.fromkeys([*([by] if by else []), *cluster]))
        tie = ["cnpj"] if "cnpj" in silver.columns and "cnpj" not in order else []
        silver = silver.repartitionByRange(*order, *tie).sortWithinPartitions(*order, *tie)
    elif by is not None:
        silver = silver.hint("rebalance", by)
    if counts is not None:
        silver = counts.written(silver)
    writer = silver.write.mode("overwrite")
    if by is not None:
        writer = writer.partitionBy(by)
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", row_group_bytes)
    for name in blooms:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    writer.parquet(path)


def publish_silver(silver: DataFrame, path: str, retain: int = 2, **options) -> str:
    """``write_silver`` as a new version of the table at ``path``; its folder.

    Until the version is whole, and if its job fails, readers have the one before.
    """
    return publish(
        silver.sparkSession, path, lambda folder: write_silver(silver, folder, **options), retain
    )


def read_silver(spark: SparkSession, path: str, documented: bool = False) -> DataFrame:
    """The silver table, its columns in their order and of their types, however it was partitioned.

    Of a table that is published by versions, the current one.
    """
    schema = DOCUMENTED_SILVER if documented else SILVER
    folder = current_version(spark, path) or path
    return spark.read.schema(schema).parquet(folder).select(schema.names)

"""Headerless delimited files under an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tabularium.layouts import FIELD_SEPARATOR


def read_delimited(
    spark: SparkSession,
    paths: str | list[str],
    schema: StructType,
    encoding: str = "UTF-8",
    escape: str = "\\",
    recursive: bool = False,
) -> DataFrame:
    """Read one or many files or folders as one table, fields bound by position.

    Nothing fails on a bad row: a bad integer or a missing field is NULL, extra fields are dropped,
    and empty values, quoted or not, are NULL. A line break always ends the row, even in quotes,
    which is what lets Spark split large files. ``escape='"'`` reads doubled quotes. Files in
    subfolders are read only with ``recursive``.
    """
    return spark.read.csv(
        paths,
        schema=schema,
        sep=FIELD_SEPARATOR,
        header=False,
        encoding=encoding,
        escape=escape,
        recursiveFileLookup=recursive,
    )

"""Which encoding a file is in, by the evidence of its bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tabularium.sources.delimited import read_delimited


def file_encodings(
    spark: SparkSession, paths: str | list[str], other: str = "ISO-8859-1", recursive: bool = False
) -> DataFrame:
    """One row per file: ``path``, ``lines``, ``accented``, ``broken`` and ``encoding``.

    ``accented`` counts lines beyond ASCII that are well-formed UTF-8, ``broken`` those that are not UTF-8. Text of
    another encoding is hardly ever well-formed by chance, so a file is taken for UTF-8 unless it has more broken
    lines than accented ones; then it is in ``other``, in which all bytes are characters. A file of ASCII
    is the same in both. One scan, and one row a file and task in the shuffle; empty files have no row.
    """
    lines = spark.read.text(paths, recursiveFileLookup=recursive)
    valid = F.is_valid_utf8("value")
    beyond = F.octet_length("value") > F.char_length("value")
    counted = lines.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count("*").alias("lines"),
        F.count_if(valid & beyond).alias("accented"),
        F.count_if(~valid).alias("broken"),
    )
    return counted.withColumn("encoding", F.when(F.col("broken") > F.col("accented"), other).otherwise("UTF-8"))


def read_mixed(
    spark: SparkSession,
    paths: str | list[str],
    schema: StructType,
    other: str = "ISO-8859-1",
    recursive: bool = False,
    **options,
) -> DataFrame:
    """``read_delimited`` over files of which some are in UTF-8 and some in ``other``, each read in its own.

    The files are read once to tell their encodings; names of files come to the driver, as they do in a listing.
    """
    found = file_encodings(spark, paths, other, recursive).select("path", "encoding").collect()
    by_encoding: dict[str, list[str]] = {}
    for row in sorted(found):
        by_encoding.setdefault(row.encoding, []).append(_as_path(spark, row.path))
    tables = [
        read_delimited(spark, files, schema, encoding, **options) for encoding, files in sorted(by_encoding.items())
    ]
    if not tables:
        return spark.createDataFrame([], schema)
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table)
    return whole


def _as_path(spark: SparkSession, uri: str) -> str:
    """A file's URI as a path that means it alone: without escapes, and with what would be a pattern escaped."""
    plain = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in plain)

"""Files as rows: names of what has landed, and saved listing pages."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabularium.functions.links import file_name


def list_files(spark: SparkSession, folder: str, glob: str = "*.zip") -> DataFrame:
    """One row per matching file of a folder: ``path``, ``file_name`` and ``bytes``.

    Contents are not read, nor are subfolders, which may hold what was extracted. No match gives
    no rows; a missing folder is an error. Files without any bytes are left out, as not having landed
    (see ``empty_files``).
    """
    found = _load(spark, folder, glob)
    if found is None:
        found = spark.createDataFrame([], "path string, length long")
    return found.select(
        "path", file_name(F.col("path")).alias("file_name"), F.col("length").alias("bytes")
    )


def _load(spark: SparkSession, folder: str, glob: str) -> DataFrame | None:
    try:
        return spark.read.format("binaryFile").load(f"{folder}/{glob}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND" or not exists(spark, folder):
            raise
        return None


def empty_files(spark: SparkSession, folder: str, glob: str = "*.zip") -> list[str]:
    """The names of a folder's matching files that have no bytes; Spark's scans pass them over."""
    found = _load(spark, folder, glob)
    if found is None:
        return []
    listed = {unquote(path.rsplit("/", 1)[1]) for path in found.inputFiles()}
    read = {row.path.rsplit("/", 1)[1] for row in found.select("path").collect()}
    return sorted(listed - read)


def file_system(spark: SparkSession, path: str):
    """The file system of a path as Spark sees it, and the path on it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder; one look, without listing anything."""
    system, at = file_system(spark, path)
    return system.exists(at)


def read_pages(spark: SparkSession, folder: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """One row per saved page: ``path`` and ``html``; in subfolders only with ``recursive``."""
    pages = spark.read.option("pathGlobFilter", glob).text(folder, wholetext=True, recursiveFileLookup=recursive)
    return pages.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))

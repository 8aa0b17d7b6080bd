"""Tables written between steps, in the folder that the cluster shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabularium.checks.scratch import new_folder

#: Folders of tables that are there, in the order they were written.
_kept: list[str] = []


def keep(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written below ``spark.checkpoint.dir`` and read again.

    It cuts the lineage, so a lost executor costs tasks of the present step only; and a join of
    what is read can be split where a key is hot, which a join of an aggregate cannot.
    """
    spark = frame.sparkSession
    folder = new_folder(spark, name)
    _kept.append(folder)
    frame.write.option("compression", "zstd").parquet(folder)
    kept = spark.read.schema(frame.schema).parquet(folder)
    kept._kept_at = folder
    return kept


def release(*kept: DataFrame) -> None:
    """Delete what ``keep`` wrote, once nothing reads it any more; other frames stay as they are."""
    for frame in kept:
        folder = frame.__dict__.pop("_kept_at", None)
        if folder is not None:
            _delete(frame.sparkSession, folder)


def mark() -> int:
    """A mark for :func:`release_since`."""
    return len(_kept)


def release_since(spark: SparkSession, mark: int, but: DataFrame | None = None) -> None:
    """Delete all tables written after a mark but one: those of steps whose result has been written.

    With 0 and without ``but`` that is all a session has written, for the end of a job.
    """
    spared = None if but is None else but.__dict__.get("_kept_at")
    for folder in [folder for folder in _kept[mark:] if folder != spared]:
        _delete(spark, folder)


def _delete(spark: SparkSession, folder: str) -> None:
    if folder in _kept:
        _kept.remove(folder)
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)

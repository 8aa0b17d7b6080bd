"""Is everything there that was asked for?"""

from __future__ import annotations

from pyspark.sql import DataFrame


def missing_files(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """The manifest rows whose ``file_name`` has not landed; none means the load is complete.

    Landed names are made distinct first, which Spark does before the shuffle, so a name that
    landed many times costs one row.
    """
    return manifest.join(landed.select("file_name").distinct(), "file_name", "left_anti")


def is_complete(manifest: DataFrame, landed: DataFrame) -> bool:
    """Whether every file of the manifest has landed; publish only then."""
    return missing_files(manifest, landed).isEmpty()

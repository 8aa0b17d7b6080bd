"""Counts of rows, gathered while they are written, without a scan of their own."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, functions as F


class Counts:
    """How many rows a load read and wrote, and how many found no description, by lookup.

    ``read`` and ``written`` put counters into the plan; the job that writes the rows fills them. They are the
    tasks' own counts, summed up by Spark, so they cost no shuffle. A filter on the rows is not moved below
    the counter of rows read, which therefore counts all rows of the source.
    """

    def __init__(self, lookups: Mapping[str, str] | None = None):
        """``lookups``: label columns by the code columns that they describe."""
        self.lookups = dict(lookups or {})
        self._read, self._written = Observation(), Observation()

    def read(self, rows: DataFrame) -> DataFrame:
        return rows.observe(self._read, F.count("*").alias("rows_read"))

    def written(self, rows: DataFrame) -> DataFrame:
        unmatched = [
            F.count_if(F.col(code).isNotNull() & F.col(label).isNull()).alias(f"unmatched_{code}")
            for code, label in self.lookups.items()
        ]
        return rows.observe(self._written, F.count("*").alias("rows_written"), *unmatched)

    def get(self) -> dict[str, int]:
        """The counts by name, once the rows are written: ``rows_read``, ``rows_written``, ``unmatched_<code>``."""
        return {**self._read.get, **self._written.get}

    def table(self, spark) -> DataFrame:
        """The counts as rows: ``name``, ``n``."""
        return spark.createDataFrame(sorted(self.get().items()), "name string, n long")

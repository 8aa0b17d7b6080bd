"""Where queries may write: a new folder below the one that the cluster shares."""

from __future__ import annotations

import atexit
import functools
import itertools
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

_RUN = uuid.uuid4().hex
_numbers = itertools.count()
_written: dict[tuple[str, ...], str] = {}


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only where Spark is known to run on one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", None) or ""
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_root()


@functools.cache
def _local_root() -> str:
    """A folder of this machine, which goes when the process ends."""
    folder = tempfile.mkdtemp(prefix="tabularium-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder that does not exist yet; those of one process are below one folder."""
    return f"{shared_root(spark)}/tabularium-{_RUN}/{name}-{next(_numbers)}"


def written_once(
    spark: SparkSession, name: str, source: str, write: Callable[[str], None]
) -> str:
    """The folder that ``write`` fills for this source on first use in this process."""
    key = (shared_root(spark), source, name)
    if key not in _written:
        folder = new_folder(spark, name)
        write(folder)
        _written[key] = folder
    return _written[key]

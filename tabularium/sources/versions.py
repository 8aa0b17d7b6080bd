"""Tables that are replaced as a whole, without a moment in which they are not there.

Each version is a folder of its own below the table's path. One small file, ``_current``, names the
versions, the one that counts first. It is written aside and renamed over the old one, which file
systems do in one step; so a reader finds the version before or the one after, and a job that fails
leaves the table as it was. Files below a name with an underscore are no data to Spark.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from tabularium.sources.files import file_system

POINTER = "_current"


def versions(spark: SparkSession, path: str) -> list[str]:
    """The folders of a table's versions, the current one first; none if it was never published."""
    system, at = file_system(spark, f"{path}/{POINTER}")
    if not system.exists(at):
        return []
    stream = system.open(at)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return [f"{path}/{name}" for name in text.split()]


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder to read, or None if the table has no versions."""
    return next(iter(versions(spark, path)), None)


def publish(
    spark: SparkSession, path: str, write: Callable[[str], None], retain: int = 2
) -> str:
    """Have ``write`` fill the folder of a new version, then make it the current one; its folder.

    If ``write`` fails, its folder is deleted and the table is as before. After the commit the
    ``retain`` newest versions are kept, so that jobs that have begun to read the one before can end.
    One job publishes a table at a time; of two the last to commit counts. A path that holds data of
    another kind is an error.
    """
    if retain < 1:
        raise ValueError("the current version is always retained")
    _refuse_other_data(spark, path)
    stamp = datetime.datetime.now(datetime.UTC).strftime("%Y%m%dT%H%M%S")
    folder = f"{path}/version-{stamp}-{uuid.uuid4().hex[:12]}"
    try:
        write(folder)
    except BaseException:
        _delete(spark, folder)
        raise
    kept = [folder, *versions(spark, path)]
    _replace(spark, f"{path}/{POINTER}", "\n".join(name.rsplit("/", 1)[1] for name in kept[:retain]))
    for old in kept[retain:]:
        _delete(spark, old)
    return folder


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Delete what publishers that were killed have left, and say what; not while one is at work."""
    system, at = file_system(spark, path)
    named = {folder.rsplit("/", 1)[1] for folder in versions(spark, path)}
    left = [name for name in _names(system, at) if name not in named and name != POINTER]
    left = [name for name in left if name.startswith(("version-", f"{POINTER}."))]
    for name in left:
        _delete(spark, f"{path}/{name}")
    return sorted(left)


def _names(system, at) -> list[str]:
    return [status.getPath().getName() for status in system.listStatus(at)] if system.exists(at) else []


def _refuse_other_data(spark: SparkSession, path: str) -> None:
    system, at = file_system(spark, path)
    other = [name for name in _names(system, at) if not name.startswith(("version-", "_", "."))]
    if other:
        raise ValueError(f"{path} holds a table that was not published: {other[0]}")


def _delete(spark: SparkSession, path: str) -> None:
    system, at = file_system(spark, path)
    system.delete(at, True)


def _replace(spark: SparkSession, path: str, text: str) -> None:
    """Give a file new content in one step."""
    jvm = spark._jvm
    system, at = file_system(spark, path)
    _, aside = file_system(spark, f"{path}.{uuid.uuid4().hex}")
    stream = system.create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    configuration = spark._jsparkSession.sessionState().newHadoopConf()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), configuration)
    context.rename(aside, at, options)

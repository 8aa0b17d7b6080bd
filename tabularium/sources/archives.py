"""ZIP archives of entity files.

A ZIP member can only be read from its start, so a member is the unit of work: members are listed
first, then dealt out over tasks, so that one large archive does not keep all of its members in one
task. Python hands over blocks of bytes that end at a line break; splitting, decoding and parsing
are done by Spark.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import sys
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabularium.functions.links import entity_name, file_name
from tabularium.layouts import FIELD_SEPARATOR, Entity
from tabularium.sources.files import empty_files, list_files

BLOCK_BYTES = 1 << 20
# Fixed value: the bytes of an archive without members.
_NO_MEMBERS = b"PK\x05\x06" + bytes(18)
LINE_BYTES = 256 << 20
#: Extracted bytes to a task, where there are more than the session's own tasks would take.
TASK_BYTES = 128 << 20
# A line of nothing else is blank to the reader of delimited files.
_BLANKS = "".join(map(chr, range(33)))

# The functions that run in tasks travel with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """The Arrow file system of a path or URI as Spark writes it, and the path on it."""
    scheme, _, rest = path.partition(":")
    if not rest or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest or path).lstrip("/")
    authority, _, name = rest.removeprefix("//").partition("/")
    system, root = fs.FileSystem.from_uri(f"{scheme.replace('s3a', 's3')}://{authority}/")
    return system, f"{root.rstrip('/')}/{name}"


def open_file(path: str) -> pa.NativeFile:
    """Open a file for random access."""
    system, name = locate(path)
    return system.open_input_file(name)


def _files_of(name: str) -> list[tuple[int, zipfile.ZipInfo]]:
    """The files that an archive's directory lists, by their number in it."""
    with open_file(name) as source:
        # without members an archive is its end record; readers look before it, where Arrow does not seek
        if source.size() == len(_NO_MEMBERS) and source.read() == _NO_MEMBERS:
            return []
        source.seek(0)
        with zipfile.ZipFile(source) as archive:
            return [(n, i) for n, i in enumerate(archive.infolist()) if not i.is_dir()]


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            members = [i for _, i in _files_of(row["archive"])]
            yield pa.RecordBatch.from_pydict(
                {
                    "archive": pa.array([row["archive"]] * len(members), pa.string()),
                    "entity": pa.array([row["entity"]] * len(members), pa.string()),
                    "member": pa.array([i.filename for i in members], pa.string()),
                    "bytes": pa.array([i.file_size for i in members], pa.int64()),
                    "crc": pa.array([i.CRC for i in members], pa.int64()),
                }
            )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            digest = hashlib.sha256()
            with (
                open_file(row["archive"]) as source,
                zipfile.ZipFile(source) as archive,
                archive.open(row["member"]) as member,
            ):
                while block := member.read(BLOCK_BYTES):
                    digest.update(block)
            row["digest"] = digest.hexdigest()
            yield pa.RecordBatch.from_pylist([row])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            with (
                open_file(row["archive"]) as source,
                zipfile.ZipFile(source) as archive,
                archive.open(row["member"]) as member,
            ):
                for number, block in enumerate(_whole_lines(member)):
                    yield pa.RecordBatch.from_pydict(
                        {
                            **{name: pa.array([row[name]], pa.string()) for name in row},
                            "block_no": pa.array([number], pa.int64()),
                            "block": pa.array([block], pa.binary()),
                        }
                    )


def _whole_lines(stream) -> Iterator[bytes]:
    """Cut a byte stream into blocks at line breaks, leaving out the break at each cut.

    Carriage returns end lines, as they do for Spark's reader; of a pair of both the line feed is the
    break. A byte order mark, which a reader would drop from the start of a file, is dropped here: after
    extraction the member may no longer start one. A line of more than ``LINE_BYTES`` is an error:
    it could not be cut without becoming two.
    """
    pending: list[bytes] = []
    held = 0
    chunk = stream.read(BLOCK_BYTES).removeprefix(codecs.BOM_UTF8)
    while chunk:
        following = stream.read(BLOCK_BYTES)
        # The last byte may be the first of a pair; the pair is then cut as one.
        if chunk.endswith(b"\r") and following.startswith(b"\n"):
            chunk, following = chunk + b"\n", following[1:] or stream.read(BLOCK_BYTES)
        at = max(chunk.rfind(b"\n"), chunk.rfind(b"\r"))
        if at >= 0:
            yield b"".join([*pending, chunk[:at]])
            pending, held = [], 0
        tail = chunk[at + 1 :]
        if tail:
            pending.append(tail)
            held += len(tail)
        if held > LINE_BYTES:
            raise ValueError(f"a line is longer than {LINE_BYTES} bytes")
        chunk = following
    if pending:
        yield b"".join(pending)


def list_archives(
    spark: SparkSession, folder: str, entities: Iterable[str] | None = None, glob: str = "*.zip"
) -> DataFrame:
    """One row per archive of all or of some entities: ``archive``, ``entity`` and ``bytes``."""
    archives = list_files(spark, folder, glob).select(
        F.col("path").alias("archive"), entity_name(F.col("file_name")).alias("entity"), "bytes"
    )
    return archives if entities is None else archives.filter(F.col("entity").isin(list(entities)))


def read_members(
    spark: SparkSession,
    folder: str,
    entities: Iterable[str] | None = None,
    glob: str = "*.zip",
    tasks: int | None = None,
    distinct: bool = False,
) -> DataFrame:
    """The members of a folder's archives, of all or some entities, as blocks of whole lines.

    Columns: ``archive``, ``entity``, ``member``, ``block_no``, ``block``. The archives' directories are
    read once, in parallel; the list of members, names and sizes only, comes to the driver as file
    listings do, and is dealt out over ``tasks``, the largest first, each to the task with the least. Without
    ``tasks`` there are more of them for more bytes, so that none reads much over ``TASK_BYTES`` but for one large member.

    With ``distinct`` a member that an entity has twice, in whatever archives and under whatever names, is
    read once, from the first archive by name; it is told by its content (see ``distinct_members``).
    """
    archives = list_archives(spark, folder, entities, glob).select("archive", "entity")
    found = archives.mapInArrow(
        _members, "archive string, entity string, member string, bytes bigint, crc bigint"
    ).collect()
    if distinct:
        found = distinct_members(spark, found, tasks)
    tasks = _tasks(spark, tasks, found)
    members = _deal_out(spark, _dealt(found, tasks), "archive string, entity string, member string", tasks)
    return members.mapInArrow(
        _blocks,
        "archive string, entity string, member string, block_no bigint, block binary",
    )


def _tasks(spark: SparkSession, tasks: int | None, members: list) -> int:
    if tasks is not None:
        return tasks
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = sum(row.bytes for row in members)
    return max(4 * spark.sparkContext.defaultParallelism, shuffle, -(-size // TASK_BYTES))


def _deal_out(spark: SparkSession, dealt: list[tuple], schema: str, tasks: int) -> DataFrame:
    """Rows that end in the number of a task, in that task."""
    rows = spark.createDataFrame(dealt, f"{schema}, task int")
    return rows.repartitionByRange(tasks, "task").drop("task")


def _assigned(members: list, tasks: int) -> Iterator[tuple]:
    """Members, the largest first, with the task that reads each: the one with the least so far."""
    load = [(0, task) for task in range(tasks)]
    for row in sorted(members, key=lambda m: (-m.bytes, m.archive, m.member)):
        held, task = heapq.heappop(load)
        heapq.heappush(load, (held + row.bytes + 1, task))
        yield row, task


def _dealt(members: list, tasks: int) -> list[tuple[str, str, str, int]]:
    """Members with the task that reads each; the order of rows does not matter."""
    return [(row.archive, row.entity, row.member, task) for row, task in _assigned(members, tasks)]


def distinct_members(spark: SparkSession, members: list, tasks: int | None = None) -> list:
    """The first of the members of an entity that hold the same bytes, by archive and name.

    Size and checksum stand in the archives' directories, so only members that agree in both are read, in
    parallel, and told apart by a digest of their content.
    """
    alike: dict[tuple, list] = {}
    for row in members:
        alike.setdefault((row.entity, row.bytes, row.crc), []).append(row)
    several = [row for rows in alike.values() if len(rows) > 1 for row in rows]
    if not several:
        return members
    schema = "archive string, entity string, member string"
    tasks = _tasks(spark, tasks, several)
    dealt = _dealt(several, tasks)
    digests = _deal_out(spark, dealt, schema, tasks).mapInArrow(_digests, f"{schema}, digest string")
    first: dict[tuple, tuple] = {}
    for row in digests.collect():
        key, place = (row.entity, row.digest), (row.archive, row.member)
        first[key] = min(place, first.get(key, place))
    kept = set(first.values())
    read = {(row.archive, row.member) for row in several}
    return [row for row in members if (place := (row.archive, row.member)) not in read or place in kept]


# Archives that were cut off or changed on their way


def _directories(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of each archive by number; one row without a member if there are none, or the directory cannot be read."""
    for batch in batches:
        for name in batch["archive"].to_pylist():
            try:
                members, fault = [(n, i.filename, i.file_size) for n, i in _files_of(name)], None
            except (zipfile.BadZipFile, EOFError, ValueError):
                members, fault = [], "directory"
            members = members or [(None, None, 0)]
            numbers, names, sizes = zip(*members, strict=True)
            yield pa.RecordBatch.from_pydict(
                {
                    "archive": pa.array([name] * len(members), pa.string()),
                    "number": pa.array(numbers, pa.int64()),
                    "member": pa.array(names, pa.string()),
                    "bytes": pa.array(sizes, pa.int64()),
                    "fault": pa.array([fault] * len(members), pa.string()),
                }
            )


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each member with what is wrong with it, if anything; it is read to the end, which checks its checksum."""
    for batch in batches:
        for row in batch.to_pylist():
            row["fault"] = _fault_of(row["archive"], row["number"])
            yield pa.RecordBatch.from_pydict(
                {name: pa.array([row[name]], kind) for name, kind in zip(row, batch.schema.types + [pa.string()], strict=True)}
            )


def _fault_of(name: str, number: int) -> str | None:
    with open_file(name) as source, zipfile.ZipFile(source) as archive:
        info = archive.infolist()[number]
        try:
            with archive.open(info) as member:
                size = 0
                while block := member.read(BLOCK_BYTES):
                    size += len(block)
        except (zipfile.BadZipFile, zlib.error, EOFError, ValueError):
            return "content"
        except (RuntimeError, NotImplementedError):
            return "encrypted or of an unknown method"
        return None if size == info.file_size else "content"


def check_archives(
    spark: SparkSession,
    folder: str,
    entities: Iterable[str] | None = None,
    glob: str = "*.zip",
    tasks: int | None = None,
) -> DataFrame:
    """One row per archive: ``archive``, ``file_name``, ``entity``, ``members``, ``bytes`` (extracted) and ``fault``.

    ``fault`` is NULL for a whole archive. It is ``directory`` for one whose directory cannot be read, such as a
    download that was cut off, or has not begun and left no bytes; else it names the first member, by name, whose content does not have the
    size and checksum that the directory tells, or that cannot be extracted. ``members`` and ``bytes`` are NULL
    where the directory cannot be read. Every member is read to its end, in parallel as
    ``read_members`` does; nothing is written. An error of the file system is an error here too.
    """
    archives = list_archives(spark, folder, entities, glob).select("archive", "entity")
    found = archives.select("archive").mapInArrow(
        _directories, "archive string, number bigint, member string, bytes bigint, fault string"
    ).collect()
    schema = "archive string, number bigint, member string, bytes bigint"
    readable = [row for row in found if row.number is not None]
    tasks = _tasks(spark, tasks, readable)
    dealt = [(*row[:4], task) for row, task in _assigned(readable, tasks)]
    checked = _deal_out(spark, dealt, schema, tasks).mapInArrow(_verified, f"{schema}, fault string")
    by_archive = checked.groupBy("archive").agg(
        F.count("*").alias("members"),
        F.sum("bytes").alias("bytes"),
        F.min(F.when(F.col("fault").isNotNull(), F.struct("member", "fault"))).alias("first"),
    )
    faults = by_archive.select(
        "archive", "members", "bytes", F.concat("first.member", F.lit(": "), "first.fault").alias("fault")
    )
    unreadable = spark.createDataFrame(
        [(row.archive, None, None, row.fault) for row in found if row.fault is not None],
        "archive string, members bigint, bytes bigint, fault string",
    )
    empty = spark.createDataFrame(
        [(f"{folder}/{name}",) for name in empty_files(spark, folder, glob)], "archive string"
    ).withColumn("entity", entity_name(file_name(F.col("archive"))))
    if entities is not None:
        empty = empty.filter(F.col("entity").isin(list(entities)))
    # an archive without members is whole
    counts = {name: F.when(F.col("fault").isNull(), F.coalesce(name, F.lit(0))).otherwise(F.col(name)) for name in ("members", "bytes")}
    checked = archives.join(faults.unionByName(unreadable), "archive", "left").withColumns(counts)
    nothing = F.lit(None).cast("bigint")
    empty = empty.select("archive", "entity", nothing.alias("members"), nothing.alias("bytes"), F.lit("directory").alias("fault"))
    return checked.unionByName(empty).select(
        "archive", file_name(F.col("archive")).alias("file_name"), "entity", "members", "bytes", "fault"
    )


def refuse_broken(spark: SparkSession, folder: str, entities: Iterable[str] | None = None, **options) -> None:
    """Raise ``BrokenArchives`` if an archive is not whole, naming up to twenty of them."""
    broken = check_archives(spark, folder, entities, **options).where("fault is not null")
    if rows := broken.orderBy("archive").limit(20).collect():
        raise BrokenArchives("; ".join(f"{row.file_name} ({row.fault})" for row in rows))


class BrokenArchives(ValueError):
    """Archives that were cut off or changed on their way."""


def _text(block: Column, encoding: str) -> Column:
    if encoding.upper() == "UTF-8":
        return F.make_valid_utf8(block.cast("string"))
    return F.decode(block, encoding)


def archived_lines(members: DataFrame, encoding: str = "UTF-8") -> DataFrame:
    """One row per non-blank line: ``archive``, ``entity``, ``member``, ``line``."""
    text = F.replace(_text(F.col("block"), encoding), F.lit("\r"), F.lit("\n"))
    lines = members.select(
        "archive", "entity", "member", F.explode(F.split(text, "\n")).alias("line")
    )
    return lines.filter(F.trim("line", F.lit(_BLANKS)) != "")


def archived_rows(
    spark: SparkSession, folder: str, entity: Entity, escape: str = "\\", **options
) -> DataFrame:
    """The rows of one entity straight from its archives, without extracting them first.

    Good for code tables and for many small archives. Extract large ones: an extracted file is
    read in parallel, an archive member is not.
    """
    lines = archived_lines(read_members(spark, folder, [entity.folder], **options), entity.encoding)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in entity.schema)
    parsed = F.from_csv("line", fields, {"sep": FIELD_SEPARATOR, "escape": escape})
    return lines.select(parsed.alias("row")).select("row.*")


def extract_archives(
    spark: SparkSession,
    folder: str,
    target: str,
    entities: Iterable[str] | None = None,
    **options,
) -> None:
    """Extract archives to plain files in ``<target>/entity=<entity>/``, replacing those.

    Nothing else in ``target`` is touched, so it may be the folder of the archives itself. Bytes are
    kept as they are, in whatever encoding, but for a byte order mark and a missing last line break.
    Two archives of an entity that hold a member of the same name are both kept.

    Without ``entities`` everything is extracted in one job, for which Spark sorts each task's
    blocks by entity. With a list, each entity is its own job, without that sort, and all run at once, so
    that small ones do not leave the cluster idle; an entity without archives is an error.
    """
    if entities is None:
        members = read_members(spark, folder, **options)
        text = members.select("entity", F.col("block").cast("string").alias("value"))
        writer = text.write.partitionBy("entity").mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").text(target)
        return
    entities = list(entities)
    found = list_archives(spark, folder, entities).select("entity").distinct().collect()
    if absent := set(entities) - {row.entity for row in found}:
        raise FileNotFoundError(f"no archive of {', '.join(sorted(absent))} in {folder}")

    def extract(entity: str) -> None:
        members = read_members(spark, folder, [entity], **options)
        text = members.select(F.col("block").cast("string").alias("value"))
        text.write.mode("overwrite").text(f"{target}/entity={entity}")

    with ThreadPoolExecutor(max(1, len(entities))) as jobs:
        for _ in jobs.map(extract, entities):
            pass

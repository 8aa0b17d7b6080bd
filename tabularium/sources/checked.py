"""Delimited files read with an account of what the permissive reader changes.

``read_delimited`` fails on no row: bad numbers become NULL, missing fields NULL, further fields vanish, and
a quote that is not closed swallows the fields after it. Here each line comes with the row that it gives
there, the line itself, and its faults; so lines can be set aside, counted and mended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from tabularium.layouts import FIELD_SEPARATOR

#: What faults are called; bad values are ``value:<field>``.
SHORT, LONG, QUOTE, ENCODING, VALUE = "short", "long", "quote", "encoding", "value:"

# A line of nothing else is blank to the reader of delimited files.
_BLANKS = "".join(map(chr, range(33)))
# A field put after the last one of a line: where it comes out tells how many there are. It has a character
# that no text file holds.
_MARK = "\x00end"


def read_checked(
    spark: SparkSession,
    paths: str | list[str],
    schema: StructType,
    encoding: str = "UTF-8",
    escape: str = "\\",
    recursive: bool = False,
) -> DataFrame:
    """The columns of ``schema`` as ``read_delimited`` reads them, and ``path``, ``line`` and ``faults``.

    ``faults`` is an array, empty for a sound line: ``short`` and ``long`` for fields that are missing or too
    many; ``quote`` for a quote that is not closed within the line, so that it holds the fields after it;
    ``value:<field>`` for text that is not a value of the field's type; and ``encoding`` for bytes that
    are not in the encoding. One scan of the files; sound lines are parsed once, others once more. Blank lines are no rows.
    """
    raw = spark.read.text(paths, recursiveFileLookup=recursive)
    line = _decoded(F.col("value"), encoding)
    lines = raw.select(F.col("_metadata.file_path").alias("path"), line.alias("line"), "value")
    return _checked(lines.where(F.trim("line", F.lit(_BLANKS)) != ""), schema, encoding, escape)


def _decoded(value: Column, encoding: str) -> Column:
    if encoding.upper() == "UTF-8":
        return F.make_valid_utf8(value)
    return F.decode(value.cast("binary"), encoding)


def _checked(lines: DataFrame, schema: StructType, encoding: str, escape: str) -> DataFrame:
    options = {"sep": FIELD_SEPARATOR, "escape": escape, "mode": "PERMISSIVE"}

    def parsed(text: Column, fields: list[tuple[str, DataType]], **more: str) -> Column:
        kinds = ", ".join(f"`{name}` {kind.simpleString()}" for name, kind in fields)
        return F.from_csv(text, kinds, {**options, **more})

    fields = [(field.name, field.dataType) for field in schema]
    marked = F.concat("line", F.lit(f"{FIELD_SEPARATOR}{_MARK}"))
    # With the mark in the last place the line has the right number of fields, and its values are as without.
    typed = parsed(
        marked, [*fields, ("__end", StringType()), ("__bad", StringType())], columnNameOfCorruptRecord="__bad"
    )
    read = lines.select("path", "line", "value", typed.alias("row"))
    whole = F.col("row.__end").eqNullSafe(_MARK)
    sound = whole & F.col("row.__bad").isNull()
    texts = parsed(marked, [(f"f{k}", StringType()) for k in range(len(fields) + 1)])
    texts = F.array(*(texts.getField(f"f{k}") for k in range(len(fields) + 1)))
    bad_bytes = F.lit(False) if encoding.upper() != "UTF-8" else ~F.is_valid_utf8("value")
    faults = F.when(sound, F.array().cast("array<string>")).otherwise(_faults(texts, F.col("row"), fields, whole))
    faults = F.when(bad_bytes, F.array_append(faults, ENCODING)).otherwise(faults)
    plain = F.when(whole, F.struct(*(F.col("row").getField(name).alias(name) for name, _ in fields)))
    plain = plain.otherwise(parsed(F.col("line"), fields))
    return read.select(plain.alias("row"), "path", "line", faults.alias("faults")).select(
        *(F.col("row").getField(name).alias(name) for name, _ in fields), "path", "line", "faults"
    )


def _faults(texts: Column, row: Column, fields: list[tuple[str, DataType]], whole: Column) -> Column:
    """What is wrong with a line that is not sound, from its fields as text."""
    values = [
        F.when(texts[k].isNotNull() & row.getField(name).isNull(), F.lit(f"{VALUE}{name}"))
        for k, (name, kind) in enumerate(fields)
        if not isinstance(kind, StringType)
    ]
    bad_values = F.array_compact(F.array(*values)) if values else F.array().cast("array<string>")
    place = F.array_position(texts, _MARK)
    swallowed = F.exists(texts, lambda text: F.coalesce(text.endswith(_MARK) & (text != _MARK), F.lit(False)))
    shape = F.when(place > 0, SHORT).when(swallowed, QUOTE).otherwise(LONG)
    return F.when(whole, bad_values).otherwise(F.array(shape))


def is_faulty() -> Column:
    return F.size("faults") > 0


def quarantine(checked: DataFrame) -> DataFrame:
    """The lines that have faults: ``path``, ``line``, ``faults``."""
    return checked.where(is_faulty()).select("path", "line", "faults")


def count_faults(checked: DataFrame, observation: Observation, schema: StructType) -> DataFrame:
    """``checked`` with counters that the job which runs it fills: ``lines``, ``faulty``, and each fault by name."""
    kinds = [SHORT, LONG, QUOTE, ENCODING]
    kinds += [f"{VALUE}{field.name}" for field in schema if not isinstance(field.dataType, StringType)]
    counters = [F.count_if(F.array_contains("faults", kind)).alias(kind) for kind in kinds]
    return checked.observe(
        observation, F.count("*").alias("lines"), F.count_if(is_faulty()).alias("faulty"), *counters
    )


def write_checked(checked: DataFrame, path: str, schema: StructType) -> dict[str, int]:
    """Write sound and faulty lines apart, in one scan, and give the counts of faults.

    ``<path>/faulty=true`` is the quarantine table, with the lines; ``<path>/faulty=false`` has the rows. Both are
    replaced. Rows of faulty lines are in the quarantine only, so a load can refuse or mend them.
    """
    observation = Observation()
    counted = count_faults(checked, observation, schema)
    line = F.when(is_faulty(), F.col("line"))  # a sound line says no more than its row
    counted.withColumns({"line": line, "faulty": is_faulty()}).write.mode("overwrite").partitionBy("faulty").parquet(path)
    return observation.get


class FaultyLines(ValueError):
    """More lines have faults than a load allows."""

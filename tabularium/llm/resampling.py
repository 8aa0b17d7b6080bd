"""Importance resampling towards a target: documents whose words are as the target's are drawn first.

A document's features are its runs of 1 to ``runs`` consecutive words, each hashed into a bucket (crc32). A
bucket's gain is the floored thousandfold logarithm of its smoothed share among the target's features over that
among the documents'. Gains are an array by bucket, so a text is scored by one lookup for each of its features; its
*weight* is the floored mean. Adding Gumbel noise, drawn from a hash of the id, to weights and taking the highest
scores draws documents without replacement, each in proportion to its importance (Xie et al. 2023).

The highest scores are found by a distributed radix sort (:func:`radix_ranks`) from the least significant digit on.
Every pass is a stable counting sort: rows lie in blocks of places, digits are counted by block, and the rows that come
before a block's rows of a digit, those of smaller digits and those of the digit in earlier blocks, give each of its
rows its destination. After the last pass the destination is the rank. A block's rows are all that a task holds;
the driver sees the number of rows by digit value (2,048 at most) and the ends of the keys' ranges.

Words are lower-cased (A-Z) runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``; null texts have none. Documents of fewer than
``least`` words have a weight and a score, but are not drawn. Rows without an id have no score. Ties go to the
smaller id; rows of one id and score, such as repeated rows, take ranks one after the other. Without documents the result is empty;
without target texts every gain is what smoothing leaves.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabularium.llm.arrow import batchwise
from tabularium.llm.tables import keep, release
from tabularium.llm.words import ALNUM, LOWER, Piece, edges_of, pieces

#: Bits of the largest digit.
DIGIT_BITS = 11
#: Rows of a block, as powers of two: at least, at most, and how many blocks there should be in between.
BLOCK_BITS, MOST_BLOCK_BITS, BLOCKS_BITS = 12, 20, 10
#: Bytes up to which features are hashed together; longer ones one by one.
SHORT = 48


def _crc_table() -> np.ndarray:
    """The table of the usual crc32, by its rule."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> 1), table >> 1)
    return table.astype(np.uint32)


_CRC = _crc_table()


def crc32s(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The crc32 of the bytes from each start to each end."""
    out = np.empty(len(starts), np.uint32)
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    first_short = int(np.searchsorted(-lengths[order], -SHORT))
    for at in order[:first_short]:
        out[at] = zlib.crc32(data[starts[at] : ends[at]])
    order = order[first_short:]
    begins, crc = starts[order], np.full(len(order), 0xFFFFFFFF, np.uint32)
    # of the features in order of length, so many have a byte at each place
    longer = np.searchsorted(-lengths[order], -np.arange(SHORT + 1), "left")
    for place in range(SHORT):
        n = int(longer[place])
        if not n:
            break
        crc[:n] = _CRC[(crc[:n] ^ data[begins[:n] + place]) & 255] ^ (crc[:n] >> 8)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def features_of(piece: Piece, runs: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a piece: the number of words by text, and bucket and text of each feature."""
    data = LOWER[piece.data]
    starts, ends = edges_of(piece, ALNUM[data])
    bounds = np.searchsorted(starts, piece.bounds)
    n_words = np.diff(bounds)
    if runs > 1:  # words side by side, with one space between
        sizes = ends - starts + 1
        begins = np.cumsum(sizes) - sizes
        inside = np.arange(int(sizes.sum())) - np.repeat(begins, sizes)
        packed = np.append(data, np.uint8(32))[np.minimum(np.repeat(starts, sizes) + inside, len(data))]
        packed[begins + sizes - 1] = 32
        data, starts, ends = packed, begins, begins + sizes - 1
    text = np.repeat(np.arange(len(n_words)), n_words)
    found, owners = [], []
    for length in range(1, runs + 1):
        first = np.arange(max(0, len(starts) - length + 1))
        first = first[first + length <= bounds[text[first] + 1]]
        found.append(crc32s(data, starts[first], ends[first + length - 1]) % np.uint32(buckets))
        owners.append(text[first])
    return n_words, np.concatenate(found), np.concatenate(owners)


def bucket_counts(texts: DataFrame, runs: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket. One row a bucket and task is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in pieces(batch["text"]):
                total += np.bincount(features_of(piece, runs, buckets)[1], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    counted = texts.select("text").mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """By bucket: the floored thousandfold logarithm of how much likelier the target has it, both smoothed by one."""
    all_source, all_target, buckets = int(source.sum()), int(target.sum()), len(source)
    return np.array(
        [
            math.floor(
                1000 * math.log(float((t + 1) * (all_source + buckets)) / float((s + 1) * (all_target + buckets)))
            )
            for s, t in zip(source.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def weigh(text: Column, gain: np.ndarray, runs: int) -> Column:
    """``n_words``, ``n_features`` and ``weight`` of a text as a struct; null is as empty."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            columns: list[list[np.ndarray]] = [[], [], []]
            for piece in pieces(texts):
                n_words, bucket, owner = features_of(piece, runs, len(gain))
                n = np.bincount(owner, minlength=len(n_words))
                total = np.zeros(len(n_words), np.int64)
                np.add.at(total, owner, gain[bucket])
                for column, values in zip(columns, (n_words, n, total // np.maximum(n, 1)), strict=True):
                    column.append(values)
            arrays = [np.concatenate([*column, np.empty(0, np.int64)]).astype(np.int64) for column in columns]
            yield pa.StructArray.from_arrays([pa.array(a) for a in arrays], ["n_words", "n_features", "weight"])

    return batchwise("struct<n_words: bigint, n_features: bigint, weight: bigint>", run)(text)


def gumbel(doc_id: Column, seed: str) -> Column:
    """Thousandfold Gumbel noise, floored, from the first eight hex digits of a hash of the id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")).cast("binary"), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296
    return F.floor(-1000 * F.log(-F.log(uniform))).cast("long")


def _key_bits(low: int, high: int) -> int:
    """How many low bits tell numbers from ``low`` to ``high`` apart; all 64 if their signs differ."""
    return 64 if (low < 0) != (high < 0) else (low ^ high).bit_length()


def _digit(keys: list[tuple[str, int]], low: int, width: int) -> Column:
    """``width`` bits from bit ``low`` on, counted from the end of all keys' low bits side by side."""
    parts, begin = [], 0
    for name, bits in reversed(keys):
        first, last = max(low, begin), min(low + width, begin + bits)
        if first < last:
            key = F.col(name).bitwiseXOR(F.lit(-(1 << 63))) if bits == 64 else F.col(name)
            part = F.shiftrightunsigned(key, first - begin).bitwiseAND(F.lit((1 << (last - first)) - 1))
            parts.append(F.shiftleft(part, first - low))
        begin += bits
    out = F.lit(0).cast("long")
    for part in parts:
        out = out.bitwiseOR(part)
    return out


def radix_ranks(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``rows`` with a column ``name``, the place of each (from 1) in order of whole-number ``keys``, the first counting most.

    Keys are long and not null. Only bits in which keys differ are sorted by, so the number of passes follows the
    ranges of the keys. Each pass is written, so all of its tasks see the same places if one is run again.
    """
    columns = rows.columns
    rows = keep(rows.withColumn(name, F.monotonically_increasing_id()), "radix-start")
    ends = [end(key) for key in keys for end in (F.min, F.max)]
    n, *ends = rows.agg(F.count("*"), *ends).first()
    if not n:
        return rows.select(*columns, name)
    bits = [(key, _key_bits(ends[2 * k], ends[2 * k + 1])) for k, key in enumerate(keys)]
    total = sum(width for _, width in bits)
    passes = max(1, -(-total // DIGIT_BITS))
    width = max(1, -(-total // passes))
    block_bits = min(MOST_BLOCK_BITS, max(BLOCK_BITS, n.bit_length() - BLOCKS_BITS))
    for number in range(passes):
        placed = _counting_pass(rows, name, _digit(bits, number * width, width), block_bits)
        moved = keep(placed, f"radix-{number}")
        release(rows)
        rows = moved
    return rows.withColumn(name, F.col(name) + 1)


def _counting_pass(rows: DataFrame, name: str, digit: Column, block_bits: int) -> DataFrame:
    """``rows`` with the place of each after a stable sort by ``digit``; places are from 0, without gaps."""
    block = F.shiftright(name, block_bits)
    counts = rows.groupBy(block.alias("block"), digit.alias("digit")).agg(F.count("*").alias("n"))
    begins, place = {}, 0
    for value, n in sorted(counts.groupBy("digit").agg(F.sum("n")).collect()):
        begins[value], place = place, place + n
    earlier = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("block", "digit", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))

    def place_rows(held: pa.Table, offsets: pa.Table) -> pa.Table:
        values = held["__digit"].to_numpy()
        order = np.lexsort((held[name].to_numpy(), values))
        values = values[order]
        begin = {
            value: begins[value] + n
            for value, n in zip(offsets["digit"].to_pylist(), offsets["earlier"].to_pylist(), strict=True)
        }
        new = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
        sizes = np.diff(np.append(new, len(values)))
        within = np.arange(len(values)) - np.repeat(new, sizes)
        to = np.repeat(np.array([begin[value] for value in values[new].tolist()], np.int64), sizes) + within
        at = held.column_names.index(name)
        moved = held.take(pa.array(order)).set_column(at, name, pa.array(to))
        return moved.drop_columns(["__block", "__digit"])

    marked = rows.select("*", block.alias("__block"), digit.alias("__digit"))
    return (
        marked.groupBy("__block")
        .cogroup(offsets.withColumnRenamed("block", "__block").groupBy("__block"))
        .applyInArrow(place_rows, rows.schema)
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least: int = 20,
    runs: int = 1,
    buckets: int = 10_000,
    seed: str = "2024",
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank``: every row of ``docs``, with its rank if it is drawn.

    ``docs`` have ``doc_id`` and ``text``, ``target`` has ``text``. Of the documents with ``least`` words or more and
    an id, ``percent`` in a hundred are drawn, rounded down.
    """
    gain = gains(bucket_counts(docs, runs, buckets), bucket_counts(target, runs, buckets))
    weighed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), weigh(F.col("text"), gain, runs).alias("w"))
    scored = keep(
        weighed.select("doc_id", "w.*").withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)),
        "weights",
    )
    drawable = F.col("doc_id").isNotNull() & (F.col("n_words") >= least)
    # the complement of a number orders from the highest down
    rows = scored.where(drawable).withColumn("highest", F.bitwise_not("score"))
    ranked = radix_ranks(rows, ["highest", "doc_id"], "rank").drop("highest")
    n = scored.where(drawable).count()
    drawn = F.when(F.col("rank") <= percent * n // 100, F.col("rank"))
    others = scored.where(~drawable).withColumn("rank", F.lit(None).cast("long"))
    return ranked.withColumn("rank", drawn).unionByName(others)

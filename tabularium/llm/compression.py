"""Vectors as short codes: each part of a vector is the number of its nearest codebook entry.

Components become whole numbers, ``floor(scale * x)``, and a vector is cut into equal consecutive parts, each with
a codebook of its own, refined by Lloyd's rounds (:func:`learn`). All arithmetic is on whole numbers, so codes, errors and
codebooks are the same whatever the partitioning.

The nearest entry is found in the Walsh-Hadamard domain. Parts and entries are padded with zeros to a power of two, ``n``,
and transformed by additions and subtractions only. The transform multiplies squared distances by exactly ``n``, so they may be
summed over its coefficients instead, those of low sequency (few sign changes), which hold most of a smooth part, first. An entry whose
sum so far exceeds the full distance of the entry that led after the first coefficients cannot be nearest, and is not carried on. What
is left is compared by full distance; ties go to the lower number.

Numbers that could leave 64 bits are worked on as Python's unbounded ones, in the same steps. An error that does not
fit a long is null, and so is its label's.

A round reads the vectors once and shuffles, for each task, one sum for each component of the codebooks, which are all the driver
holds: ``parts * entries`` rows, a parameter. Vectors are never shuffled.

Vectors that are null or hold a null, NaN or infinite component are left out. Those that are shorter than the longest are
padded with zeros at their end, and so is the length if the parts don't divide it. Codebooks start from the vectors of the smallest ids,
a row that is repeated counting once, and two vectors of one id in order of their components; rows without an id are coded, but don't start
an entry. With fewer vectors than entries there are fewer entries. Without vectors, or without any id, the result is empty.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tabularium.llm.tables import keep

#: Parts compared at a time; with 256 entries their sums are a few MB.
TOGETHER = 256
#: Points are taken one by one once fewer than one in so many is left.
FEW = 12
#: Sums travel as numbers of so many bits, so that they can be added up as longs.
LIMB_BITS = 40


class Books(NamedTuple):
    """Codebooks: by part, the entries as lists of whole numbers. ``width`` is the components of a part."""

    entries: list[list[list[int]]]
    width: int
    scale: int

    def sha256(self) -> str:
        """Of all components in decimal by part, entry and place, with commas between."""
        text = ",".join(str(x) for book in self.entries for entry in book for x in entry)
        return hashlib.sha256(text.encode()).hexdigest()


def usable(vectors: DataFrame) -> DataFrame:
    """The rows whose vector is there and finite throughout."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(F.col("embedding").isNotNull() & finite)


def _whole(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as int64, or as Python numbers if one is too large for exact products."""
    if not len(values) or np.abs(values).max() * scale < 2**50:
        return np.floor(values * scale).astype(np.int64)
    out = np.empty(len(values), object)
    for k, x in enumerate(values.tolist()):
        # from 2**53 on every double is whole, and its product may leave the doubles
        out[k] = int(x) * scale if abs(x) >= 2**53 else math.floor(x * scale)
    return out


def _matrix(vectors: pa.Array, books_width: int, parts: int, scale: int) -> np.ndarray:
    """Rows by parts by components, padded with zeros."""
    lengths = np.diff(vectors.offsets.to_numpy())
    values = _whole(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64), scale)
    out = np.zeros((len(vectors), parts * books_width), values.dtype)
    row = np.repeat(np.arange(len(vectors)), lengths)
    begins = np.cumsum(lengths) - lengths
    out[row, np.arange(len(values)) - np.repeat(begins, lengths)] = values
    return out.reshape(len(vectors), parts, books_width)


def sequency_order(n: int) -> np.ndarray:
    """Which of the ``n`` Walsh functions in natural order has 0, 1, 2, ... sign changes."""
    bits = n.bit_length() - 1
    gray = np.arange(n) ^ (np.arange(n) >> 1)
    return sum((((gray >> bit) & 1) << (bits - 1 - bit) for bit in range(bits)), np.zeros(n, np.int64))


def transform(rows: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of rows padded to a power of two, in order of sequency."""
    n = 1 << max(0, (rows.shape[1] - 1).bit_length())
    out = np.zeros((len(rows), n), rows.dtype)
    out[:, : rows.shape[1]] = rows
    half = 1
    while half < n:
        pairs = out.reshape(len(rows), n // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(rows), n)
        half *= 2
    return out[:, sequency_order(n)]


def _largest(rows: np.ndarray) -> int:
    return max(abs(int(rows.max(initial=0))), abs(int(rows.min(initial=0))))


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row: the number of its nearest entry and the squared distance to it."""
    width = rows.shape[1]
    n = 1 << max(0, (width - 1).bit_length())
    # a coefficient is at most n times a component, a difference twice that
    most = n * (2 * n * max(_largest(rows), _largest(entries))) ** 2
    kind = np.int32 if most < 2**31 else np.int64 if most < 2**63 else object
    points, places = transform(entries.astype(kind)), np.empty(len(rows), np.int64)
    errors = np.empty(len(rows), object if kind is object else np.int64)
    for first in range(0, len(rows), TOGETHER):
        part = slice(first, first + TOGETHER)
        places[part], errors[part] = _search(transform(rows[part].astype(kind)), points)
    return places, errors // n


def _search(rows: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest point to each row, both transformed, and the distance, still multiplied.

    Coefficients are added up for all points side by side while many are left, then for those that are left.
    """
    n = rows.shape[1]
    step = max(1, n // 4)
    sums = (rows[:, None, 0] - points[None, :, 0]) ** 2
    done = 1
    while True:
        while done % step:
            sums += (rows[:, None, done] - points[None, :, done]) ** 2
            done += 1
        leader = sums.argmin(axis=1)
        if done == n:
            return leader, sums[np.arange(len(rows)), leader]
        # the leader itself is never above its own full distance, so every row keeps one
        bound = ((rows - points[leader]) ** 2).sum(axis=1)
        alive = sums <= bound[:, None]
        if np.count_nonzero(alive) * FEW < alive.size:
            break
        sums += (rows[:, None, done] - points[None, :, done]) ** 2
        done += 1
    row, point = np.nonzero(alive)
    held = sums[row, point]
    for begin in range(done, n, step):
        for k in range(begin, begin + step):
            held = held + (rows[row, k] - points[point, k]) ** 2
        alive = held <= bound[row]
        row, point, held = row[alive], point[alive], held[alive]
    order = np.lexsort((point, held, row)) if held.dtype != object else _sorted(row, held, point)
    row, point, held = row[order], point[order], held[order]
    best = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    return point[best], held[best]


def _sorted(row: np.ndarray, held: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.array(sorted(range(len(row)), key=lambda k: (row[k], held[k], point[k])), np.int64)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """A whole number as digits of ``LIMB_BITS`` bits with a sign, the least first."""
    half, place = 1 << (LIMB_BITS - 1), 0
    while value:
        low = (value + half) % (2 * half) - half
        yield place, low
        value, place = (value - low) >> LIMB_BITS, place + 1


def _start(rows: DataFrame, parts: int, entries: int, scale: int) -> Books | None:
    """Codebooks of the vectors of the smallest ids."""
    longest = rows.agg(F.max(F.size("embedding"))).first()[0]
    ids = rows.where("vec_id is not null").select("vec_id").distinct().orderBy("vec_id").limit(entries).collect()
    if not ids:
        return None
    last = max(row.vec_id for row in ids)
    first = rows.where(F.col("vec_id") <= last).select("vec_id", "embedding").distinct()
    taken = first.orderBy("vec_id", "embedding").limit(entries).select("embedding").collect()
    width = max(1, -(-longest // parts))
    found = _matrix(pa.array([row.embedding for row in taken], pa.list_(pa.float64())), width, parts, scale)
    return Books([found[:, part].tolist() for part in range(parts)], width, scale)


def _round(rows: DataFrame, books: Books) -> Books:
    """Books with every entry moved to the floored mean of the parts that are nearest to it."""
    parts, width = len(books.entries), books.width
    entries = [np.array(book, object) for book in books.entries]
    n = len(entries[0])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, n, width + 1), object)
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = _matrix(batch["embedding"], width, parts, books.scale)
            for part in range(parts):
                place, _ = nearest(matrix[:, part], entries[part])
                new = np.zeros((n, width + 1), matrix.dtype)
                np.add.at(new[:, :width], place, matrix[:, part])
                np.add.at(new[:, width], place, 1)
                sums[part] += new
        rows = [(slot, k, x) for slot, value in enumerate(sums.ravel().tolist()) for k, x in _limbs(int(value))]
        slot, limb, value = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(slot, pa.int32()), pa.array(limb, pa.int32()), pa.array(value, pa.int64())],
            ["slot", "limb", "value"],
        )

    added = rows.select("embedding").mapInArrow(add, "slot int, limb int, value long")
    sums = [0] * (parts * n * (width + 1))
    for slot, limb, value in added.groupBy("slot", "limb").agg(F.sum("value")).collect():
        sums[slot] += value << (LIMB_BITS * limb)
    moved = []
    for part, book in enumerate(books.entries):
        at = (part * n + k for k in range(n))
        held = [sums[k * (width + 1) : (k + 1) * (width + 1)] for k in at]
        moved.append(
            [[x // s[-1] for x in s[:-1]] if s[-1] else old for s, old in zip(held, book, strict=True)]
        )
    return books._replace(entries=moved)


def learn(rows: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> Books | None:
    """Codebooks of usable vectors (``vec_id``, ``embedding``) after so many rounds; None if no row has an id."""
    if not 1 <= entries <= 256:
        raise ValueError(f"from 1 to 256 entries have two hex digits, not {entries}")
    books = _start(rows, parts, entries, scale)
    for _ in range(rounds if books else 0):
        books = _round(rows, books)
    return books


def encode(rows: DataFrame, books: Books) -> DataFrame:
    """``rows`` of usable vectors with ``code`` and ``error`` in place of ``embedding``; other columns stay.

    ``code`` has two hex digits for each part, ``error`` is the sum of the parts' squared distances to their entries.
    """
    parts, entries = len(books.entries), [np.array(book, object) for book in books.entries]
    kept = [c for c in rows.columns if c not in ("embedding", "code", "error")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = _matrix(batch["embedding"], books.width, parts, books.scale)
            codes = np.zeros((len(matrix), parts), np.uint8)
            errors = np.zeros(len(matrix), object)
            for part in range(parts):
                place, error = nearest(matrix[:, part], entries[part])
                codes[:, part] = place
                errors += error.astype(object)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch[c] for c in kept),
                    pa.array([row.tobytes().hex() for row in codes], pa.string()),
                    pa.array([int(x) if x < 2**63 else None for x in errors], pa.int64()),
                ],
                [*kept, "code", "error"],
            )

    fields = [*(rows.schema[c] for c in kept), StructField("code", StringType()), StructField("error", LongType())]
    return rows.select(*[F.col(f"`{c}`") for c in kept], "embedding").mapInArrow(run, StructType(fields))


def decode(code: str, books: Books) -> list[float]:
    """The vector that a code stands for."""
    places = bytes.fromhex(code)
    return [x / books.scale for part, place in enumerate(places) for x in books.entries[part][place]]


def compress(
    vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024
) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of all usable ``vectors`` (``vec_id``, ``embedding``, ``label``).

    ``label_error`` is the sum of ``error`` over rows of the same label; those without one are together.
    """
    rows = usable(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label"))
    books = learn(rows, parts, entries, rounds, scale)
    if books is None:
        rows, books = rows.where("false"), Books([[[0]]] * parts, 1, scale)
    coded = keep(encode(rows, books), "codes")
    whole = F.when(F.count("error") == F.count("*"), F.try_sum("error"))
    # tasks add up their own rows first, so a hot label costs one row a task
    by_label = coded.groupBy(F.col("label").alias("of")).agg(whole.alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )

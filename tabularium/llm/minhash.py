"""Near duplicates by b-bit MinHash, confirmed on full shingle sets.

A document is the set of its distinct runs of five words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased); with
fewer words the whole sequence is its one run. Two documents are linked if their sets' similarity
(intersection over union) reaches ``percent``; groups are what links connect.

* Documents of equal sets are one class from the start, whose smallest id stands for it.
* Bands of five minima give candidates. There are so many bands that a pair at the threshold shares
  none with probability ``MISS`` only.
* Of all ``MINIMA`` minima the lowest ``BITS`` bits are kept, packed. The share of equal pieces, counted
  as bits and corrected for chance agreement, estimates the similarity; pairs more than five
  standard errors below the threshold are dropped.
* What remains is confirmed on the whole texts.

Candidates are tested in three rounds. In the first, each id is tested against the smallest one that it shares a
bucket with; so a group's texts are read once for each member, not for each bucket. In the second, each bucket tests its smallest id against the
others that are not in its component by then. Most buckets are then within one component, and what their other pairs would say changes
nothing. Buckets that still hold several components compare all their members across components,
inside tasks, in cells of bounded size; only pairs whose estimate passes leave the task. So no link
between components goes untested, and no bucket is gathered in one task.

Null and wordless texts have empty sets, are linked with nothing and stay. Rows without an id are
linked with nothing and have no component. Rows of one id count as one document, whatever their texts; :func:`keep_one`
tells these apart.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabularium.llm.arrow import batchwise_pairs, free_name
from tabularium.llm.components import components
from tabularium.llm.tables import keep
from tabularium.llm.words import VISIBLE, mixed, pieces, runs, words_of

SHINGLE = 5
MINIMA, BITS = 512, 4
ROWS, MISS = 5, 1e-7
#: Members of one bucket that a task compares with each other at a time.
CELL = 512

_FACTORS, _OFFSETS = np.random.Generator(np.random.PCG64(6)).integers(0, 1 << 32, (2, MINIMA), np.uint32)
_FACTORS |= np.uint32(1)
_LOWEST = np.uint64(0x1111111111111111)


class Limits(NamedTuple):
    """What a threshold in percent asks of bands and of estimates."""

    percent: int
    bands: int
    agreeing: int

    @classmethod
    def of(cls, percent: int) -> Limits:
        similarity = percent / 100
        missed = 1 - similarity**ROWS  # by one band
        bands = math.ceil(math.log(MISS) / math.log(missed)) if 0 < missed < 1 else 1
        if not 0 < similarity <= 1 or bands * ROWS > MINIMA:
            raise ValueError(f"no bands for {percent} percent")
        chance = 2.0**-BITS
        share = similarity + (1 - similarity) * chance
        lowest = share - 5 * math.sqrt(share * (1 - share) / MINIMA)
        return cls(percent, bands, math.ceil(lowest * MINIMA))


def shingle_sets(texts: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """By piece of the column, from its first row on: each text's distinct shingles, sorted."""
    for piece in pieces(texts):
        words = words_of(piece, VISIBLE)
        all_runs = runs(words.hashes, SHINGLE)
        sets = []
        for lo, hi in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
            if hi - lo >= SHINGLE:
                found = np.sort(all_runs[lo : hi - SHINGLE + 1])
                found = found[np.concatenate(([True], found[1:] != found[:-1]))]
            elif hi > lo:
                found = runs(words.hashes[lo:hi], hi - lo)
            else:
                found = np.empty(0, np.uint64)
            sets.append(found)
        yield piece.first, sets


def _minima(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The minima of each set, a column for each hash function."""
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), MINIMA), np.uint32)
    for k in range(MINIMA):
        out[:, k] = np.minimum.reduceat(values * _FACTORS[k] + _OFFSETS[k], starts)
    return out


def _packed(minima: np.ndarray) -> np.ndarray:
    """The lowest four bits of each, two to a byte."""
    low = (minima & np.uint32((1 << BITS) - 1)).astype(np.uint8)
    return low[:, ::2] | low[:, 1::2] << BITS


def _band_keys(minima: np.ndarray, bands: int) -> np.ndarray:
    rows = minima[:, : bands * ROWS].reshape(len(minima), bands, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for k in range(ROWS):
        keys = mixed(keys * np.uint64(0xD1342543DE82EF95) + rows[:, :, k])
    return keys


def agreeing(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many pieces of packed signatures (rows of 64-bit words) are equal, by bit counts."""
    differ = one ^ other
    differ |= differ >> np.uint64(1)
    differ |= differ >> np.uint64(2)
    return MINIMA - np.bitwise_count(differ & _LOWEST).sum(axis=-1, dtype=np.int64)


def sketch(docs: DataFrame, bands: int) -> DataFrame:
    """``doc_id, n_shingles, key_1, key_2, bands, signature`` of ``doc_id, text``.

    The keys identify the set; they, bands and signature are null for an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in shingle_sets(batch["text"]):
                sizes = np.array([len(s) for s in sets])
                full = np.flatnonzero(sizes)
                columns = [[None] * len(sets) for _ in range(4)]
                if len(full):
                    shingles = np.concatenate([sets[k] for k in full])
                    starts = np.cumsum(sizes[full]) - sizes[full]
                    minima = _minima(shingles, starts)
                    keys = [
                        np.add.reduceat(mixed(shingles ^ np.uint64(salt)), starts).view(np.int64) for salt in (1, 2)
                    ]
                    found = [*keys, _band_keys(minima, bands).view(np.int64), _packed(minima)]
                    for column, values in zip(columns, found, strict=True):
                        for k, value in zip(full.tolist(), values, strict=True):
                            column[k] = value
                    columns[3] = [None if v is None else v.tobytes() for v in columns[3]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(first, len(sets)),
                        pa.array(sizes, pa.int64()),
                        pa.array(columns[0], pa.int64()),
                        pa.array(columns[1], pa.int64()),
                        pa.array(columns[2], pa.list_(pa.int64())),
                        pa.array(columns[3], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "key_1", "key_2", "bands", "signature"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run,
        "doc_id long, n_shingles long, key_1 long, key_2 long, bands array<long>, signature binary",
    )


def _likely(pairs: DataFrame, reps: DataFrame, limits: Limits) -> DataFrame:
    """Of pairs ``a, b`` those whose estimate passes."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ones, others in batches:
            words = [
                np.frombuffer(b"".join(x.as_py() for x in side), np.uint64).reshape(len(side), -1)
                for side in (ones, others)
            ]
            yield pa.array(agreeing(*words) if len(ones) else [], pa.int64())

    signed = pairs
    for side in ("b", "a"):
        signed = signed.join(
            reps.select(F.col("rep").alias(side), F.col("signature").alias(f"signature_{side}")), side
        )
    same = batchwise_pairs("bigint", run)(F.col("signature_a"), F.col("signature_b"))
    return signed.where(same >= limits.agreeing).select("a", "b")


def _confirmed(pairs: DataFrame, texts: DataFrame, limits: Limits) -> DataFrame:
    """Of pairs ``a, b`` those whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None  # pairs come ordered by a
        for batch in batches:
            a, b = batch["a"].to_pylist(), batch["b"].to_pylist()
            linked = []
            for first, sets in shingle_sets(batch["text_b"]):
                for row, other in enumerate(sets, first):
                    if a[row] != last:
                        last = a[row]
                        own = next(shingle_sets(batch["text_a"].slice(row, 1)))[1][0]
                    common = len(np.intersect1d(own, other, assume_unique=True))
                    if 100 * common >= limits.percent * (len(own) + len(other) - common):
                        linked.append(row)
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array([a[k] for k in linked], pa.int64()), "b": pa.array([b[k] for k in linked], pa.int64())}
            )

    read = pairs
    for side in ("b", "a"):
        read = read.join(texts.select(F.col("rep").alias(side), F.col("text").alias(f"text_{side}")), side)
    return read.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


class _Members(NamedTuple):
    """Rows of cells, column by column; rows of a cell are consecutive."""

    cell: np.ndarray  # band, block, block
    rep: np.ndarray
    component: np.ndarray
    block: np.ndarray
    is_hub: np.ndarray
    bands: np.ndarray
    signature: np.ndarray

    @classmethod
    def read(cls, batch: pa.RecordBatch) -> _Members:
        n = batch.num_rows
        number = {name: batch[name].to_numpy(zero_copy_only=False) for name in batch.schema.names[:-2]}
        signature = np.frombuffer(b"".join(x.as_py() for x in batch["signature"]), np.uint64)
        return cls(
            np.stack([number["band"], number["low"], number["high"]], axis=1),
            number["rep"],
            number["component"],
            number["block"],
            number["rep"] == number["hub"],
            batch["bands"].flatten().to_numpy().reshape(n, -1),
            signature.reshape(n, -1),
        )

    def rows(self, first: int, last: int) -> _Members:
        return _Members(*(column[first:last] for column in self))

    def after(self, earlier: _Members) -> _Members:
        return _Members(*(np.concatenate(both) for both in zip(earlier, self, strict=True)))

    def pairs(self, limits: Limits) -> Iterator[tuple[int, int]]:
        """Likely pairs of one cell: of two components, and not of an earlier shared band."""
        band, low, high = self.cell[0]
        for k in range(len(self.rep) - 1):
            if self.is_hub[k]:
                continue
            rest = slice(k + 1, None)
            other = (self.component[rest] != self.component[k]) & ~self.is_hub[rest]
            if low != high:
                other &= self.block[rest] != self.block[k]
            at = np.flatnonzero(other) + k + 1
            at = at[agreeing(self.signature[at], self.signature[k]) >= limits.agreeing]
            if len(at):
                shared = self.bands[at] == self.bands[k]
                at = at[self.bands[k][shared.argmax(axis=1)] == band]
                for j in at.tolist():
                    yield tuple(sorted((int(self.rep[k]), int(self.rep[j]))))


def _across(members: DataFrame, reps: DataFrame, labels: DataFrame, limits: Limits) -> DataFrame:
    """Likely pairs ``a, b`` of different components that share a bucket."""
    known = labels.select(F.col("id").alias("rep"), "component")
    labelled = members.join(known, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    labelled = keep(labelled, "members")
    open_bands = keep(
        labelled.groupBy("band")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n"))
        .where("low <> high")
        .select("band", F.ceil(F.col("n") / CELL).alias("blocks")),
        "bands",
    )
    cells = (
        labelled.join(open_bands, "band")
        .withColumn("block", F.pmod(F.xxhash64("rep", "band"), F.col("blocks")))
        .withColumn("partner", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "partner"))
        .withColumn("high", F.greatest("block", "partner"))
        .join(reps.select("rep", "bands", "signature"), "rep")
        .select("band", "low", "high", "rep", "hub", "component", "block", "bands", "signature")
        .repartition("band", "low", "high")
        .sortWithinPartitions("band", "low", "high", "rep")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def likely(rows: _Members) -> pa.RecordBatch:
            pairs = list(rows.pairs(limits))
            return pa.RecordBatch.from_arrays(
                [pa.array([pair[k] for pair in pairs], pa.int64()) for k in (0, 1)], ["a", "b"]
            )

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _Members.read(batch)
            rows = rows.after(held) if held else rows
            ends = np.flatnonzero((rows.cell[1:] != rows.cell[:-1]).any(axis=1)) + 1
            first = 0
            for end in ends.tolist():
                if end - first > 1:
                    yield likely(rows.rows(first, end))
                first = end
            held = rows.rows(first, len(rows.rep))
        if held:
            yield likely(held)

    return cells.mapInArrow(run, "a long, b long")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs ``a, b`` whose ends are not in one component."""
    labels = keep(labels, "labels")
    found = pairs
    for side in ("a", "b"):
        known = labels.select(F.col("id").alias(side), F.col("component").alias(f"component_{side}"))
        found = found.join(known, side, "left")
    ends = [F.coalesce(f"component_{side}", side) for side in ("a", "b")]
    return found.where(ends[0] != ends[1]).select("a", "b")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``doc_id, text``."""
    limits = Limits.of(percent)
    known = keep(sketch(docs, limits.bands), "sketch")
    linkable = known.where("n_shingles > 0 and doc_id is not null")
    chosen = linkable.groupBy("key_1", "key_2").agg(
        F.min(F.struct("doc_id", "bands", "signature")).alias("first")
    )
    reps = keep(
        chosen.select("key_1", "key_2", F.col("first.doc_id").alias("rep"), "first.bands", "first.signature"),
        "classes",
    )
    banded = reps.select("rep", F.explode("bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.min("rep").alias("hub"), F.max("rep").alias("last"))
    hubs = keep(hubs.where("hub <> last").select("band", "hub"), "hubs")
    members = keep(banded.join(hubs, "band"), "members")
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    copies = keep(
        docs.select(F.col("doc_id").cast("long"), "text")
        .join(wanted, "doc_id", "left_semi")
        .select(F.col("doc_id").alias("rep"), "text"),
        "copies",
    )
    # a row that is there many times is read once for each of its pairs; tasks drop their own repeats before the shuffle
    texts = keep(
        copies.groupBy("rep", F.xxhash64("text").alias("of")).agg(F.first("text").alias("text")).select("rep", "text"),
        "texts",
    )

    starred = members.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    starred = keep(starred, "starred")
    nearest = starred.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = keep(_confirmed(keep(_likely(nearest, reps, limits), "pairs"), texts, limits), "links")
    apart = _apart(starred, components(links))
    links = links.unionAll(keep(_confirmed(keep(_likely(apart, reps, limits), "pairs"), texts, limits), "links"))
    across = keep(_across(members, reps, components(links), limits), "pairs")
    links = links.unionAll(_confirmed(across, texts, limits))
    label = components(links).select(F.col("id").alias("rep"), "component")

    groups = keep(
        reps.select("key_1", "key_2", "rep")
        .join(label, "rep", "left")
        .select("key_1", "key_2", F.coalesce("component", "rep").alias("component_id")),
        "groups",
    )
    grouped = linkable.select("doc_id", "n_shingles", "key_1", "key_2").join(groups, ["key_1", "key_2"])
    alone = known.where("n_shingles = 0 or doc_id is null").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    return (
        grouped.select(columns)
        .unionAll(alone.select(columns))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def keep_one(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row of each group of ``docs``, that of the smallest id; rows without an id stay. Same columns.

    Rows of one id are copies if their texts are the same, and documents of their own if they are not.
    """
    mark = free_name(docs, "text_of_id")
    marked = _one_id_a_text(docs, mark)
    groups = near_duplicates(marked.select(F.col(mark).alias("doc_id"), "text"), percent)
    ids = marked.select(F.col(mark).alias("of"), F.col("doc_id").cast("long").alias("id")).distinct()
    members = keep(groups.select(F.col("doc_id").alias("of"), "component_id").distinct().join(ids, "of"), "grouped")
    first = members.groupBy("component_id").agg(F.min(F.struct("id", "of")).alias("first"))
    kept = first.select(F.col("first.of").alias(mark))
    chosen = marked.join(kept, mark, "left_semi").dropDuplicates([mark])
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return chosen.select(*columns).unionByName(docs.where("doc_id is null").select(*columns))


def _one_id_a_text(docs: DataFrame, mark: str) -> DataFrame:
    """The rows that have an id, with a number of their own for each id and text as ``mark``.

    It is the id, but for all texts of an id but one; so it keeps the order of ids, and a text that others are copies of, which often
    has a small one, is the first of its buckets.
    """
    text, of, first = F.xxhash64("text"), free_name(docs, "several_of"), free_name(docs, "several_first")
    known = docs.where("doc_id is not null")
    texts = known.select(F.col("doc_id").cast("long").alias(of), text.alias("text")).groupBy(of)
    several = texts.agg(F.min("text").alias(first), F.max("text").alias("last")).where(F.col(first) != F.col("last"))
    several = keep(several.drop("last"), "several")
    own = F.col("doc_id").cast("long")
    is_first = F.col(first).isNull() | (text == F.col(first))
    number = F.when(is_first, own).otherwise(F.xxhash64(own, text))
    return known.join(several, own == F.col(of), "left").withColumn(mark, number).drop(of, first)

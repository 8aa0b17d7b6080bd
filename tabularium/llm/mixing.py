"""Language-model scores by online logistic context mixing.

What is scored is a text's sequence of tokens: its words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased), each
spelled in bytes and followed by a space, and one end. Bytes are coded as six bits, the way down a
binary tree to one of the corpus's 63 commonest bytes; the others share a leaf, below which their own
eight bits follow, predicted in the same way; where no context has met any of them, they cost their share
of the corpus.

Every bit is predicted from several contexts, the last 3, 4 and 6 bytes. Each context has counts of the
bytes after it, gathered from all texts to learn from, whatever their number, and then frozen as
log odds. Contexts are told apart by their bytes, so their number grows with the corpus and none share counts.
The predictions are added up under weights, which a gate picks by which of the longer
contexts are known; after the bits of a tree the weights that were used move towards what would have
predicted them better. They start afresh every ``STRETCH`` bytes, so a long text is many short
ones to the machine, while contexts reach across. All stretches of a block go on abreast. A score is the sum of log10 probabilities of all
bits, and depends on the text and the corpus only.

Contexts are counted by block of texts first. Each block sends its distinct contexts, dealt over buckets by
hash, with the counts of what follows; a bucket adds up and sends every block the counts of its own contexts back.

Beside it stands the add-one unigram score of the same tokens. Word counts are gathered by hash. A word
counts in its block of texts (``BLOCK`` bytes, or one longer text) first, so what is shuffled is distinct
words of blocks, not words; and each block gets the counts of its own words back.

Null and empty texts are one end. Repeated rows are scored alike. With nothing to learn from, all bits
are even and every token's unigram share is one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tabularium.llm.arrow import Sent, send
from tabularium.llm.tables import keep
from tabularium.llm.words import VISIBLE, Piece, edges_of, lowered, pieces, visible, words_of

#: Bytes of context of each predictor; 6 at most, as a context and its predictor make a number of 50 bits.
ORDERS = (3, 4, 6)
DEPTH, BYTE_DEPTH = 6, 8
LEAVES = 1 << DEPTH
#: Text bytes in a block, in what a task works on at a time, and between fresh starts of the weights.
BLOCK, WORKED, STRETCH = 16 << 20, 2 << 20, 4096
#: Bytes whose contexts are looked up at a time while a block is mixed.
MET = 1 << 18
#: Weights to start with, by gate (none, one, both of the longer contexts are known); and their step.
START, STEP = ((0.7, 0.1, 0.0), (0.4, 0.4, 0.0), (0.25, 0.3, 0.3)), 0.01
#: What each side of a node has before anything is counted.
PRIOR = 0.02
#: Text bytes to a bucket of contexts, and the fewest buckets.
BUCKET, BUCKETS = 16 << 20, 64
#: Rows of words that a task packs together.
WORDS = 1 << 21
#: Contexts whose log odds are worked out at a time, and pairs of these and the bytes after them.
CHUNK, PAIRS = 1 << 14, 1 << 17
#: Pairs of contexts and bytes that a block holds besides its distinct ones.
HELD = 1 << 21

_END, _SPACE = 10, 32
_PAD = 8
_SPREAD, _AGAIN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Stream(NamedTuple):
    """Bytes to predict, text after text; each begins with ends that only serve as context."""

    data: np.ndarray
    firsts: np.ndarray  # of each text, the first byte to predict
    lasts: np.ndarray  # and the one after its last


def stream_of(piece: Piece) -> Stream:
    """Of each text its words, each with a space, and an end."""
    data = lowered(piece.data)
    kept = visible(data)
    _, ends = edges_of(piece, kept)
    closing = np.zeros(len(data) + 1, bool)
    closing[piece.bounds[1:]] = True
    open_end = np.zeros(len(piece.bounds) - 1, bool)  # a word, and nothing after it
    filled = np.flatnonzero(np.diff(piece.bounds))
    open_end[filled] = kept[piece.bounds[filled + 1] - 1]
    follow = ends[~closing[ends]]
    data[follow] = _SPACE
    kept[follow] = True
    data = data[kept]
    bounds = piece.bounds - np.searchsorted(np.flatnonzero(~kept), piece.bounds)
    sizes = np.diff(bounds) + open_end + 1
    lasts = np.cumsum(sizes + _PAD)
    firsts = lasts - sizes
    out = np.full(lasts[-1], _END, np.uint8)
    for first, a, b, space in zip(firsts.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), open_end, strict=True):
        out[first : first + b - a] = data[a:b]
        if space:
            out[first + b - a] = _SPACE
    return Stream(out, firsts, lasts)


def _joined(streams: list[Stream]) -> Stream:
    """One stream of several, one after the other."""
    starts = np.cumsum([0, *(len(stream.data) for stream in streams[:-1])])
    moved = [(stream.firsts + at, stream.lasts + at) for stream, at in zip(streams, starts, strict=True)]
    firsts, lasts = (np.concatenate(ends) for ends in zip(*moved, strict=True))
    return Stream(np.concatenate([stream.data for stream in streams]), firsts, lasts)


def befores(data: np.ndarray) -> np.ndarray:
    """The eight bytes before each byte from ``_PAD`` on, as a number, the nearest being the highest."""
    data = np.ascontiguousarray(data)
    return np.ndarray(len(data) - _PAD, "<u8", data, strides=(1,))


def _row_of(before: np.ndarray, number: int) -> np.ndarray:
    row = before >> np.uint64(64 - 8 * ORDERS[number])
    row |= np.uint64(number << 48)
    return row.view(np.int64)


def rows_of(before: np.ndarray) -> Iterator[np.ndarray]:
    """By predictor, the context of each of :func:`befores`, as a number."""
    for number in range(len(ORDERS)):
        yield _row_of(before, number)


class Alphabet:
    """Leaves of bytes, from how often they occur. Inner nodes are numbered from the root, level by level."""

    def __init__(self, counts: np.ndarray):
        common = np.sort(np.argsort(-counts, kind="stable")[: LEAVES - 1])
        self.leaf = np.full(256, LEAVES - 1, np.uint8)
        self.leaf[common] = np.arange(LEAVES - 1)
        rare = np.setdiff1d(np.arange(256), common)
        #: What a byte's side of a node in the shared leaf's tree has before anything is counted: 2 * PRIOR in all.
        self.share = np.zeros(256)
        self.share[rare] = (counts[rare] + 1) / (counts[rare] + 1).sum()
        #: Nats of a byte of the shared leaf where no context has seen any of these.
        self.extra = np.zeros(256)
        self.extra[rare] = -np.log(self.share[rare])

    @staticmethod
    def log_odds(owner: np.ndarray, leaf: np.ndarray, counts: np.ndarray, rows: int) -> np.ndarray:
        """Sixteenths of log odds of going right, row after row by node, from counts by row and leaf, in order of rows.

        Most contexts are followed by few bytes, so only nodes on the way to these are worked out; the others are even.
        """
        out = _aligned(rows * LEAVES)
        key = owner * LEAVES + leaf
        if (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, counts = key[order], counts[order]
        sums = counts.astype(np.float64)
        for level in reversed(range(DEPTH)):
            # what is below a node's two sides lies side by side
            parent = key >> 1
            first = np.flatnonzero(np.append(True, parent[1:] != parent[:-1])) if len(key) else np.empty(0, np.int64)
            right = np.where(key & 1, sums, 0)
            both, right = (np.add.reduceat(x, first) if len(first) else x[:0] for x in (sums, right))
            odds = np.log((right + PRIOR) / (both - right + PRIOR))
            key, sums = parent[first], both
            node = (key >> level) * LEAVES + (key & ((1 << level) - 1)) + (1 << level) - 1
            out[node] = np.clip(np.round(16 * odds), -127, 127).astype(np.int8)
        return out

    def rare_log_odds(self, counts: np.ndarray) -> np.ndarray:
        """The same in the tree of the shared leaf, by row and node, of rows of counts by byte."""

        def prior(level: int) -> np.ndarray:
            sides = self.share.reshape(1 << level, 2, -1).sum(axis=-1) + 1e-9
            return 2 * PRIOR * sides / sides.sum(axis=1, keepdims=True)

        return _log_odds(counts, BYTE_DEPTH, prior)


def _log_odds(counts: np.ndarray, depth: int, prior: Callable[[int], float | np.ndarray]) -> np.ndarray:
    sides = counts.reshape(-1, 1 << depth).astype(np.float64)
    out = np.zeros(sides.shape, np.int8)
    for level in reversed(range(depth)):
        two = sides.reshape(len(sides), 1 << level, 2)
        before = two + prior(level)
        odds = np.log(before[:, :, 1] / before[:, :, 0])
        out[:, (1 << level) - 1 : (2 << level) - 1] = np.clip(np.round(16 * odds), -127, 127)
        sides = two.sum(axis=-1)
    return out


def _aligned(size: int) -> np.ndarray:
    """Zero bytes of which each 64 lie in one line of the processor's cache."""
    room = np.zeros(size + 64, np.int8)
    begin = -room.ctypes.data % 64
    return room[begin : begin + size]


def _learned(batch: pa.RecordBatch) -> pa.Array:
    return batch["text"].filter(batch["learn"])


def byte_counts(docs: DataFrame) -> np.ndarray:
    """How often each byte occurs in the texts to learn from; white space counts as spaces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(256, np.int64)
        for batch in batches:
            texts = _learned(batch)
            counts[_END] += len(texts)
            for piece in pieces(texts):
                found = np.bincount(lowered(piece.data), minlength=256)
                counts += np.where(VISIBLE, found, 0)
                counts[_SPACE] += found[~VISIBLE].sum()
        yield pa.RecordBatch.from_pydict({"byte": np.arange(256), "n": counts})

    found = docs.select("text", "learn").mapInArrow(run, "byte long, n long")
    out = np.zeros(256, np.int64)
    for row in found.groupBy("byte").agg(F.sum("n").alias("n")).collect():
        out[row.byte] = row.n
    return out


_ASKED, _ANSWERED = "block long, bucket int, packed binary", "block long, packed binary"


class Counted(NamedTuple):
    """Contexts in order, how many bytes follow each, which ones, and how often."""

    keys: np.ndarray
    sizes: np.ndarray
    symbols: np.ndarray
    counts: np.ndarray

    def packed(self) -> bytes:
        """Steps between keys, and counts of as many bytes as the largest needs, are written by byte."""
        width = next(w for w in (1, 2, 4, 8) if int(self.counts.max(initial=0)) < 1 << 8 * w)
        parts = (
            _by_byte(np.diff(self.keys, prepend=0), 8),
            _by_byte(self.sizes, 2),
            self.symbols.tobytes(),
            _by_byte(self.counts, width),
        )
        head = np.array([len(self.keys), len(self.symbols), width], "<i8").tobytes()
        return head + pa.compress(b"".join(parts), codec="zstd", asbytes=True)


def _by_byte(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype(f"<i{width}").view(np.uint8).reshape(-1, width).T).tobytes()


def _unpacked(packed: bytes) -> Counted:
    keys, symbols, width = np.frombuffer(packed, "<i8", 3).tolist()
    sizes = [8 * keys, 2 * keys, symbols, width * symbols]
    data = np.frombuffer(pa.decompress(packed[24:], sum(sizes), codec="zstd"), np.uint8)
    parts = np.split(data, np.cumsum(sizes)[:-1])

    def whole(part: np.ndarray, wide: int) -> np.ndarray:
        return np.ascontiguousarray(part.reshape(wide, -1).T).view(f"<u{wide}").ravel().astype(np.int64)

    return Counted(np.cumsum(whole(parts[0], 8)), whole(parts[1], 2), parts[2], whole(parts[3], width))


def _merged(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in order, and the sum of each one's counts."""
    if not len(pairs):
        return pairs, counts
    order = np.argsort(pairs, kind="stable")
    pairs = pairs[order]
    first = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1])))
    return pairs[first], np.add.reduceat(counts[order], first)


def _distinct(values: np.ndarray) -> np.ndarray:
    """In order, as ``np.unique``, which hashes where it need not count and takes several times longer for it."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def _by_context(pairs: np.ndarray, counts: np.ndarray) -> Counted:
    keys, sizes = np.unique(pairs >> 8, return_counts=True)
    return Counted(keys, sizes, (pairs & 255).astype(np.uint8), counts)


def _inside(stream: Stream, texts: np.ndarray) -> np.ndarray:
    """Marks the bytes to predict of some texts, from ``_PAD`` on."""
    edges = np.zeros(len(stream.data) + 1, np.int8)
    edges[stream.firsts[texts]] += 1
    edges[stream.lasts[texts]] -= 1
    return np.cumsum(edges[:-1], dtype=np.int8)[_PAD:].view(bool)


def _longest_pairs(data: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of a longest context and the byte after it where marked, and how often each occurs."""
    key = befores(data) >> np.uint64(64 - 8 * ORDERS[-1])
    key <<= np.uint64(8)
    key |= data[_PAD:]
    return np.unique(key[mark].view(np.int64), return_counts=True)


def _all_pairs(longest: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of every predictor, in order; those of shorter contexts are sums of the longest ones'."""
    symbols, found = longest & 255, []
    for number, order in enumerate(ORDERS[:-1]):
        context = longest >> 8 * (1 + ORDERS[-1] - order) | number << 48
        found.append(_merged(context << 8 | symbols, counts))
    found.append((longest | (len(ORDERS) - 1) << 56, counts))
    pairs, sums = (np.concatenate(column) for column in zip(*found, strict=True))
    return pairs, sums


def _dealt(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of keys by bucket, as they come within one; the buckets that have any; and the bounds of these."""
    spread = keys * _SPREAD
    spread >>= np.uint64(32)
    spread *= np.uint64(buckets)
    spread >>= np.uint64(32)
    bucket = spread.astype(np.uint16 if buckets <= 1 << 16 else np.int32)
    del spread
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=1)
    found = np.flatnonzero(sizes)
    return order, found.astype(np.int32), np.append(0, np.cumsum(sizes[found]))


def block_contexts(blocks: DataFrame, buckets: int) -> DataFrame:
    """``block, bucket`` and packed counts: distinct contexts of each block and the bytes that follow them.

    What is only to be scored is there with a count of 0, so that its contexts are asked for too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        block = None

        def merge() -> None:
            if len(held) > 1:
                columns = [np.concatenate(column) for column in zip(*held, strict=True)]
                held[:] = [_merged(*columns)]

        def flush() -> pa.RecordBatch:
            merge()
            pairs, counts = _all_pairs(*held.pop())
            order, found, bounds = _dealt((pairs >> 8).view(np.uint64), buckets)
            parts = [order[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            rows = [_by_context(pairs[part], counts[part]).packed() for part in parts]
            return pa.RecordBatch.from_pydict(
                {"block": np.full(len(found), block), "bucket": found, "packed": pa.array(rows, pa.binary())}
            )

        for batch in batches:
            own = batch["block"].to_numpy()
            learn = batch["learn"].to_numpy(zero_copy_only=False).astype(bool)
            edges = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                if held and own[a] != block:
                    yield flush()
                block = own[a]
                for piece in pieces(batch["text"].slice(a, b - a), WORKED):
                    stream = stream_of(piece)
                    taught = learn[a + piece.first : a + piece.last]
                    marks = [_inside(stream, taught), _inside(stream, ~taught)]
                    for mark, times in zip(marks, (1, 0), strict=True):
                        found, counts = _longest_pairs(stream.data, mark)
                        held.append((found, counts * times))
                    if sum(len(found) for found, _ in held[1:]) > max(HELD, len(held[0][0])):
                        merge()
        if held:
            yield flush()

    return blocks.select("block", "text", "learn").mapInArrow(run, _ASKED)


def _answers(asked: pa.Table) -> pa.Table:
    """Of a bucket: for each block, its contexts with their counts in all blocks."""
    rows = [_unpacked(packed) for packed in asked["packed"].to_pylist()]
    pairs = np.concatenate([np.repeat(row.keys, row.sizes) << 8 | row.symbols for row in rows])
    pairs, counts = _merged(pairs, np.concatenate([row.counts for row in rows]))
    total = _by_context(pairs[counts > 0], counts[counts > 0])
    first = np.cumsum(total.sizes) - total.sizes
    out = []
    for row in rows:
        at = np.searchsorted(total.keys, row.keys)
        known = at < len(total.keys)
        known[known] = total.keys[at[known]] == row.keys[known]
        at = at[known]
        sizes = total.sizes[at]
        where = np.repeat(first[at] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        out.append(Counted(total.keys[at], sizes, total.symbols[where], total.counts[where]).packed())
    return pa.table({"block": asked["block"], "packed": pa.array(out, pa.binary())})


def block_counts(blocks: DataFrame) -> DataFrame:
    """``block`` and packed counts: of each block's contexts, how often each byte follows in all texts to learn from."""
    size = blocks.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    asked = block_contexts(blocks, max(BUCKETS, -(-size // BUCKET)))
    return asked.groupBy("bucket").applyInArrow(_answers, _ANSWERED)


class Index:
    """Places of distinct numbers in order, the first of which stands for all that are not there."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.slots, lost = self._slots(np.arange(1, len(keys)), _SPREAD)
        self.more, _ = self._slots(lost, _AGAIN)  # of those of which another one has the slot

    def _slots(self, places: np.ndarray, spread: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        """Places by a hash of their numbers, and those for which there was no room."""
        slots = np.zeros(1 << max(10, len(places).bit_length() + 2), np.int32)
        at = _slot(self.keys[places], spread, slots)
        slots[at] = places
        return slots, places[slots[at] != places]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each number, 0 if it has none; few share both slots with others, and those are searched for."""
        out = _picked(self.slots, _slot(keys, _SPREAD, self.slots)).astype(np.int64)
        other = np.flatnonzero((_picked(self.keys, out) != keys) & (out > 0))
        if len(other):
            asked = keys[other]
            again = self.more[_slot(asked, _AGAIN, self.more)].astype(np.int64)
            out[other] = again
            still = np.flatnonzero((self.keys[again] != asked) & (again > 0))
            asked = asked[still]
            at = np.minimum(np.searchsorted(self.keys[1:], asked) + 1, len(self.keys) - 1)
            out[other[still]] = np.where(self.keys[at] == asked, at, 0)
        return out


class Contexts:
    """Log odds of known contexts, by row; row 0 is that of all others."""

    def __init__(self, alphabet: Alphabet, counted: Counted):
        # a context that was asked for twice counts once
        order = np.argsort(counted.keys, kind="stable")
        keys = counted.keys[order]
        once = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.empty(0, bool)
        order = order[once]
        n = len(order)
        self.keys = np.append(np.int64(-1), keys[once])
        self.table = _aligned((n + 1) * LEAVES)
        begins = np.cumsum(counted.sizes) - counted.sizes
        rare: list[tuple[np.ndarray, ...]] = []
        # so few pairs at a time that what is worked out for them is small beside the table
        ends = np.cumsum(counted.sizes[order])
        first = last = 0
        while last < n:
            first, met = last, int(ends[last - 1]) if last else 0
            last = max(first + 1, min(first + CHUNK, int(np.searchsorted(ends, met + PAIRS, "right"))))
            part = order[first:last]
            sizes = counted.sizes[part]
            owner = np.repeat(np.arange(len(part)), sizes)
            where = np.repeat(begins[part] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(owner))
            symbols, counts = counted.symbols[where], counted.counts[where]
            leaf = alphabet.leaf[symbols]
            begin = (first + 1) * LEAVES
            self.table[begin : begin + len(part) * LEAVES] = alphabet.log_odds(owner, leaf, counts, len(part))
            few = np.flatnonzero(leaf == LEAVES - 1)
            rare.append((owner[few] + first + 1, symbols[few], counts[few]))
        nothing = (np.empty(0, np.int64), np.empty(0, np.uint8), np.empty(0, np.int64))
        owner, symbols, counts = (np.concatenate(column) for column in zip(nothing, *rare, strict=True))
        found, place = np.unique(owner, return_inverse=True)
        self.rare_row = np.zeros(n + 1, np.int32)
        self.rare_row[found] = np.arange(1, len(found) + 1)
        self.rare = self._rows(
            alphabet.rare_log_odds, place + 1, symbols, counts, len(found) + 1, 1 << BYTE_DEPTH
        )
        #: Whether a context's first node is not even.
        self.known = (self.table[::LEAVES] != 0).view(np.int8)
        self.shorter = self._shorter()
        self.index = Index(self.keys)

    def _shorter(self) -> np.ndarray:
        """By row, that of the next shorter context, which the longer one ends in."""
        out = np.zeros(len(self.keys), np.int32)
        bounds = np.searchsorted(self.keys, np.arange(len(ORDERS) + 1) << 48)
        for number in range(1, len(ORDERS)):
            a, b = bounds[number : number + 2]
            cut = 8 * (ORDERS[number] - ORDERS[number - 1])
            keys = (self.keys[a:b] & (1 << 48) - 1) >> cut | number - 1 << 48
            at = np.searchsorted(self.keys, keys)
            out[a:b] = np.where(self.keys[at] == keys, at, 0)
        return out

    @staticmethod
    def _rows(odds, owner: np.ndarray, leaf: np.ndarray, counts: np.ndarray, n: int, width: int) -> np.ndarray:
        """Log odds by row, as one; owners are in order."""
        out = np.empty(n * width, np.int8)
        for first in range(0, n, CHUNK):
            last = min(n, first + CHUNK)
            part = slice(*np.searchsorted(owner, [first, last]))
            where = (owner[part] - first) * width + leaf[part]
            dense = np.bincount(where, counts[part], (last - first) * width)
            out[first * width : last * width] = odds(dense).ravel()
        return out

    def rows(self, before: np.ndarray) -> np.ndarray:
        """By predictor, the row of each of :func:`befores`. Only the longest are looked up where they are known."""
        last = len(ORDERS) - 1
        out = np.empty((last + 1, len(before)), np.int64)
        out[last] = self.index.find(_row_of(before, last))
        for number in reversed(range(last)):
            out[number] = _picked(self.shorter, out[number + 1])
            unknown = np.flatnonzero(out[number + 1] == 0)
            out[number, unknown] = self.index.find(_row_of(before[unknown], number))
        return out


def _picked(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Values of the last axis at places that are all there: ``wrap`` is numpy's fastest way, and wraps none here."""
    return values.take(at, axis=-1, mode="wrap")


def _slot(keys: np.ndarray, spread: np.uint64, slots: np.ndarray) -> np.ndarray:
    return ((keys.view(np.uint64) * spread) >> np.uint64(65 - len(slots).bit_length())).view(np.int64)


def _all(rows: pa.Table) -> Counted:
    empty = Counted(*(np.empty(0, kind) for kind in (np.int64, np.int64, np.uint8, np.int64)))
    found = [_unpacked(packed) for packed in rows["packed"].to_pylist()]
    return Counted(*(np.concatenate(column) for column in zip(empty, *found, strict=True)))


class Mixer(NamedTuple):
    alphabet: Alphabet
    contexts: Contexts

    def nats(self, stream: Stream) -> np.ndarray:
        """The cost of each text."""
        firsts = [np.arange(a, b, STRETCH) for a, b in zip(stream.firsts, stream.lasts, strict=True)]
        owner = np.repeat(np.arange(len(firsts)), [len(f) for f in firsts])
        first = np.concatenate(firsts)
        size = np.minimum(STRETCH, stream.lasts[owner] - first)
        # stretches abreast, the longest first, so that those at work are always the first ones
        order = np.argsort(-size, kind="stable")
        first, size = first[order], size[order]
        # inputs are sixteenths of log odds: weights and steps are scaled to match
        weights = np.repeat(np.array(START, np.float32).T / 16, len(order), axis=1)
        cost = np.zeros(len(order))
        busy = np.searchsorted(-size, -np.arange(size[0]), "left")
        met = np.concatenate(([0], np.cumsum(busy)))  # bytes that all have met before each place
        place = 0
        while place < len(busy):
            end = max(place + 1, int(np.searchsorted(met, met[place] + MET, "right")) - 1)
            self._advance(stream.data, first, weights, cost, place, busy[place:end])
            place = end
        return np.bincount(owner[order], cost, len(firsts))

    def _advance(
        self, data: np.ndarray, first: np.ndarray, weights: np.ndarray, nats: np.ndarray, place: int, busy: np.ndarray
    ) -> None:
        """All stretches go on from a place, so many of them at each step; their cost is added, and weights move."""
        alphabet, table, lanes = self.alphabet, self.contexts.table, len(first)
        # bytes in the order in which they are met: the first of all stretches, the second, and so on
        edge = np.concatenate(([0], np.cumsum(busy)))
        lane = np.arange(edge[-1]) - np.repeat(edge[:-1], busy)
        at = first.take(lane)
        at += np.repeat(np.arange(place, place + len(busy)), busy)
        leaf = alphabet.leaf.take(_picked(data, at))
        node, sign = _path(leaf, DEPTH)
        rows = self.contexts.rows(befores(data)[at - _PAD])
        rare = np.flatnonzero(leaf == LEAVES - 1)
        met = self.contexts.rare_row[rows[:, rare]].any(axis=0)
        unmet, rare = rare[~met], rare[met]
        rare_node, rare_sign = _path(data[at[rare]], BYTE_DEPTH)
        rare_rows = self.contexts.rare_row[rows[:, rare]].astype(np.int64) << BYTE_DEPTH
        rare_edge = np.searchsorted(rare, edge).tolist()
        gate = _picked(self.contexts.known, rows[1:]).sum(axis=0, dtype=np.int64) * lanes + lane  # and lane
        rows *= LEAVES
        rate, least = np.float32(STEP / 256), np.float32(1e-6)
        nats += np.bincount(lane[unmet], alphabet.extra[data[at[unmet]]], lanes)

        def cost(now: np.ndarray, x: np.ndarray) -> np.ndarray:
            """Of the bits of a tree, from log odds of the sides not taken; the weights move."""
            used = _picked(weights, now)
            right = used[0] * x[0]
            for weight, odds in zip(used[1:], x[1:], strict=True):
                right += weight * odds
            np.exp(right, out=right)
            right += 1
            np.reciprocal(right, out=right)
            used += rate * np.einsum("dn,kdn->kn", right - 1, x)
            for row, new in zip(weights, used, strict=True):
                row[now] = new
            # never quite sure, so that no bit costs more than some 20 bits
            right *= 1 - 2 * least
            right += least
            return -np.log(right.prod(axis=0))

        for t, n in enumerate(busy.tolist()):
            part = slice(edge[t], edge[t + 1])
            x = _picked(table, rows[:, None, part] + node[:, part])
            x *= sign[:, part]
            nats[:n] += cost(gate[part], x.astype(np.float32))
            if rare_edge[t] < rare_edge[t + 1]:
                part = slice(rare_edge[t], rare_edge[t + 1])
                x = self.contexts.rare.take(rare_rows[:, None, part] + rare_node[:, part])
                x *= rare_sign[:, part]
                nats[lane[rare[part]]] += cost(gate[rare[part]], x.astype(np.float32))


def _path(leaf: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The nodes on the way to each leaf, and which side is not taken: 1 is right, -1 left."""
    level = np.arange(depth)[:, None]
    node = (leaf + np.int64(1 << depth)) >> depth - level
    node -= 1
    sign = (leaf >> (depth - 1 - level).astype(np.uint8) & np.uint8(1)).view(np.int8)
    sign *= -2
    sign += 1
    return node, sign


def in_blocks(docs: DataFrame) -> DataFrame:
    """``block, doc_id, text, learn``, written: rows of a block follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, size = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for piece in pieces(batch["text"], BLOCK // 4):
                if size and size + len(piece.data) > BLOCK:
                    number, size = number + 1, 0
                size += len(piece.data)
                part = batch.slice(piece.first, piece.last - piece.first)
                block = pa.array(np.full(part.num_rows, (task << 32) + number))
                yield pa.RecordBatch.from_arrays([block, *part.columns], ["block", *part.schema.names])

    rows = docs.select("doc_id", "text", "learn")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return keep(rows.mapInArrow(run, f"block long, doc_id {kind}, text string, learn boolean"), "blocks")


def block_words(blocks: DataFrame) -> DataFrame:
    """``block, word, n``: distinct words of each block, by hash, and how often they are to be learned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        block = None

        def flush() -> pa.RecordBatch:
            # hashes alone sort several times faster than with the places they came from
            words, taught = (np.concatenate(column) for column in zip(*held, strict=True))
            learned, n = np.unique(words[taught], return_counts=True)
            others = np.setdiff1d(_distinct(words[~taught]), learned, assume_unique=True)
            word, n = np.concatenate((learned, others)), np.concatenate((n, np.zeros(len(others), np.int64)))
            return pa.RecordBatch.from_pydict({"block": np.full(len(word), block), "word": word.view(np.int64), "n": n})

        for batch in batches:
            own = batch["block"].to_numpy()
            learn = batch["learn"].to_numpy(zero_copy_only=False).astype(bool)
            edges = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                if held and own[a] != block:
                    yield flush()
                    held = []
                block = own[a]
                for piece in pieces(batch["text"].slice(a, b - a)):
                    words = words_of(piece, VISIBLE)
                    text = np.repeat(np.arange(len(piece.bounds) - 1), np.diff(words.bounds))
                    held.append((words.hashes, learn[a + piece.first :][text]))
        if held:
            yield flush()

    return blocks.select("block", "text", "learn").mapInArrow(run, "block long, word long, n long")


def _counted(words: DataFrame) -> DataFrame:
    """``block, word, c, first, own`` of words to be learned: the count in all blocks, whether this is the word's
    first block, and whether it is its only one.

    A word has one row per block, whatever its count, so even the commonest is a small share of a task.
    """
    everywhere = Window.partitionBy("word")
    counted = words.select(
        "block", "word", "n", F.sum("n").over(everywhere).alias("c"), F.min("block").over(everywhere).alias("least")
    )
    return counted.where("c > 0").select(
        "block", "word", "c", (F.col("block") == F.col("least")).alias("first"), (F.col("c") == F.col("n")).alias("own")
    )


def packed_words(words: DataFrame) -> DataFrame:
    """``block, packed`` of ``block, word, c``: the words of a block in each task, packed as contexts with one byte each."""

    def rows(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        block, word, count = (
            np.concatenate([batch[name].to_numpy() for batch in held]) for name in ("block", "word", "c")
        )
        order = np.lexsort((word, block))
        block, word, count = block[order], word[order], count[order]
        found, first = np.unique(block, return_index=True)
        out = []
        for a, b in zip(first, np.append(first[1:], len(block)), strict=True):
            ones, none = np.ones(b - a, np.int64), np.zeros(b - a, np.uint8)
            out.append(Counted(word[a:b], ones, none, count[a:b]).packed())
        return pa.RecordBatch.from_pydict({"block": found, "packed": pa.array(out, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= WORDS:
                yield rows(held)
                held, size = [], 0
        if size:
            yield rows(held)

    return words.select("block", "word", "c").mapInArrow(run, _ANSWERED)


class Totals(NamedTuple):
    """Tokens to learn from, how many are distinct, and how many are ends."""

    tokens: int
    distinct: int
    ends: int


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of ``doc_id, text, learn``.

    ``learn`` (not null) marks the rows to learn from; all are scored.
    """
    spark = docs.sparkSession
    blocks = in_blocks(docs)
    alphabet = Alphabet(byte_counts(blocks))

    words = keep(_counted(block_words(blocks)), "words")
    ends = blocks.where("learn").count()
    sums = words.where("first").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    totals = Totals(sums.n + ends, sums.v + bool(ends), ends)
    shared = packed_words(words.where("not own")).withColumn("words", F.lit(True))
    answers = block_counts(blocks).withColumn("words", F.lit(False))

    sent = send(spark, (alphabet, totals))
    kind = blocks.schema["doc_id"].dataType.simpleString()
    return (
        blocks.select("block", "doc_id", "text", "learn")
        .groupBy("block")
        .cogroup(shared.unionAll(answers).groupBy("block"))
        .applyInArrow(
            _block_scores(sent),
            f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )


def _counts(tokens: np.ndarray, learn: np.ndarray, word: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The count of each token: from the words that blocks share, or else from its own block's tokens."""
    if not len(tokens):
        return np.zeros(0, np.int64)
    here, n = np.unique(tokens[learn], return_counts=True)
    # all of one kind: numpy would join whole numbers with and without sign as doubles, which do not tell hashes apart
    distinct = np.concatenate((np.zeros(1, np.uint64), _distinct(np.concatenate((here, word)))))
    out = np.zeros(len(distinct), np.int64)
    out[np.searchsorted(distinct[1:], here) + 1] = n
    out[np.searchsorted(distinct[1:], word) + 1] = count
    return out.take(Index(distinct).find(tokens))


def _base_scores(
    columns: list[pa.Array], learn: np.ndarray, shared: Counted, totals: Totals
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text of a block its tokens, how many of them are known, and the unigram score."""
    n, hashes = [], []
    for column in columns:
        for piece in pieces(column):
            words = words_of(piece, VISIBLE)
            n.append(np.diff(words.bounds))
            hashes.append(words.hashes)
    n = np.concatenate(n)
    owner = np.repeat(np.arange(len(n)), n)
    word = shared.keys.view(np.uint64)
    order = np.argsort(word)
    c = _counts(np.concatenate(hashes), learn[owner], word[order], shared.counts[order])
    logs = np.bincount(owner, np.log10(c + 1.0), len(n)) + math.log10(totals.ends + 1)
    base = logs - (n + 1) * math.log10(totals.tokens + totals.distinct + 1)
    known = np.bincount(owner, c > 0, len(n)).astype(np.int64) + bool(totals.ends)
    return n + 1, known, base


def _block_scores(sent: Sent) -> Callable[[pa.Table, pa.Table], pa.Table]:
    unpacked: list = []  # once per task

    def run(docs: pa.Table, counts: pa.Table) -> pa.Table:
        if not unpacked:
            unpacked.append(sent.value)
        alphabet, totals = unpacked[0]
        texts = docs["text"].combine_chunks()
        columns = texts.chunks if isinstance(texts, pa.ChunkedArray) else [texts]
        # the words go before contexts come
        tokens, known, base = _base_scores(columns, docs["learn"].to_numpy(), _all(counts.filter(counts["words"])), totals)
        mixer = Mixer(alphabet, Contexts(alphabet, _all(counts.filter(pc.invert(counts["words"])))))
        whole = _joined([stream_of(piece) for column in columns for piece in pieces(column, WORKED)])
        scores = -mixer.nats(whole) / math.log(10)
        return pa.table(
            {
                "doc_id": docs["doc_id"],
                "n_tokens": tokens,
                "n_known": known,
                "train_tokens": np.full(len(tokens), totals.tokens),
                "base_score": base,
                "score": scores,
            }
        )

    return run

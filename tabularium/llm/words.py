"""Words of many texts at once, as 64-bit hashes, with numpy on Arrow's own buffers.

A text column is walked in pieces of whole texts (:func:`pieces`), so memory is bounded by
``PIECE`` bytes, or by the longest single text, whatever the size of an Arrow batch. Null texts
count as empty. Two different words share a hash with probability about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from tabularium.llm.arrow import lasting

#: Bytes of text that are worked on at a time.
PIECE = 1 << 19

_STEP = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_UNSTEP = pow(_STEP, -1, 1 << 64)
_VALUES = np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 64, 256, np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _table(member) -> np.ndarray:
    return np.array([member(byte) for byte in range(256)])


#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z is lower case.
ALNUM = _table(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
#: Bytes of words ``[^\x20\x09-\x0D]+``.
VISIBLE = _table(lambda b: b != 32 and not 9 <= b <= 13)


class Piece(NamedTuple):
    """Texts ``first`` to ``last`` of a column: their bytes, and where each text begins in them."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray


class Words(NamedTuple):
    """Words of a piece: first byte, byte after the last, hash, and where each text's words begin."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray


def pieces(texts: pa.Array, size: int = PIECE) -> Iterator[Piece]:
    """The column in runs of whole texts of at most ``size`` bytes, or of one longer text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield Piece(
            first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        )
        first = last


def lowered(data: np.ndarray) -> np.ndarray:
    """``LOWER[data]``, worked out: numpy is several times faster at that than at looking up bytes."""
    upper = data - np.uint8(65) < 26
    return data | upper.view(np.uint8) << np.uint8(5)


def visible(data: np.ndarray) -> np.ndarray:
    """``VISIBLE[data]``, worked out."""
    return (data != 32) & (data - np.uint8(9) > 4)


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse; kept for the next piece."""
    kept = lasting()
    if "powers" not in kept or len(kept["powers"][0]) < n:
        steps = (np.full(n + n // 4, base, np.uint64) for base in (_STEP, _UNSTEP))
        made = []
        for powers in steps:
            powers[0] = 1
            made.append(np.cumprod(powers, dtype=np.uint64))
        kept["powers"] = made
    one, other = kept["powers"]
    return one[:n], other[:n]


def mixed(values: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit values."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes from each start to each end."""
    powers, inverses = _powers_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * powers[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverses[starts])


def hash_runs(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the words from each start to each end, in their order."""
    powers, inverses = _powers_to(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverses[starts])


def edges_of(piece: Piece, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end, from a mark on each byte that belongs to one."""
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = piece.bounds[:-1][piece.bounds[:-1] < len(inside)]
    begins[edges] = inside[edges]  # a word never runs from one text into the next
    edges = edges[edges > 0] - 1
    closes[edges] = inside[edges]
    return np.flatnonzero(begins), np.flatnonzero(closes) + 1


def words_of(piece: Piece, member: np.ndarray) -> Words:
    """The words of lower-cased texts, made of the bytes that ``member`` marks."""
    data = lowered(piece.data)
    starts, ends = edges_of(piece, member[data])
    return Words(
        starts, ends, span_hashes(data, starts, ends), np.searchsorted(starts, piece.bounds)
    )


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """The hash of each run of ``length`` words, by its first word."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, length, np.uint64)
    for k in range(length):
        total = total * np.uint64(0xD1342543DE82EF95) + hashes[k : k + n]
    return mixed(total)

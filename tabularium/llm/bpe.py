"""Byte-level BPE by speculation: guess a word's tokens, check the guess, merge only where it fails.

A word's greedy longest-match tokens are its exact BPE tokens if and only if each token is what
its own bytes merge to and no two neighbours would have merged otherwise. The second condition
depends on two tokens only, so it is checked for all distinct pairs of a batch of words at once,
by undoing merges at the seam, latest first, and looking for an earlier merge across it. Words
that fail are merged step by step in rank order. Words are kept in a bounded memory of each
Python worker, as text repeats them.

Null and empty texts have no tokens. The vocabulary is a tokenizer file of the ``tokenizers``
library (byte-level BPE, no normaliser); it is read on the driver and broadcast, a few MB whatever
the data. Strings of its added tokens are single tokens wherever they occur, as in that library.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession

from tabularium.llm.arrow import batchwise, lasting

#: Fixed value: how byte-level BPE of this family splits text into words.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Distinct words that a worker remembers; beyond it starts afresh.
REMEMBERED = 400_000
_NEVER = np.int64(1) << 40
_SHAPE = 4


def _byte_characters() -> dict[str, int]:
    """The visible character that stands for each byte in the file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Codec:
    """Tokens, merges and the words met so far."""

    def __init__(self, file: str):
        content = json.loads(file)
        if content["normalizer"] or content["model"].get("byte_fallback"):
            raise ValueError("only byte-level BPE without a normaliser is read")
        bytes_of = _byte_characters()
        vocabulary = {
            bytes(bytes_of[c] for c in token): i for token, i in content["model"]["vocab"].items()
        }
        self.added = {}
        for token in content["added_tokens"]:
            if token["single_word"] or token["lstrip"] or token["rstrip"]:
                raise ValueError(f"added token with conditions: {token['content']}")
            self.added[token["content"]] = token["id"]
        size = max([*vocabulary.values(), *self.added.values()], default=-1) + 1
        self.spelled = [b""] * size
        for token, i in vocabulary.items():
            self.spelled[i] = token
        for token, i in self.added.items():
            self.spelled[i] = token.encode()
        self.ids = vocabulary
        self.shapes: dict[bytes, int] = {}  # the longest token that begins with these bytes
        for token in vocabulary:
            start = token[:_SHAPE]
            self.shapes[start] = max(len(token), self.shapes.get(start, 0))
        self.single = np.array([vocabulary.get(bytes([byte]), -1) for byte in range(256)], np.int64)
        merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        whole = np.ones(size, bool)  # whether a token is what its bytes merge to
        for rank, merge in enumerate(content["model"]["merges"]):
            parts = merge if isinstance(merge, list) else merge.split(" ")
            a, b = (vocabulary[bytes(bytes_of[c] for c in part)] for part in parts)
            made = vocabulary[self.spelled[a] + self.spelled[b]]
            merges[a, b] = rank, made
            if self.rank[made] >= 0:
                whole[made] = False  # two ways to make it: leave it to exact merging
            else:
                self.rank[made], self.left[made], self.right[made] = rank, a, b
        keys = np.array([a * size + b for a, b in merges], np.int64)
        order = np.argsort(keys)
        ranked = np.array(list(merges.values()), np.int64).reshape(-1, 2)[order]
        self.keys, self.key_ranks, self.products = keys[order], ranked[:, 0], ranked[:, 1]
        made = self.rank >= 0
        whole &= made | np.array([len(token) == 1 for token in self.spelled])
        sound = np.ones(size, bool)
        sound[made] = self.compatible(self.left[made], self.right[made], self.rank[made])
        for i in np.argsort(self.rank, kind="stable"):
            if self.rank[i] >= 0:
                whole[i] &= sound[i] & whole[self.left[i]] & whole[self.right[i]]
        self.whole = whole
        self.words: dict[str, bytes] = {}
        self.split = regex.compile(SPLIT)
        self.stops = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
            if self.added
            else None
        )
        self.guessed = self.failed = 0

    def merge_of(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of merging each ``a`` with its ``b``; ``_NEVER`` where there is none."""
        if not len(self.keys):
            return np.full(len(a), _NEVER), np.zeros(len(a), np.int64)
        key = a * len(self.rank) + b
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[place] == key, self.key_ranks[place], _NEVER), self.products[place]

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether ``a`` followed by ``b`` stays as it is, for merges of ranks below ``limit``."""
        fits = np.ones(len(a), bool)
        at = np.arange(len(a))  # pairs still open
        x, y = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), _NEVER) if limit is None else limit.astype(np.int64)
        while len(at):
            crossing = self.merge_of(x, y)[0] < limit
            fits[at[crossing]] = False
            rank_x, rank_y = self.rank[x], self.rank[y]
            go = ~crossing & ((rank_x >= 0) | (rank_y >= 0))
            at, x, y, rank_x, rank_y = at[go], x[go], y[go], rank_x[go], rank_y[go]
            undo_x = rank_x > rank_y
            # of equal merges the left one is first: a crossing one precedes that of y, not of x
            limit = np.where(undo_x, rank_x, rank_y + 1)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return fits

    def greedy(self, word: bytes) -> list[int] | None:
        """Longest known prefix, again and again; None where no token fits."""
        out, start, n = [], 0, len(word)
        ids, shapes = self.ids, self.shapes
        while start < n:
            end = min(n, start + shapes.get(word[start : start + _SHAPE], _SHAPE - 1))
            while (found := ids.get(word[start:end])) is None:
                end -= 1
                if end == start:
                    return None
            out.append(found)
            start = end
        return out

    def merged(self, words: list[bytes]) -> list[bytes]:
        """Packed ids by exact merging, all words abreast: each round does every word's next merge in rank order.

        Bytes without a token are left out, as they have no id.
        """
        out = [b""] * len(words)
        token = self.single[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), [len(word) for word in words])[token >= 0]
        token = token[token >= 0]
        while len(token):
            rank, made = np.full(len(token), _NEVER), np.empty(len(token), np.int64)
            seam = np.flatnonzero(owner[1:] == owner[:-1])
            rank[seam], made[seam] = self.merge_of(token[seam], token[seam + 1])
            firsts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            best = np.minimum.reduceat(rank, firsts)
            sizes = np.diff(np.append(firsts, len(token)))
            chosen = (rank == np.repeat(best, sizes)) & (rank < _NEVER)
            # of overlapping merges, as in "aaa", the first, the third and so on
            index = np.arange(len(token))
            before = np.maximum.accumulate(np.where(chosen, -1, index))
            chosen &= (index - before) % 2 == 1
            done, packed = np.flatnonzero(best == _NEVER), token.astype("<u4").tobytes()
            ends = (firsts + sizes)[done].tolist()
            for k, first, end in zip(owner[firsts[done]].tolist(), firsts[done].tolist(), ends, strict=True):
                out[k] = packed[4 * first : 4 * end]
            token = np.where(chosen, made, token)
            keep = np.repeat(best < _NEVER, sizes)
            keep[1:] &= ~chosen[:-1]
            token, owner = token[keep], owner[keep]
        return out

    def learn(self, words: Iterable[str]) -> None:
        """Encode words that are not remembered yet: all guesses first, then one check of all."""
        words = list(words)
        spelled = [word.encode() for word in words]
        guesses = [self.greedy(word) for word in spelled]
        lengths = np.array([len(g) if g else 0 for g in guesses], np.int64)
        flat = np.fromiter(chain.from_iterable(g for g in guesses if g), np.int64, lengths.sum())
        owner = np.repeat(np.arange(len(words)), lengths)
        bad = np.array([g is None for g in guesses], bool)
        bad[owner[~self.whole[flat]]] = True
        seam = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, where = np.unique(flat[seam] * len(self.rank) + flat[seam + 1], return_inverse=True)
        fits = self.compatible(*np.divmod(pairs, len(self.rank)))
        bad[owner[seam[~fits[where]]]] = True
        self.guessed += len(words)
        self.failed += int(bad.sum())
        packed, ends = flat.astype("<u4").tobytes(), (4 * np.cumsum(lengths)).tolist()
        self.words.update(zip(words, map(packed.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))
        failing = np.flatnonzero(bad).tolist()
        for k, ids in zip(failing, self.merged([spelled[k] for k in failing]), strict=True):
            self.words[words[k]] = ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers, one after the other."""
        cut = []
        for text in texts:
            parts = self.stops.split(text) if self.stops else [text]
            cut.append([[part] if k % 2 else self.split.findall(part) for k, part in enumerate(parts)])
        if len(self.words) > REMEMBERED:
            self.words.clear()
        met = set().union(*(words for parts in cut for words in parts[::2]))
        if new := [word for word in met if word not in self.words]:
            self.learn(new)
        special = {token: np.array([i], "<u4").tobytes() for token, i in self.added.items()}
        out = []
        for parts in cut:
            found = [
                b"".join(map((special if k % 2 else self.words).__getitem__, words))
                for k, words in enumerate(parts)
            ]
            out.append(b"".join(found))
        return out

    def decode(self, ids: bytes) -> str:
        """The text of packed ids; bytes that are no UTF-8 become U+FFFD. Unknown ids have none."""
        spelled, known = self.spelled, len(self.spelled)
        return b"".join(
            [spelled[i] if i < known else b"" for i in np.frombuffer(ids, "<u4").tolist()]
        ).decode(errors="replace")


def _codec(file: Broadcast) -> Codec:
    """One codec per Python process, for the file it was last asked for."""
    kept = lasting()
    if kept.get("tokenizer") != file.value:
        kept["tokenizer"], kept["codec"] = file.value, Codec(file.value)
    return kept["codec"]


def read_tokenizer(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer file for :func:`encode` and :func:`decode`."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


#: Texts are taken in slices of so many characters, so a batch of long ones stays small.
SLICE = 1 << 20


def _slices(texts: pa.Array) -> Iterator[list[str]]:
    taken, size = [], 0
    for text in texts:
        taken.append(text.as_py() or "")
        size += len(taken[-1])
        if size >= SLICE:
            yield taken
            taken, size = [], 0
    yield taken


def encode(text: Column, tokenizer: Broadcast) -> Column:
    """Ids as binary: each a little-endian unsigned 32-bit integer. Never null."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(tokenizer)
        for batch in batches:
            yield pa.array([ids for part in _slices(batch) for ids in codec.encode(part)], pa.binary())

    return batchwise("binary", run)(text)


def encode_decode(text: Column, tokenizer: Broadcast) -> Column:
    """``struct<ids, text>``: what :func:`encode` gives, and its text again, in one Python worker."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(tokenizer)
        for batch in batches:
            ids = pa.array([ids for part in _slices(batch) for ids in codec.encode(part)], pa.binary())
            texts = pa.array([codec.decode(x.as_py()) for x in ids], pa.string())
            yield pa.StructArray.from_arrays([ids, texts], ["ids", "text"])

    return batchwise("struct<ids: binary, text: string>", run)(text)


def decode(ids: Column, tokenizer: Broadcast) -> Column:
    """The text of ids as :func:`encode` gives them; null ids give an empty text."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(tokenizer)
        for batch in batches:
            yield pa.array([codec.decode(x.as_py() or b"") for x in batch], pa.string())

    return batchwise("string", run)(ids)

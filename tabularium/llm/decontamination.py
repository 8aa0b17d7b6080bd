"""Benchmark passages in training texts, found by a generalised suffix automaton of the items.

The automaton holds every run of words of every item. A text's words stream through it, and after
each word its state tells the longest run of words ending there that occurs in some item. A word
is *hit* if it lies in an occurrence of a window: ``window`` consecutive words of one item, or a
whole item of fewer words (but not none). So a match of at least ``window`` words hits all of
them, and a shorter one those of the short items that end there.

Words are lower-cased (A-Z) runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``. Two cheap tests come before
the automaton and change nothing: where two neighbouring words are neighbours in no item, the
longest match is at most one word, so only runs of neighbours that reach the shortest window are
streamed.

Null texts and texts without words have no words, no hits and are kept. Null items and items
without words have no windows; items with a null id hit words, but are not listed. Rows that
repeat an item count once. Without items nothing is hit.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabularium.llm.arrow import Sent, batchwise_pairs, free_name, send
from tabularium.llm.tables import keep, release
from tabularium.llm.words import ALNUM, Piece, Words, pieces, words_of

#: Item words in one automaton. A larger benchmark is split by item into several, which are
#: broadcast one after the other and whose hits are joined.
SHARD_WORDS = 100_000
#: Automata that one plan applies; a benchmark of more is taken in turns, with a table written after each.
TOGETHER = 8

_HITS = "struct<n_words: bigint, n_hit: bigint, mask: binary, items: array<string>, left: string>"


class Automaton:
    """All runs of words of some items; words are numbers from 0."""

    def __init__(self, window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: dict[int, list[int]] = defaultdict(list)  # state: short items it spells
        self.items: list[set[int]] = []  # state: items in which it occurs
        self.windowed: list[int] = []
        self.ending: list[int] = []

    def add(self, words: list[int]) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)

    def _new(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """The state of exactly one word more than ``state``, cut off from ``target`` if need be."""
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._new(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:  # an earlier item has this run
            return self._split(last, word, self.next[last][word])
        made = self._new(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = made
            state = self.link[state]
        if state >= 0:
            self.link[made] = self._split(state, word, self.next[state][word])
        return made

    def finish(self, texts: list[list[int]]) -> None:
        """Note, once all are added, in which items each state occurs and where short ones end."""
        self.items = [set() for _ in self.next]
        for item, words in enumerate(texts):
            state = 0
            for word in words:
                state = at = self.next[state][word]
                while at > 0 and item not in self.items[at]:
                    self.items[at].add(item)
                    at = self.link[at]
            if 0 < len(words) < self.window:
                self.ends[state].append(item)
        # Where a walk along the suffix links would lead, so that none is made at every word: the state of the last
        # ``window`` words, and the longest suffix at which a short item ends.
        self.windowed, self.ending = [0] * len(self.next), [0] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            link = self.link[state]
            self.windowed[state] = self.windowed[link] if self.length[link] >= self.window else state
            self.ending[state] = state if state in self.ends else self.ending[link]

    def stream(self, words: list[int], sizes: list[int]) -> Iterator[tuple[int, int, Iterable[int]]]:
        """Hits as (place of the last word, words hit, items whose windows end there and that weren't given before)."""
        state = matched = 0
        told: set[int] = set()
        for place, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                matched += 1
            hit, found = 0, set()
            if matched >= self.window:
                hit, at = matched, self.windowed[state]
                if at not in told:
                    told.add(at)
                    found |= self.items[at]
            at = self.ending[state]
            while at:  # short items end at fewer states than a window has words
                ended = [item for item in self.ends[at] if sizes[item] <= matched]
                if ended:
                    hit = max(hit, sizes[ended[0]])  # items that end at one state are the same words
                    found.update(ended)
                at = self.ending[self.link[at]]
            if hit:
                yield place, hit, found


class Benchmark:
    """An automaton with the tables that find the runs worth streaming."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        texts = pa.array([text for _, text in items], pa.large_string())
        hashes = [
            words.hashes[lo:hi]
            for piece in pieces(texts)
            for words in [words_of(piece, ALNUM)]
            for lo, hi in zip(words.bounds[:-1], words.bounds[1:], strict=True)
        ]
        self.names = [name for name, _ in items]
        self.sizes = [len(h) for h in hashes]
        self.vocabulary, numbers = np.unique(np.concatenate([np.empty(0, np.uint64), *hashes]), return_inverse=True)
        numbers = np.split(numbers, np.cumsum(self.sizes)[:-1]) if hashes else []
        self.shortest = min((min(size, window) for size in self.sizes if size), default=0)
        pairs = [n[:-1] * len(self.vocabulary) + n[1:] for n in numbers]
        self.pairs = np.unique(np.concatenate([np.empty(0, np.int64), *pairs]))
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[self.vocabulary & np.uint64(0xFFFF)] = True
        self.automaton = Automaton(window)
        numbers = [n.tolist() for n in numbers]
        for n in numbers:
            self.automaton.add(n)
        self.automaton.finish(numbers)

    def numbers_of(self, hashes: np.ndarray) -> np.ndarray:
        """Each word's number, or -1."""
        out = np.full(len(hashes), -1)
        at = np.flatnonzero(self.maybe[hashes & np.uint64(0xFFFF)])
        place = np.minimum(np.searchsorted(self.vocabulary, hashes[at]), len(self.vocabulary) - 1)
        known = self.vocabulary[place] == hashes[at]
        out[at[known]] = place[known]
        return out

    def hits(self, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, dict[int, set[int]]]:
        """Of the words of several texts: which are hit, and the items by text."""
        found: dict[int, set[int]] = defaultdict(set)
        if not self.shortest or not len(hashes):
            return np.zeros(len(hashes), bool), found
        edges = np.zeros(len(hashes) + 1, np.int64)  # where hits begin and end
        number = self.numbers_of(hashes)
        goes_on = np.zeros(len(number), bool)
        at = np.flatnonzero((number[1:] >= 0) & (number[:-1] >= 0)) + 1
        if len(self.pairs):
            pair = number[at - 1] * len(self.vocabulary) + number[at]
            place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            goes_on[at[self.pairs[place] == pair]] = True
        goes_on[bounds[:-1][bounds[:-1] < len(number)]] = False
        firsts = np.flatnonzero((number >= 0) & ~goes_on)
        breaks = np.append(np.flatnonzero(~goes_on), len(number))
        lasts = breaks[np.searchsorted(breaks, firsts, "right")]
        long = lasts - firsts >= self.shortest
        texts = np.searchsorted(bounds, firsts, "right") - 1
        for first, last, text in zip(firsts[long], lasts[long], texts[long], strict=True):
            run = number[first:last].tolist()
            for place, size, items in self.automaton.stream(run, self.sizes):
                edges[first + place - size + 1] += 1
                edges[first + place + 1] -= 1
                found[text].update(items)
        return np.cumsum(edges[:-1]) > 0, found


def benchmarks(
    items: DataFrame, window: int = 10, shard_words: int = SHARD_WORDS
) -> Iterator[tuple[Sent, bool]]:
    """Automata of ``item_id, text``, of about ``shard_words`` words each, and whether it is the last.

    Each is made when asked for, so one is on the driver at a time. Rows are dealt by id and text, so that neither an id with many
    texts nor the items without one come to the driver at once.
    """
    spark = items.sparkSession
    known = items.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null")
    total = known.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    shards = max(1, -(-total // (shard_words * 6)))
    for shard in range(shards):
        part = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == shard)
        rows = part.distinct().collect()
        made = Benchmark(sorted([(r.item_id, r.text) for r in rows], key=str), window)
        yield send(spark, made), shard == shards - 1


def _without(piece: Piece, words: Words, k: int, hit: np.ndarray, max_span: int) -> str:
    """Text ``k`` of a piece without runs of hit words, from first to last word, longer than allowed."""
    low = words.bounds[k]
    edges = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    start, end_of_text = piece.bounds[k], piece.bounds[k + 1]
    keep = np.ones(end_of_text - start, bool)
    for first, end in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True):
        if end - first > max_span:
            keep[words.starts[low + first] - start : words.ends[low + end - 1] - start] = False
    return piece.data[start:end_of_text][keep].tobytes().decode()


def _hits(benchmark: Sent, max_span: int | None):
    """Hits of one automaton, joined with those before; with the text that is left if a span is given."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        found = benchmark.value
        for texts, before in batches:
            rows = []
            earlier = before.field("mask"), before.field("items")
            for piece in pieces(texts):
                words = words_of(piece, ALNUM)
                hits, of_text = found.hits(words.hashes, words.bounds)
                for k in range(piece.last - piece.first):
                    row = piece.first + k
                    hit = hits[words.bounds[k] : words.bounds[k + 1]]
                    names = {found.names[i] for i in of_text.get(k, ()) if found.names[i] is not None}
                    if before[row].is_valid:
                        mask = np.frombuffer(earlier[0][row].as_py(), np.uint8)
                        hit = hit | np.unpackbits(mask, count=len(hit)).astype(bool)
                        names.update(earlier[1][row].as_py())
                    left = None
                    if max_span is not None:
                        left = texts[row].as_py()
                        if hit.any():
                            left = _without(piece, words, k, hit, max_span)
                    rows.append((len(hit), int(hit.sum()), np.packbits(hit).tobytes(), sorted(names), left))
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.string()), pa.string())
            yield pa.StructArray.from_arrays(
                [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)],
                ["n_words", "n_hit", "mask", "items", "left"],
            )

    return batchwise_pairs(_HITS, run)


def find_passages(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    shard_words: int = SHARD_WORDS,
    max_span: int | None = None,
) -> DataFrame:
    """``docs`` with a column of hits, named by :func:`hits_name`; all other columns stay.

    Its fields: ``n_words``, ``n_hit``, ``mask`` (one bit a word), ``items`` (ids as strings, sorted) and, if
    ``max_span`` is given, ``left``: the text without spans of more than so many hit words.
    """
    name = hits_name(docs)
    out, alive = docs.withColumn(name, F.lit(None).cast(_HITS)), []
    for benchmark, is_last in benchmarks(items, window, shard_words):
        out = out.withColumn(name, _hits(benchmark, max_span if is_last else None)(F.col("text"), F.col(name)))
        alive.append(benchmark)
        if len(alive) == TOGETHER and not is_last:
            before, out = out, keep(out, "hits")
            release(before)
            for done in alive:
                done.packed.destroy()
            alive = []
    return out


def hits_name(docs: DataFrame) -> str:
    return free_name(docs, "hits")


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    max_span: int = 0,
    max_coverage: float = 0.8,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``docs`` with benchmark spans removed; same columns.

    Spans of more than ``max_span`` hit words go from the text; documents of whose words more than
    the share ``max_coverage`` is hit go altogether. Documents without hits come through as they are.
    """
    found = find_passages(docs, items, window, shard_words, max_span)
    hits = F.col(hits_name(docs))
    kept = found.where(hits.n_hit <= max_coverage * hits.n_words)
    return kept.withColumn("text", hits.left).select(*[F.col(f"`{column}`") for column in docs.columns])

"""Language of texts by prediction by partial matching (PPM) over bytes.

Each language has a context tree of up to ``order`` bytes with frozen counts. A byte costs
-log2 of its share among the bytes seen after the longest known context; where it was never seen
there, the escape probability (method C: one count for each distinct byte) is paid and the next
shorter context tried, down to a uniform choice among 256. The language in which a whole text has the
shortest code wins; ``score`` is its posterior probability, all languages being equally likely before.

As the counts are frozen, the cost of a byte depends on it and the ``order`` bytes before it only.
So the costs of all byte runs that the sample holds are worked out once, as a table with a column
per language; a text's bytes walk the trie of those runs and add up rows. A-Z count as a-z. Memory is
bounded by a piece of texts times the number of languages, and by the sample.

A text that is null or has no letter is ``und`` with score 0, as is every text where nothing could be
learned. Rows with a null text or language are not learned from. Between languages with equal code
lengths the alphabetically first wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabularium.llm.arrow import Sent, batchwise, send
from tabularium.llm.words import LOWER, PIECE, pieces

#: Fixed value: the code for an undetermined language.
UNDETERMINED = "und"

#: Expected number of texts that each language is learned from, whatever the size of the table.
SAMPLE = 2_000

_RESULT = "lang: string, score: double"


def _runs(texts: pa.Array, order: int) -> Iterator[tuple[int, np.ndarray]]:
    """By text, each byte with the ``order`` bytes before it as a number; zero bytes come first."""
    for piece in pieces(texts):
        data = LOWER[piece.data].astype(np.int64)
        for k in range(piece.last - piece.first):
            padded = np.concatenate((np.zeros(order, np.int64), data[piece.bounds[k] : piece.bounds[k + 1]]))
            run = np.zeros(len(padded) - order, np.int64)
            for j in range(order + 1):
                run = (run << 8) | padded[j : j + len(run)]
            yield piece.first + k, run


def count_runs(sample: DataFrame, order: int) -> DataFrame:
    """``lang, run, n`` of ``text, lang``: how often each run of ``order + 1`` bytes occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch["lang"].to_pylist()
            found: dict[str, list[np.ndarray]] = {}
            for row, run in _runs(batch["text"], order):
                found.setdefault(langs[row], []).append(run)
            for lang, parts in found.items():
                run, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_pydict(
                    {"lang": pa.array([lang] * len(run)), "run": pa.array(run), "n": pa.array(n)}
                )

    counted = sample.select("text", "lang").mapInArrow(count, "lang string, run long, n long")
    return counted.groupBy("lang", "run").agg(F.sum("n").alias("n"))


class ContextTrees:
    """Code lengths in bits of byte runs, a column per language, ready for walking."""

    def __init__(self, counts: list[tuple[str, int, int]], order: int):
        self.order = order
        self.langs = sorted({lang for lang, _, _ in counts})
        column = {lang: k for k, lang in enumerate(self.langs)}
        run = np.array([run for _, run, _ in counts], np.int64)
        lang = np.array([column[lang] for lang, _, _ in counts], np.int64)
        n = np.array([n for _, _, n in counts], np.float64)

        # by length: the runs, sorted, and the cost of a run's last byte after the others
        self.bits = [np.full((256, len(self.langs)), 8.0)]
        known = np.arange(256)
        self.escapes, self.runs = [], []
        for length in range(1, order + 2):
            mask = (1 << (8 * length)) - 1
            # contexts of longer runs are listed as well: those at the start of a text end no run
            kinds = np.unique(np.concatenate([run & mask, (run >> 8) & mask][: 2 if length <= order else 1]))
            where = np.searchsorted(kinds, run & mask)
            table = np.zeros((len(kinds), len(self.langs)))
            np.add.at(table, (where, lang), n)
            contexts, context = np.unique(kinds >> 8, return_inverse=True)
            total = np.zeros((len(contexts), len(self.langs)))
            distinct = np.zeros_like(total)
            np.add.at(total, context, table)
            np.add.at(distinct, context, table > 0)
            whole = total + distinct
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(distinct / whole), 0.0)
                seen = -np.log2(table / whole[context])
            shorter = np.searchsorted(known, kinds & (mask >> 8)) if length > 1 else kinds
            bits = np.where(table > 0, seen, escape[context] + self.bits[-1][shorter])
            if length == 1:  # every byte has a row
                full = 8.0 + np.repeat(escape, 256, 0) if len(escape) else np.full((256, 0), 8.0)
                full[kinds] = bits
                bits, kinds = full, np.arange(256)
            self.bits.append(bits)
            self.escapes.append((contexts, escape))
            self.runs.append(kinds)
            known = kinds
        if self.langs:
            self._trie()

    def _trie(self) -> None:
        """Steps from the node of a run and a next byte to the node of the longer run, or -1."""
        letters = np.unique(np.concatenate([runs & 255 for runs in self.runs[1:]]))
        self.letter = np.full(256, -1)
        self.letter[letters] = np.arange(len(letters))
        self.width = len(letters) + 1  # the last column leads nowhere
        self.steps = []
        for shorter, longer in zip(self.runs[:-1], self.runs[1:], strict=True):
            step = np.full((len(shorter) + 1, self.width), -1, np.int32)  # so does the last row
            prefix = np.searchsorted(shorter, longer >> 8)
            prefix[shorter[np.minimum(prefix, len(shorter) - 1)] != longer >> 8] = len(shorter)
            inside = prefix < len(shorter)
            step[prefix[inside], self.letter[longer[inside] & 255]] = np.flatnonzero(inside)
            self.steps.append(step.ravel())
        # escape bits by node of the context, one table a length; the last row is for no node
        self.escape_of = []
        for length in range(1, self.order + 1):
            contexts, escape = self.escapes[length]
            rows = np.zeros((len(self.runs[length - 1]) + 1, len(self.langs)))
            place = np.minimum(np.searchsorted(contexts, self.runs[length - 1]), len(contexts) - 1)
            found = contexts[place] == self.runs[length - 1]
            rows[:-1][found] = escape[place[found]]
            self.escape_of.append(rows)

    def code_lengths(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Bits of each text in each language."""
        out = np.zeros((len(bounds) - 1, len(self.langs)))
        if not len(data) or not self.langs:
            return out
        # zero bytes before each text, as in learning
        sizes = np.diff(bounds)
        at = np.arange(len(data)) + np.repeat(self.order * np.arange(1, len(sizes) + 1), sizes)
        padded = np.zeros(len(data) + self.order * len(sizes), np.uint8)
        padded[at] = LOWER[data]
        letter = self.letter[padded]
        node = padded.astype(np.int64)  # runs of one byte
        nodes = [node]
        for step in self.steps:
            before = np.concatenate(([-1], node[:-1]))
            node = step[before * self.width + letter].astype(np.int64)  # -1 is the last row or column
            nodes.append(node)
        cost = np.empty((len(at), len(self.langs)))
        longest = nodes[self.order][at]
        known = longest >= 0
        cost[known] = self.bits[self.order + 1][longest[known]]
        rest = at[~known]
        cost[~known] = self._shorter(nodes, rest)
        full = sizes > 0
        out[full] = np.add.reduceat(cost, bounds[:-1][full], axis=0)
        return out

    def _shorter(self, nodes: list[np.ndarray], at: np.ndarray) -> np.ndarray:
        """Bits at places whose run of full length is unknown: escapes down to a known one."""
        bits = np.zeros((len(at), len(self.langs)))
        todo = np.arange(len(at))
        for length in range(self.order, 0, -1):
            bits[todo] += self.escape_of[length - 1][nodes[length - 1][at[todo] - 1]]
            node = nodes[length - 1][at[todo]]
            bits[todo[node >= 0]] += self.bits[length][node[node >= 0]]
            todo = todo[node < 0]
        return bits


def learn(docs: DataFrame, order: int = 3, sample: int = SAMPLE, seed: int = 0) -> Sent:
    """Context trees of ``text, lang``, learned from about ``sample`` texts of each language.

    Which texts depends on their hash only, so not on how the table is stored.
    """
    spark = docs.sparkSession
    known = docs.where("text is not null and lang is not null").select("text", "lang")
    sizes = {row.lang: row["count"] for row in known.groupBy("lang").count().collect()}
    buckets = 1 << 24
    cut = F.lit(0)
    for lang, n in sizes.items():
        cut = F.when(F.col("lang") == lang, min(buckets, -(-buckets * sample // n))).otherwise(cut)
    chosen = known.where(F.pmod(F.xxhash64(F.lit(seed), "text"), F.lit(buckets)) < cut)
    counts = [(r.lang, r.run, r.n) for r in count_runs(chosen, order).collect()] if sizes else []
    return send(spark, ContextTrees(counts, order))


def predict(text: Column, trees: Sent) -> Column:
    """``struct<lang, score>`` of each text."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = trees.value
        size = max(1 << 16, 4 * PIECE // max(4, len(model.langs)))
        for batch in batches:
            langs, scores = [], []
            for piece in pieces(batch, size):
                bits = model.code_lengths(piece.data, piece.bounds)
                if not model.langs:
                    langs += [UNDETERMINED] * len(bits)
                    scores += [0.0] * len(bits)
                    continue
                best = bits.argmin(axis=1)
                behind = bits - bits[np.arange(len(bits)), best][:, None]
                langs += [model.langs[k] for k in best]
                scores += (1 / np.exp2(-behind).sum(axis=1)).tolist()
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"]
            )

    found = batchwise(f"struct<{_RESULT}>", run)(text)
    nothing = F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"))
    return F.when(text.rlike(r"\p{L}"), found).otherwise(nothing)

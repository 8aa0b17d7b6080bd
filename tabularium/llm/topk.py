"""Exact top-k inner products by Fagin's threshold algorithm, in blocks of vectors.

Every block of vectors keeps one list per dimension, sorted by that component. For a query the lists
are read from the end that its sign favours, some rows deeper each time; rows met for the first time
are scored in full. What is still unseen scores at most the sum over dimensions of query component
times list value at that depth, so reading stops once this bound is below the k-th best. The k best of
the blocks a task has done bound the next ones; the k best of all tasks are the answer.

Queries are sent in blocks of ``query_block`` rows, by broadcast, each for a pass over all vectors whose answers are
written before the next block is read; so driver and executors hold one block of queries, whatever their number. No pair of a query
and a vector leaves its task unless it is among the task's k best for that query.

Vectors that are null, empty or hold a null, NaN or infinite component take no part, as queries or
otherwise; nor do rows without an id. Components are turned to ``floor(scale * x)``; if that is beyond all doubles, the vector takes no
part either. Where scores of a block could leave the whole numbers that doubles hold exactly, it is scored in Python's unbounded ones.
A score that does not fit a long is null; its rank is right all the same. A query meets
vectors of its own length only, but never those of its own id. Rows that repeat a vector under
another id are answers of their own; rows that repeat an id with its vector count once. Ties go to the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabularium.llm.tables import keep

#: Vectors in a block of lists, and queries in a broadcast.
BLOCK, QUERY_BLOCK = 8192, 4096
#: How much deeper the lists are read each time.
DEEPER = 4


def scaled(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, v`` with whole-number components, of the rows that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))

    def whole(x: Column) -> Column:
        product = x.cast("double") * scale
        # beyond 2**53 doubles are whole numbers
        return F.when(F.abs(product) < 2**62, F.floor(product).cast("double")).otherwise(product)

    rows = vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0)).where(finite)
    scaled = rows.select(F.col("vec_id").cast("long"), F.transform("embedding", whole).alias("v"))
    return scaled.where(F.forall("v", lambda x: F.abs(x) < float("inf")))


class Best(NamedTuple):
    """The k best so far of each query, best first; empty places have the lowest score."""

    ids: np.ndarray
    scores: np.ndarray

    def take(self, row: int, ids: np.ndarray, scores: np.ndarray) -> None:
        k = self.ids.shape[1]
        if not len(ids):
            return
        if len(ids) > 4 * k:  # most are worse than the k-th best of these alone
            high = scores >= np.partition(scores, -k)[-k]
            # rows given twice take one place: what is cut must leave k others
            if len(set(zip(ids[high].tolist(), scores[high].tolist(), strict=True))) >= k:
                ids, scores = ids[high], scores[high]
        ids, scores = np.append(self.ids[row], ids), np.append(self.scores[row], scores)
        order = np.lexsort((ids, -scores))
        ids, scores = ids[order], scores[order]
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (scores[1:] != scores[:-1])  # a row given twice
        at = np.flatnonzero(new)[:k]
        self.ids[row, : len(at)], self.scores[row, : len(at)] = ids[at], scores[at]


#: Scores of empty places; their id is the largest, so any row comes before them.
_NONE, _LAST = -math.inf, np.iinfo(np.int64).max


def _largest(block: np.ndarray) -> float:
    return float(np.abs(block).max(initial=0))


def _is_exact(block: np.ndarray, queries: np.ndarray) -> bool:
    """Whether all sums of products are whole numbers that doubles hold."""
    return _largest(block) * _largest(queries) * block.shape[1] < 2**53


class Exact:
    """The k best so far of each query among blocks whose scores doubles cannot hold, as pairs of score and id."""

    def __init__(self, k: int):
        self.k = k
        self.best: dict[int, list[tuple[int, int]]] = {}

    def search_block(self, ids: np.ndarray, block: np.ndarray, query_ids: np.ndarray, queries: np.ndarray) -> None:
        rows = [[int(x) for x in vector] for vector in block.tolist()]
        for row, query in enumerate(queries.tolist()):
            query = [int(x) for x in query]
            scores = {
                (sum(a * b for a, b in zip(vector, query, strict=True)), i)
                for i, vector in zip(ids.tolist(), rows, strict=True)
                if i != query_ids[row]
            }
            self.best[row] = _first(scores.union(self.best.get(row, ())), self.k)


def _first(pairs: Iterable[tuple[int, int]], k: int) -> list[tuple[int, int]]:
    return sorted(set(pairs), key=lambda pair: (-pair[0], pair[1]))[:k]


def _once(ids: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block without rows that repeat an id with its vector."""
    repeated, count = np.unique(ids, return_counts=True)
    if len(repeated) == len(ids):
        return ids, block
    at = np.flatnonzero(np.isin(ids, repeated[count > 1]))
    _, first = np.unique(np.column_stack((ids[at], block[at].view(np.int64))), axis=0, return_index=True)
    kept = np.ones(len(ids), bool)
    kept[at] = False
    kept[at[first]] = True
    return ids[kept], block[kept]


def search_block(ids: np.ndarray, block: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, best: Best) -> int:
    """Threshold search of every query in one block; returns how many rows were scored."""
    ids, block = _once(ids, block)
    order = np.argsort(block, axis=0, kind="stable").T.copy()  # a list per dimension, ascending
    sorted_values = np.take_along_axis(block, order.T, axis=0).T.copy()
    n, scored = len(block), 0
    for row, query in enumerate(queries):
        use = np.flatnonzero(query)
        rising, weight = query[use] < 0, np.abs(query[use])
        seen = np.zeros(n, bool)
        depth = 0
        step = max(1, n // DEEPER**4)
        while depth < n:
            upto = min(n, max(step, depth * DEEPER))
            fresh = np.zeros(n, bool)
            if upto == n or not len(use):
                upto = n
                fresh[:] = True
            else:
                fresh[order[use[rising], depth:upto]] = True
                fresh[order[use[~rising], n - upto : n - depth]] = True
            fresh &= ~seen
            seen |= fresh
            at = np.flatnonzero(fresh)
            scores = (block if len(at) == n else block[at]) @ query
            scored += len(at)
            good = (scores >= best.scores[row, -1]) & (ids[at] != query_ids[row])
            best.take(row, ids[at][good], scores[good])
            depth = upto
            if depth < n:
                ends = np.where(rising, sorted_values[use, depth - 1], -sorted_values[use, n - depth])
                if -(weight @ ends) < best.scores[row, -1]:
                    break
    return scored


#: ``beyond`` is 1 or -1 for scores above or below all longs, which are in ``wide``, as bytes in their order.
_FOUND = "query_id long, vec_id long, score long, beyond int, wide binary"
#: Bytes that hold any sum of products of doubles.
_WIDE = 320


def _row(query_id: int, vec_id: int, score: int) -> tuple:
    if -(2**63) <= score < 2**63:
        return query_id, vec_id, score, 0, None
    return query_id, vec_id, None, 1 if score > 0 else -1, (score + (1 << 8 * _WIDE - 1)).to_bytes(_WIDE, "big")


def _search(rows: list, vectors: DataFrame, k: int) -> tuple[DataFrame, Broadcast]:
    """Each task's k best of one block of queries."""
    by_length: dict[int, list] = {}
    for row in rows:
        by_length.setdefault(len(row.v), []).append(row)
    asked = {
        n: (np.array([r.vec_id for r in group], np.int64), np.array([r.v for r in group], np.float64))
        for n, group in by_length.items()
    }
    sent = vectors.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value
        best = {
            n: Best(np.full((len(ids), k), _LAST), np.full((len(ids), k), _NONE)) for n, (ids, _) in asked.items()
        }
        exact = {n: Exact(k) for n in asked}
        held: dict[int, tuple[list, list]] = {n: ([], []) for n in asked}

        def flush(n: int) -> None:
            ids, blocks = held[n]
            if ids:
                ids, block = np.concatenate(ids), np.concatenate(blocks)
                if _is_exact(block, asked[n][1]):
                    search_block(ids, block, *asked[n], best[n])
                else:
                    exact[n].search_block(ids, block, *asked[n])
                held[n] = ([], [])

        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.slice(first, BLOCK)
                ids, lists = part["vec_id"].to_numpy(), part["v"]
                lengths = lists.value_lengths().to_numpy()
                for n in np.intersect1d(lengths, list(asked)):
                    rows = np.flatnonzero(lengths == n)
                    values = lists.take(pa.array(rows)).flatten().to_numpy().reshape(-1, n)
                    held[n][0].append(ids[rows])
                    held[n][1].append(values)
                    if sum(map(len, held[n][0])) >= BLOCK:
                        flush(n)
        for n, (query_ids, _) in asked.items():
            flush(n)
            out = []
            for row, query_id in enumerate(query_ids.tolist()):
                found = best[n].scores[row] > _NONE
                pairs = zip(map(int, best[n].scores[row][found].tolist()), best[n].ids[row][found].tolist(), strict=True)
                both = _first([*pairs, *exact[n].best.get(row, ())], k)
                out += [_row(query_id, vec_id, score) for score, vec_id in both]
            columns = zip(*out, strict=True) if out else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)],
                ["query_id", "vec_id", "score", "beyond", "wide"],
            )

    return vectors.mapInArrow(run, _FOUND), sent


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k vectors of highest score for each query, both as from :func:`scaled`."""
    queries = queries.distinct()
    blocks = max(1, -(-queries.count() // query_block))
    parts = []
    for number in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number).collect()
        found, sent = _search(rows, vectors, k)
        parts.append(keep(found, "best"))
        sent.destroy()
    found = reduce(DataFrame.unionAll, parts)
    # as many rows per query as tasks times k
    order = [F.desc("beyond"), F.desc("wide"), F.desc("score"), F.col("vec_id")]
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return (
        found.distinct()
        .withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

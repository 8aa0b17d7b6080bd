"""Repeated passages, found as spans of consecutive sentences that occur more than once.

A sentence ends with a run of ``.``, ``!``, ``?``, the full stops of other scripts (``STOPS``) and line ends;
what has no word (lower-cased, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, and each character of scripts that are
written without spaces) belongs to the sentence before. Spans are all runs of ``RUN``
sentences with at least ``LEAST`` words, and shorter runs if they have many words: two sentences of
``TWO`` together, or one of ``ONE``, so that a passage of few long sentences is found as well. Each is
hashed by its words, so case, spacing and punctuation don't tell spans apart.

Passages that keep few whole sentences, or have none, are found by spans that don't heed sentences: a text is cut
before each word whose hash is the least of some ``NEAR`` words in a row, and a span reaches from a cut to the
first one that is ``STRETCH`` words or more away. In a passage of ``STRETCH + 2 * NEAR - 1`` words (51) or more, the
first ``NEAR`` words and the last ``NEAR`` hold a cut wherever the passage stands, so one such span lies in it. One more
reaches from a text's start to the first such cut, and one from the last to its end, so that of texts of ``STRETCH`` words or more that are the same all words lie in spans.

All spans of all documents meet by hash. The first occurrence, by id, text and then by place, stays; every
sentence that another occurrence covers is removed, and of a sentence that it covers in part those words, if
they are ``LEAST`` or more. So of exact copies all but the first lose all
sentences, and a clean document none.

Texts are read once for their spans, and spans are shuffled once (:func:`repeats`). A task sends the first occurrence of each
hash among ``TOGETHER`` spans or so; the others among these, which cannot be the first of all, go along spread out. So a passage that a
third of all documents hold comes to its task once for each such lot of spans.

Null and wordless texts have no sentences and stay as they are, as do rows without an id. Rows of
one id and text count as one document; those of one id and other texts are documents of their own. A document that loses all its words is dropped by
:func:`without_repeats` unless told otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabularium.llm.arrow import batchwise_pairs, free_name, tidy
from tabularium.llm.tables import keep
from tabularium.llm.words import ALNUM, LOWER, Piece, Words, hash_runs, mixed, pieces, span_hashes, words_of

RUN, LEAST, TWO, ONE = 3, 8, 12, 20
STRETCH, NEAR = 36, 8
#: Full stops of Chinese and Japanese, of Hindi, Urdu and Arabic, Armenian, Ethiopic, Khmer and Burmese.
STOPS = "\u3002\uff01\uff1f\uff0e\uff61\u0964\u0965\u06d4\u061f\u0589\u1362\u17d4\u104b"

_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n\r"]] = True


def _plain(piece: Piece) -> Piece:
    """The piece with stops of other scripts as ``.``, byte for byte."""
    data = piece.data
    if not len(data) or data.max() < 0xD6:
        return piece
    data = data.copy()
    for stop in STOPS:
        found = np.ones(max(0, len(data) - len(stop.encode()) + 1), bool)
        for k, byte in enumerate(stop.encode()):
            found &= piece.data[k : k + len(found)] == byte
        at = np.flatnonzero(found)
        for k in range(len(stop.encode())):
            data[at + k] = ord(".")
    return piece._replace(data=data)


def _spaceless(data: np.ndarray) -> np.ndarray:
    """Where characters begin of Thai, Lao, Burmese, Khmer, Chinese and Japanese."""
    lead = (data >= 0xE3) & (data <= 0xE9)
    if data.max(initial=0) >= 0xE0:
        after = np.append(data[1:], np.uint8(0))
        lead |= (data == 0xE0) & (after >= 0xB8) & (after <= 0xBB)
        lead |= (data == 0xE1) & np.isin(after, (0x80, 0x81, 0x82, 0x9E, 0x9F))
    return np.flatnonzero(lead)


def _words(piece: Piece) -> Words:
    """The words of a piece; characters of scripts without spaces are words of their own."""
    words = words_of(piece, ALNUM)
    lead = _spaceless(piece.data)
    if not len(lead):
        return words
    begins = np.zeros(len(piece.data) + 3, bool)
    begins[words.starts] = True
    begins[lead] = True
    follow = lead + 3
    inside = np.append(ALNUM[LOWER[piece.data]], np.zeros(3, bool))
    inside[piece.bounds[1:]] &= False  # what begins the next text is among the starts
    begins[follow] |= inside[follow]
    starts = np.flatnonzero(begins)
    ends = words.ends[np.searchsorted(words.ends, starts, "right")]
    ends[:-1] = np.minimum(ends[:-1], starts[1:])
    return Words(starts, ends, span_hashes(LOWER[piece.data], starts, ends), np.searchsorted(starts, piece.bounds))


def _cuts(words: Words) -> np.ndarray:
    """Words that have the least hash of some ``NEAR`` words in a row, the last of equals."""
    n = len(words.hashes) - NEAR + 1
    if n <= 0:
        return np.empty(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(mixed(words.hashes)[::-1], NEAR)[::-1]
    at = np.arange(n) + NEAR - 1 - windows.argmin(axis=1)
    text = np.searchsorted(words.bounds, np.arange(n), "right")
    return np.unique(at[np.arange(n) + NEAR <= words.bounds[text]])


def _stretches(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First words of the spans that don't heed sentences, and the words after their last."""
    cuts = _cuts(words)
    to = np.searchsorted(cuts, cuts + STRETCH)
    kept = to < len(cuts)
    first, last = cuts[kept], cuts[to[kept]]
    same = last < words.bounds[np.searchsorted(words.bounds, first, "right")]
    begin, end = words.bounds[:-1], words.bounds[1:]
    long = end - begin >= STRETCH
    begin, end = begin[long], end[long]
    if not len(begin):
        return first[same], last[same]
    # from the start to a cut, or the end; and from a cut, or the start, to the end
    edges = np.append(cuts, len(words.hashes))
    to = np.minimum(edges[np.searchsorted(cuts, begin + STRETCH)], end)
    before = np.append(0, cuts)[np.searchsorted(cuts, end - STRETCH, "right")]
    since = np.maximum(before, begin)
    return np.concatenate([first[same], begin, since]), np.concatenate([last[same], to, end])


def _sentences(piece: Piece, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Of the sentences of a piece: the first word, and where each text's sentences begin.

    There is one more first word than sentences, the number of words.
    """
    ends = np.cumsum(_ENDS[piece.data])
    before = np.concatenate(([0], ends))[words.starts]
    new = np.ones(len(words.starts), bool)
    new[1:] = before[1:] != before[:-1]
    new[words.bounds[:-1][np.diff(words.bounds) > 0]] = True
    firsts = np.flatnonzero(new)
    return np.append(firsts, len(words.starts)), np.searchsorted(firsts, words.bounds)


def _spans(words: Words, firsts: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the spans of a piece: the first word, the word after the last, and the hash."""
    n = len(firsts) - 1
    last = np.repeat(bounds[1:], np.diff(bounds))  # of each sentence's text
    found = [_stretches(words)]
    for length, least in ((1, ONE), (2, TWO), (RUN, LEAST)):
        at = np.arange(max(0, n - length + 1))
        size = firsts[at + length] - firsts[at]
        at = at[(at + length <= last[at]) & (size >= least)]
        found.append((firsts[at], firsts[at + length]))
    first, last = (np.concatenate(column) for column in zip(*found, strict=True))
    return first, last, hash_runs(words.hashes, first, last)


class _Lot:
    """Spans of some texts: for each hash the first occurrence, and the others, which are not the first of all."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.size += len(columns[0])

    def take(self) -> Iterator[pa.RecordBatch]:
        """Columns of ``_SPANS``; the lot is empty then."""
        if not self.size:
            return
        hashes, ids, keys, first, n = (np.concatenate(column) for column in zip(*self.parts, strict=True))
        self.parts, self.size = [], 0
        order = np.lexsort((n, first, keys, ids, hashes))
        same = np.append(False, hashes[order[1:]] == hashes[order[:-1]])
        head = order[np.flatnonzero(~same)[np.cumsum(~same) - 1]]
        # rows that repeat a text repeat its places
        repeated = same.copy()
        for column in (ids, keys, first):
            repeated[1:] &= column[order[1:]] == column[order[:-1]]
        origin, kept = np.empty(len(order), np.int64), np.empty(len(order), bool)
        origin[order], kept[order] = head, ~repeated
        # in order of texts, as neighbours then share what they are told by
        kept = np.flatnonzero(kept)
        origin = origin[kept]
        lot = mixed(np.array([ids[0], keys[0], first[0], len(ids)]).view(np.uint64)).sum(dtype=np.uint64).view(np.int64)
        columns = [
            pa.array(hashes[kept]),
            pa.array(ids[kept]),
            pa.array(keys[kept]),
            pa.array(first[kept].astype(np.int32)),
            pa.array(n[kept].astype(np.int32)),
            pa.array(np.full(len(kept), lot)),
            pa.array(ids[origin], mask=origin == kept),
        ]
        yield from pa.Table.from_arrays(columns, [name.split()[0] for name in _SPANS.split(", ")]).to_batches(LOT_ROWS)


#: ``origin``, the document of the lot's first occurrence of the hash, is null for that one itself.
_SPANS = "hash long, doc_id long, key long, first int, n int, lot long, origin long"
#: Spans of a lot, at least, and rows that leave a task at a time.
TOGETHER, LOT_ROWS = 1 << 20, 1 << 16


def _key(text: Column) -> Column:
    """What tells texts of one id apart."""
    return F.xxhash64(text)


def spans(docs: DataFrame) -> DataFrame:
    """``_SPANS``: every span as its first word (from 0) and its length, but for the same place of the same text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        lot = _Lot()
        for batch in batches:
            ids, keys = batch["doc_id"].to_numpy(), batch["key"].to_numpy()
            for piece in map(_plain, pieces(batch["text"])):
                words = _words(piece)
                first, last, hashes = _spans(words, *_sentences(piece, words))
                text = np.searchsorted(words.bounds, first, "right") - 1
                row = piece.first + text
                lot.add(hashes.view(np.int64), ids[row], keys[row], first - words.bounds[text], last - first)
                if lot.size >= TOGETHER:
                    yield from lot.take()
        yield from lot.take()

    return (
        docs.where("doc_id is not null and text is not null")
        .select(F.col("doc_id").cast("long"), _key(F.col("text")).alias("key"), "text")
        .mapInArrow(run, _SPANS)
    )


def repeats(docs: DataFrame, origins: bool = True) -> DataFrame:
    """``doc_id, key, spans, origins`` of documents with spans that occurred before; ``key`` is the text's.

    ``spans`` are structs of the first word and the number of words, ``origins`` the ids
    of the documents of first occurrences; neither is longer than the document. Without ``origins`` they are not looked up.
    """
    # the first occurrences of lots meet by hash; the others, known not to be first, stay with their lot's
    alone = F.when(F.col("origin").isNotNull(), F.col("lot"))
    meeting = Window.partitionBy("hash", alone).orderBy("doc_id", "key", "first")
    place = F.struct("doc_id", "key", "first")
    met = spans(docs).withColumn("head", F.first(place).over(meeting))
    is_first = F.col("origin").isNull()
    later = met.where(~is_first | (F.col("head") != place)).select(
        "hash", "lot", "doc_id", "key", "first", "n", F.coalesce("origin", "head.doc_id").alias("origin"), is_first.alias("is_first")
    )
    later = keep(later, "later-spans")
    if origins:
        # the first of a lot may itself be met before, in another lot
        heads = later.where("is_first").select("hash", "lot", F.col("origin").alias("head"))
        later = later.join(heads, ["hash", "lot"], "left").withColumn("origin", F.coalesce("head", "origin"))
    return later.groupBy("doc_id", "key").agg(
        F.collect_set(F.struct("first", "n")).alias("spans"),
        (F.sort_array(F.collect_set("origin")) if origins else F.array().cast("array<long>")).alias("origins"),
    )


_CUT = "struct<text: string, n_sentences: int, n_removed: int, n_left: int>"


def _cut(text: Column, found: Column) -> Column:
    """A text without what spans cover; its sentences, those that lost words, and the words left. Null stays null."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, found in batches:
            out, counts, removed, left = [], [], [], []
            for whole in pieces(texts):
                piece = _plain(whole)
                words = _words(piece)
                firsts, bounds = _sentences(piece, words)
                # a word reaches to the next one; the text's ends go along
                starts = np.append(words.starts, len(piece.data))
                for k in range(piece.last - piece.first):
                    row, a, b = piece.first + k, int(words.bounds[k]), int(words.bounds[k + 1])
                    spans = found[row].as_py() or ()
                    counts.append(int(bounds[k + 1] - bounds[k]))
                    gone = np.zeros(b - a + 1, np.int32)
                    for span in spans:
                        gone[span["first"]] += 1
                        gone[span["first"] + span["n"]] -= 1
                    gone = np.cumsum(gone[:-1]) > 0
                    lost = 0
                    if spans:
                        edges = firsts[bounds[k] : bounds[k + 1] + 1] - a
                        lost = _only_long(gone, edges)
                    removed.append(lost)
                    left.append(int((~gone).sum()))
                    if not lost:
                        out.append(texts[row].as_py())
                        continue
                    at = starts[a : b + 1].copy()
                    at[0], at[-1] = piece.bounds[k], piece.bounds[k + 1]
                    data = whole.data[piece.bounds[k] : piece.bounds[k + 1]]
                    out.append(data[np.repeat(~gone, np.diff(at))].tobytes().decode())
            yield pa.StructArray.from_arrays(
                [pa.array(out, pa.string()), *(pa.array(column, pa.int32()) for column in (counts, removed, left))],
                ["text", "n_sentences", "n_removed", "n_left"],
            )

    return batchwise_pairs(_CUT, run)(text, found)


def _only_long(gone: np.ndarray, edges: np.ndarray) -> int:
    """Keeps words of a sentence that is covered in part by fewer than ``LEAST`` words in a row; how many lose any."""
    new = np.zeros(len(gone), bool)
    new[edges[:-1]] = True
    new[1:] |= gone[1:] != gone[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(gone))
    sentence = np.searchsorted(edges, first, "right") - 1
    whole = (first == edges[sentence]) & (last == edges[sentence + 1])
    kept = gone[first] & (whole | (last - first >= LEAST))
    gone[:] = np.repeat(kept, last - first)
    return len(np.unique(sentence[kept]))


def mark_repeats(docs: DataFrame, origins: bool = True) -> tuple[DataFrame, str]:
    """``docs`` with a struct column of what is left, and its name.

    Its fields: ``cut`` (``text``, ``n_sentences``, ``n_removed`` of these that lost words, ``n_left`` words) and ``origins``. Other columns stay.
    """
    name, of, key = free_name(docs, "left"), free_name(docs, "repeats_of"), free_name(docs, "repeats_key")
    found = keep(repeats(docs, origins), "repeats").select(
        F.col("doc_id").alias(of), F.col("key").alias(key), F.struct("spans", "origins").alias(name)
    )
    same = (F.col("doc_id").cast("long") == F.col(of)) & (_key(F.col("text")) == F.col(key))
    joined = docs.join(found, same, "left").drop(of, key)
    return (
        joined.withColumn(
            name,
            F.struct(
                _cut(F.col("text"), F.col(f"{name}.spans")).alias("cut"), F.col(f"{name}.origins").alias("origins")
            ),
        ),
        name,
    )


def without_repeats(docs: DataFrame, drop_empty: bool = True) -> DataFrame:
    """``docs`` without repeated passages; same columns."""
    marked, name = mark_repeats(docs, origins=False)
    if drop_empty:
        cut = F.col(f"{name}.cut")
        marked = marked.where((cut.n_removed == 0) | (cut.n_left > 0))
    return marked.withColumn("text", F.col(f"{name}.cut.text")).select(*[F.col(f"`{c}`") for c in docs.columns])

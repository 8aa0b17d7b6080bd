"""Personal data in texts: patterns for the plain forms, a conditional random field for the others.

Patterns find plain e-mail addresses, IPv4 addresses, card and telephone numbers (:func:`plain_spans`); each kind's matches
are leftmost and don't overlap, and those that fail their test (parts to 255, Luhn, number of digits) are dropped. A
linear-chain CRF adds what is written in other ways, such as ``anna (at) example [dot] org``, ``(020) 7946 0958``,
``4111.1111.1111.1111`` or ``10[.]0[.]0[.]1``. Its features are word shapes: kind of characters and length, the word itself if training
met it, the blanks before, and the digits of the number that a token belongs to, in a window of ``AROUND`` tokens to each side. It is
trained from a small labelled table (``personal_lines``, varied by rule) and decoded by Viterbi, all sequences of a piece of text at once.

A sequence is a run of a line's tokens that are at most ``REACH`` tokens from a *mark*: a token with a digit, an ``@``, or a word that
stands for ``@`` in brackets or for a dot. No span lies elsewhere, as each holds a mark. The field's spans are kept if they pass the
test of their kind and overlap no plain one, so plain spans always stay.

Null and empty texts have no spans. Positions count code points; ends are exclusive.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabularium.llm import crf
from tabularium.llm.arrow import Sent, batchwise, send
from tabularium.llm.personal_lines import LINES
from tabularium.llm.words import LOWER, Piece, edges_of, pieces

KINDS = ("email", "ip", "card", "phone")
#: Tokens to each side whose features count, and tokens from a mark that are read.
AROUND, REACH = 3, 12
#: Variants of each labelled line, and rows of a labelled table that are used at most, by hash.
VARIANTS, MOST_LABELLED = 6, 4000

Span = tuple[int, int, str]


# Plain forms

_MAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_MAIL_HEAD = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match that began inside a run of digits would have begun before it.
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def passes_luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def _is_octet(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= 255


def _mails(text: str) -> Iterator[Span]:
    """The name before each ``@`` reaches back to what cannot belong to it, or to the match before."""
    last = 0
    for tail in _MAIL_TAIL.finditer(text):
        start = tail.start()
        while start > last and text[start - 1] in _MAIL_HEAD:
            start -= 1
        if start < tail.start():
            last = tail.end()
            yield start, last, "email"


def plain_spans(text: str) -> list[Span]:
    """Plain personal data as (start, end, kind) by start, then kind in the order of ``KINDS``."""
    found = list(_mails(text)) if "@" in text else []
    if not _DIGITS.search(text):
        return found
    found += [(*m.span(), "ip") for m in _IP.finditer(text) if all(map(_is_octet, m.groups()))]
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 12:
            digits = "".join(_DIGITS.findall(match[0]))
            if 12 <= len(digits) <= 19 and passes_luhn(digits):
                found.append((*match.span(), "card"))
    for match in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.findall(match[0])) <= 15:
            found.append((*match.span(), "phone"))
    return sorted(found, key=_place)


def _place(span: Span) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


def written(spans: Iterable[Span]) -> str:
    """``kind:start:end`` of each span, with commas between."""
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


# Tokens and their features

_DIGIT, _LOWER, _UPPER, _OTHER = 1, 2, 4, 8


def _kinds_of_bytes() -> np.ndarray:
    kinds = np.zeros(256, np.int64)
    kinds[48:58], kinds[97:123], kinds[65:91], kinds[128:] = _DIGIT, _LOWER, _UPPER, _OTHER
    return kinds


_KIND = _kinds_of_bytes()
_MARK = (np.arange(256) > 32) & (np.arange(256) != 127) & (_KIND == 0)
_JOINS = np.isin(np.arange(256), [ord(c) for c in " .-/()[]_,+"])
_OPENS = np.isin(np.arange(256), [ord(c) for c in "([{<"])

_AT_WORDS = ("at", "arroba", "arobase", "ät")
_DOT_WORDS = ("dot", "punkt", "punto", "point", "ponto")


def _word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Lower-cased words as numbers: their first seven bytes and their length."""
    sizes = np.minimum(ends - starts, 255)
    key = sizes.astype(np.uint64) << np.uint64(56)
    for k in range(7):
        at = np.minimum(starts + k, len(data) - 1)
        key |= np.where(k < sizes, LOWER[data[at]], 0).astype(np.uint64) << np.uint64(8 * k)
    return key


def _key_of(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(_word_keys(data, np.array([0]), np.array([len(data)]))[0])


_AT_KEYS = np.array(sorted(map(_key_of, _AT_WORDS)), np.uint64)
_DOT_KEYS = np.array(sorted(map(_key_of, _DOT_WORDS)), np.uint64)
_FIRSTS = np.isin(np.arange(256), [w.encode()[0] for w in (*_AT_WORDS, *_DOT_WORDS)])


class Tokens(NamedTuple):
    """Tokens near marks: first byte, byte after the last, where sequences begin, and the text of each sequence."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    texts: np.ndarray


def tokens_near_marks(piece: Piece) -> Tokens:
    """A token is a run of letters and digits, or one other visible character."""
    data = piece.data
    kinds = _KIND[data]
    words, word_ends = edges_of(piece, kinds > 0)
    single = np.flatnonzero(_MARK[data])
    starts, ends = np.append(words, single), np.append(word_ends, single + 1)
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    line = np.concatenate(([0], np.cumsum((data == 10) | (data == 13))))[starts]
    line = line + np.searchsorted(piece.bounds, starts, "right")  # a text's end ends the line
    digits = np.concatenate(([0], np.cumsum(kinds == _DIGIT)))
    marks = (digits[ends] > digits[starts]) | (data[starts] == ord("@"))
    maybe = np.flatnonzero(_FIRSTS[LOWER[data[starts]]] & (ends - starts <= 8) & ~marks)
    keys = _word_keys(data, starts[maybe], ends[maybe])
    opened = np.append(False, _OPENS[data[starts[:-1]]])[: len(starts)]
    marks[maybe] = np.isin(keys, _DOT_KEYS) | (np.isin(keys, _AT_KEYS) & opened[maybe])
    # the nearest marks before and after, if in the same line
    at, places = np.arange(len(starts)), np.flatnonzero(marks)
    if not len(places):
        none = np.empty(0, np.int64)
        return Tokens(none, none, np.zeros(1, np.int64), none)
    near = np.zeros(len(starts), bool)
    after = np.searchsorted(places, at)
    for mark in (places[np.maximum(after - 1, 0)], places[np.minimum(after, len(places) - 1)]):
        near |= (np.abs(mark - at) <= REACH) & (line[mark] == line)
    kept = np.flatnonzero(near)
    new = np.append(True, (kept[1:] != kept[:-1] + 1) | (line[kept[1:]] != line[kept[:-1]]))
    bounds = np.append(np.flatnonzero(new), len(kept))
    texts = np.searchsorted(piece.bounds, starts[kept[bounds[:-1]]], "right") - 1
    return Tokens(starts[kept], ends[kept], bounds, texts)


def _numbers(data: np.ndarray, tokens: Tokens, is_number: np.ndarray) -> np.ndarray:
    """What number each token belongs to, as a small code of its digits, its groups and Luhn's test; 0 for none.

    Groups of digits are one number if at most four bytes of blanks, brackets and the like are between them.
    """
    out = np.zeros(len(tokens.starts), np.int64)
    at = np.flatnonzero(is_number)
    if not len(at):
        return out
    sequence = np.searchsorted(tokens.bounds, at, "right")
    breaks = np.concatenate(([0], np.cumsum(~_JOINS[data])))
    gap = tokens.starts[at[1:]] - tokens.ends[at[:-1]]
    joined = (sequence[1:] == sequence[:-1]) & (gap <= 4)
    joined &= breaks[tokens.starts[at[1:]]] == breaks[tokens.ends[at[:-1]]]
    firsts = np.flatnonzero(np.append(True, ~joined))
    sizes = tokens.ends[at] - tokens.starts[at]
    digits = np.add.reduceat(sizes, firsts)
    groups = np.diff(np.append(firsts, len(at)))
    luhn = np.zeros(len(firsts), np.int64)
    for k in np.flatnonzero((digits >= 12) & (digits <= 19)).tolist():
        begin, end = tokens.starts[at[firsts[k]]], tokens.ends[at[firsts[k] + groups[k] - 1]]
        part = data[begin:end]
        luhn[k] = passes_luhn(part[_KIND[part] == _DIGIT].tobytes().decode())
    code = 1 + (np.minimum(digits, 20) * 6 + np.minimum(groups, 6) - 1) * 2 + luhn
    # tokens between the groups of a number belong to it
    last = at[firsts + groups - 1]
    k = np.maximum(np.searchsorted(at[firsts], np.arange(len(out)), "right") - 1, 0)
    inside = (np.arange(len(out)) >= at[firsts][k]) & (np.arange(len(out)) <= last[k])
    out[inside] = code[k[inside]]
    return out


#: Features of a token come in four blocks of so many numbers; 0 of each is for places outside the sequence.
_SHAPES, _NUMBERS, _BLANKS = 400, 260, 5


class Model(NamedTuple):
    """A field, and the words it knows, as sorted keys."""

    words: np.ndarray
    field: crf.Field


def _active(data: np.ndarray, tokens: Tokens, words: np.ndarray) -> np.ndarray:
    """The features of each token, its own and its neighbours', as rows of the weight table."""
    starts, ends = tokens.starts, tokens.ends
    if not len(starts):
        return np.zeros((0, 4 * (2 * AROUND + 1)), np.int64)
    sizes = ends - starts
    seen = np.bitwise_or.reduceat(_KIND[data[: ends[-1]]], np.column_stack([starts, ends]).ravel()[:-1])[::2]
    shape = 1 + seen * 8 + np.minimum(sizes, 8) - 1
    capital = (seen == _LOWER | _UPPER) & (_KIND[data[starts]] == _UPPER)
    shape[capital] = 130 + np.minimum(sizes[capital], 8)
    mark = seen == 0
    shape[mark] = 140 + data[starts[mark]]
    number = seen == _DIGIT
    value = np.zeros(len(starts), np.int64)
    for k in range(3):
        inside = number & (sizes > k) & (sizes <= 3)
        value[inside] = value[inside] * 10 + data[starts[inside] + k] - 48
    zero = number & (data[starts] == 48) & (sizes > 1)
    shape[number] = 300 + np.minimum(sizes[number], 20) * 4 + 2 * (value[number] > 255) + zero[number]
    before = np.append(1 << 30, starts[1:] - ends[:-1])
    before[tokens.bounds[:-1]] = 3
    keys = _word_keys(data, starts, ends)
    place = np.minimum(np.searchsorted(words, keys), max(0, len(words) - 1))
    known = np.where(words[place] == keys, place + 2, 1) if len(words) else np.ones(len(keys), np.int64)
    blocks = [
        (shape, _SHAPES),
        (1 + np.minimum(before, 3), _BLANKS),
        (1 + _numbers(data, tokens, number), _NUMBERS),
        (known, len(words) + 2),
    ]
    sequence = np.searchsorted(tokens.bounds, np.arange(len(starts)), "right") - 1
    first, last = tokens.bounds[sequence], tokens.bounds[sequence + 1]
    columns, base = [], 0
    for off in range(-AROUND, AROUND + 1):
        at = np.arange(len(starts)) + off
        outside = (at < first) | (at >= last)
        at = np.clip(at, 0, len(starts) - 1)
        for values, size in blocks:
            columns.append(base + np.where(outside, 0, values[at]))
            base += size
    return np.stack(columns, axis=1)


def _features(words: np.ndarray) -> int:
    return (2 * AROUND + 1) * (_SHAPES + _BLANKS + _NUMBERS + len(words) + 2)


# The labelled table

_SPAN = re.compile(r"<(email|ip|card|phone):([^<>]*)>")


def vary(line: str, rng: random.Random) -> tuple[str, list[Span]]:
    """A line of ``personal_lines`` with its places filled, and its spans."""
    text, spans, at = "", [], 0
    for part in _SPAN.finditer(line):
        text += _filled(line[at : part.start()], rng)
        inner = _filled(part[2], rng)
        spans.append((len(text), len(text) + len(inner), part[1]))
        text, at = text + inner, part.end()
    return text + _filled(line[at:], rng), spans


def _filled(part: str, rng: random.Random) -> str:
    out = ""
    for c in part:
        if c == "#":
            c = rng.choice("0123456789")
        elif c in "%^":
            c = str(rng.randint(0, 255) if c == "%" else rng.randint(256, 999))
        elif c in "~!":
            digits = "".join(_DIGITS.findall(out))
            digits = digits if len(digits) < 19 else digits[-15:]
            right = next(d for d in "0123456789" if passes_luhn(digits + d))
            c = right if c == "~" else str((int(right) + rng.randint(1, 9)) % 10)
        out += c
    return out


def labelled_lines(spark: SparkSession, lines: Iterable[str] = LINES, variants: int = VARIANTS) -> DataFrame:
    """``text, spans`` of the shipped lines; ``spans`` are structs of ``start``, ``end`` and ``kind``."""
    rng = random.Random(13)
    rows = [vary(line, rng) for line in lines for _ in range(variants)]
    return spark.createDataFrame(rows, "text string, spans array<struct<start: int, end: int, kind: string>>")


def learn(labelled: DataFrame) -> Sent:
    """A model from ``text`` and ``spans``, as ``labelled_lines`` makes them; of larger tables ``MOST_LABELLED`` rows, by hash, are used."""
    order = F.xxhash64("text")
    rows = labelled.where("text is not null").orderBy(order, "text").limit(MOST_LABELLED).select("text", "spans").collect()
    return send(labelled.sparkSession, fit([(r.text, [tuple(s) for s in r.spans or ()]) for r in rows]))


def fit(rows: list[tuple[str, list[Span]]]) -> Model:
    """A model from texts and their spans; words that two texts hold are known."""
    piece = next(pieces(pa.array([text for text, _ in rows], pa.string()), 1 << 30), None)
    if piece is None:
        empty = np.empty(0, np.uint64)
        kinds = 1 + 2 * len(KINDS)
        return Model(empty, crf.Field(np.zeros((_features(empty), kinds)), np.zeros((kinds, kinds)), np.zeros(kinds)))
    tokens = tokens_near_marks(piece)
    text = np.repeat(tokens.texts, np.diff(tokens.bounds))
    # letters only: a number says nothing but its shape
    letters = (_KIND[piece.data[tokens.starts]] & (_LOWER | _UPPER | _OTHER)) > 0
    keys = _word_keys(piece.data, tokens.starts, tokens.ends)[letters]
    held = np.unique(np.column_stack([keys, text[letters].astype(np.uint64)]), axis=0)[:, 0]
    words, times = np.unique(held, return_counts=True)
    words = words[times >= 2]
    labels = np.zeros(len(tokens.starts), np.int64)
    for number, (whole, spans) in enumerate(rows):
        bytes_at = np.concatenate(([0], np.cumsum([len(c.encode()) for c in whole]))) + piece.bounds[number]
        for start, end, kind in spans:
            inside = np.flatnonzero((tokens.starts >= bytes_at[start]) & (tokens.ends <= bytes_at[end]))
            labels[inside] = 2 + 2 * KINDS.index(kind)
            labels[inside[:1]] -= 1
    field = crf.train(
        _active(piece.data, tokens, words), tokens.bounds, labels, _features(words), 1 + 2 * len(KINDS)
    )
    return Model(words, crf.Field(*(x.astype(np.float32) for x in field)))


# Finding

_TESTED = re.compile(r"[0-9]+")
_WRITTEN_MAIL = re.compile(
    r"[\w.%+-]+(?:\s\d+)?\s*[(\[{<]?\s*(?:@|\b(?:at|arroba|arobase|ät)\b)\s*[)\]}>]?\s*"
    r"[\w-]+(?:\s*[(\[{<]?\s*(?:\.|\b(?:dot|punkt|punto|point|ponto)\b)\s*[)\]}>]?\s*[\w-]+)+",
    re.IGNORECASE,
)


_WRITTEN_PHONE = re.compile(r"[+(]?\s*[0-9].*[0-9]")


def is_sound(kind: str, text: str) -> bool:
    """Whether a span of the field can be what it is taken for."""
    if kind == "email":
        return len(text) <= 320 and _WRITTEN_MAIL.fullmatch(text) is not None
    groups = _TESTED.findall(text)
    digits = "".join(groups)
    if kind == "ip":
        return len(groups) == 4 and all(map(_is_octet, groups))
    if kind == "card":
        return 12 <= len(digits) <= 19 and passes_luhn(digits)
    return 9 <= len(digits) <= 15 and len(text) <= 40 and _WRITTEN_PHONE.fullmatch(text) is not None


def _field_spans(piece: Piece, model: Model) -> Iterator[tuple[int, int, int, str]]:
    """The field's spans of a piece as (text, start, end, kind), in bytes of the piece."""
    tokens = tokens_near_marks(piece)
    if not len(tokens.starts):
        return
    scores = crf.emissions(model.field, _active(piece.data, tokens, model.words))
    labels = crf.viterbi(model.field, scores, tokens.bounds)
    kind = (labels + 1) // 2
    new = labels % 2 == 1
    new[1:] |= kind[1:] != kind[:-1]
    new[tokens.bounds[:-1]] = True
    firsts = np.flatnonzero(new)
    lasts = np.append(firsts[1:], len(labels)) - 1
    sequence = np.searchsorted(tokens.bounds, firsts, "right") - 1
    for first, last, text in zip(firsts.tolist(), lasts.tolist(), tokens.texts[sequence].tolist(), strict=True):
        if kind[first]:
            yield text, int(tokens.starts[first]), int(tokens.ends[last]), KINDS[kind[first] - 1]


def _added(text: str, data: bytes, found: list[tuple[int, int, str]], plain: list[Span]) -> list[Span]:
    """The field's spans of a text that stand, in code points."""
    out = []
    taken = plain.copy()
    ahead, at = 0, 0
    for start, end, kind in found:  # by start, so code points are counted once
        at += len(data[ahead:start].decode())
        ahead = start
        length = len(data[start:end].decode())
        span = (at, at + length, kind)
        clear = all(span[1] <= other[0] or span[0] >= other[1] for other in taken)
        if clear and is_sound(kind, text[span[0] : span[1]]):
            out.append(span)
    return out


def find(text: Column, model: Sent) -> Column:
    """Spans of a text as a struct: ``plain`` and ``spans`` (all) as written, and the number of plain ones by kind."""
    kind = "struct<plain: string, spans: string, " + ", ".join(f"n_{k}: bigint" for k in KINDS) + ">"

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = model.value
        for texts in batches:
            plain_out, all_out = [], []
            counts: list[list[int]] = [[] for _ in KINDS]
            for piece in pieces(texts):
                added: dict[int, list[tuple[int, int, str]]] = {}
                for at, start, end, name in _field_spans(piece, known):
                    added.setdefault(at, []).append((start, end, name))
                for k in range(piece.last - piece.first):
                    whole = texts[piece.first + k].as_py() or ""
                    plain = plain_spans(whole)
                    spans = plain
                    if k in added:
                        begin, end = int(piece.bounds[k]), int(piece.bounds[k + 1])
                        data = piece.data[begin:end].tobytes()
                        more = _added(whole, data, [(a - begin, b - begin, n) for a, b, n in added[k]], plain)
                        spans = sorted(plain + more, key=_place)
                    plain_out.append(written(plain))
                    all_out.append(written(spans))
                    for count, name in zip(counts, KINDS, strict=True):
                        count.append(sum(span[2] == name for span in plain))
            columns = [pa.array(plain_out, pa.string()), pa.array(all_out, pa.string())]
            columns += [pa.array(count, pa.int64()) for count in counts]
            yield pa.StructArray.from_arrays(columns, ["plain", "spans", *(f"n_{k}" for k in KINDS)])

    return batchwise(kind, run)(text)


def mask(text: str, spans: str) -> str:
    """A text with its spans, as ``find`` writes them, replaced by their kinds in brackets; of overlapping ones the first."""
    out, last = "", 0
    for span in filter(None, spans.split(",")):
        kind, start, end = span.split(":")
        if int(start) >= last:
            out, last = out + text[last : int(start)] + f"[{kind}]", int(end)
    return out + text[last:]

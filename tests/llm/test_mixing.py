import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from awkward import awkward_rows, documents
from pyspark.sql import functions as F
from tabularium.llm import mixing as m
from tabularium.llm.words import lowered, pieces, visible

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def spelled(text):
    return b"".join(w.encode() + b" " for w in words(text)) + b"\n"


def base_scores(texts, learn):
    counts = Counter(w for t, use in zip(texts, learn, strict=True) if use for w in [*words(t), None])
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for text in texts:
        tokens = [*words(text), None]
        score = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens)
        out.append((len(tokens), sum(w in counts for w in tokens), total, score))
    return out


def mixed_scores(texts, learn):
    """Bit by bit, by the definition, with counts in dicts."""
    pad = bytes([10]) * 8
    used = [spelled(t) for t, use in zip(texts, learn, strict=True) if use]
    raw = b"".join((t or "").translate(LOWER).encode() for t, use in zip(texts, learn, strict=True) if use)
    histogram = np.zeros(256, np.int64)
    for byte in raw:
        histogram[32 if byte in b" \t\n\v\f\r" else byte] += 1
    histogram[10] += len(used)
    alphabet = m.Alphabet(histogram)

    def contexts(data, k):
        return [int(row[0]) for row in m.rows_of(m.befores(np.frombuffer(data[k - 8 : k] + b"\0", np.uint8)))]

    counts = Counter()
    for text in used:
        data = pad + text
        for k in range(8, len(data)):
            leaf = int(alphabet.leaf[data[k]])
            for row in contexts(data, k):
                for level in range(6):
                    node = (1 << level) - 1 + (leaf >> (6 - level))
                    counts[row, node, leaf >> (5 - level) & 1] += 1

    def odds(row, node):
        value = math.log((counts[row, node, 1] + m.PRIOR) / (counts[row, node, 0] + m.PRIOR))
        return max(-127, min(127, round(16 * value))) / 16

    out = []
    for text in texts:
        data, total = pad + spelled(text), 0.0
        for k in range(8, len(data)):
            if (k - 8) % m.STRETCH == 0:
                weights = [list(w) for w in m.START]
            rows, leaf = contexts(data, k), int(alphabet.leaf[data[k]])
            gate = sum(odds(row, 0) != 0 for row in rows[1:])
            slope = [0.0] * len(rows)
            total += alphabet.extra[data[k]]
            for level in range(6):
                x = [odds(row, (1 << level) - 1 + (leaf >> (6 - level))) for row in rows]
                sign = 1 if leaf >> (5 - level) & 1 else -1
                right = 1 / (1 + math.exp(-sign * sum(w * v for w, v in zip(weights[gate], x, strict=True))))
                total -= math.log(right * (1 - 2e-6) + 1e-6)
                slope = [s + sign * (1 - right) * v for s, v in zip(slope, x, strict=True)]
            weights[gate] = [w + m.STEP * s for w, s in zip(weights[gate], slope, strict=True)]
        out.append(-total / math.log(10))
    return out


def some_texts(seed, n=40):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 7))) for _ in range(60)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 60))) for _ in range(n)]
    return [*texts, "", None, " \n ", "Unseen WORDS zq", texts[0], "\ttrailing \n", "漢字 " * 300]


def scored(docs, learn):
    return {r.doc_id: r for r in m.score(docs.withColumn("learn", learn)).collect()}


@pytest.mark.parametrize("block, worked", [(m.BLOCK, m.WORKED), (900, 300)])
def test_scores_are_those_of_the_definition(spark, monkeypatch, block, worked):
    monkeypatch.setattr(m, "BLOCK", block)
    monkeypatch.setattr(m, "WORKED", worked)
    texts = some_texts(block)
    learn = [k % 4 != 1 for k in range(len(texts))]
    found = scored(documents(spark, texts), F.col("doc_id") % 4 != 1)
    expected = zip(base_scores(texts, learn), mixed_scores(texts, learn), strict=True)
    assert len(found) == len(texts)
    for k, ((tokens, known, total, base), score) in enumerate(expected):
        row = found[k]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (tokens, known, total)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert row.score == pytest.approx(score, rel=2e-3, abs=2e-3)


def test_weights_learn_within_a_text(monkeypatch):
    texts = [" ".join(t.split()) for t in some_texts(5, 80) if t]
    learn = [k < 60 for k in range(len(texts))]
    moving = mixed_scores(texts, learn)[60:80]
    monkeypatch.setattr(m, "STEP", 0.0)
    assert sum(moving) > sum(mixed_scores(texts, learn)[60:80])


def test_streams_spell_words():
    texts = ["One  two", "", " x ", "\n\n", "é\t"]
    [piece] = pieces(pa.array(texts))
    stream = m.stream_of(piece)
    found = [stream.data[a:b].tobytes() for a, b in zip(stream.firsts, stream.lasts, strict=True)]
    assert found == [spelled(t) for t in texts]


def test_bytes_are_lowered_and_told_from_white_space():
    data = np.arange(256, dtype=np.uint8)
    assert lowered(data).tobytes() == bytes(range(256)).lower()
    assert visible(data).tolist() == [byte not in b" \t\n\v\f\r" for byte in range(256)]


def test_distinct_values_are_in_order():
    top = np.uint64((1 << 64) - 1)
    for values in ([], [top], [top, 3, top - np.uint64(1), 3, 0, top]):
        values = np.array(values, np.uint64)
        assert m._distinct(values).tolist() == sorted(set(values.tolist()))


def test_awkward_rows(spark):
    docs = awkward_rows(spark)
    rows = m.score(docs.withColumn("learn", F.lit(True))).collect()
    assert len(rows) == docs.count()
    ends = {r.doc_id: r.n_tokens for r in rows if r.doc_id in (2, 3)}
    assert ends == {2: 1, 3: 1}
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    assert len({r.score for r in rows if r.doc_id == 1}) == 1
    nothing = m.score(docs.withColumn("learn", F.lit(False))).collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in nothing} == {(0, 0, 0.0)}
    assert m.score(docs.limit(0).withColumn("learn", F.lit(True))).collect() == []


def test_contexts_do_not_share_counts():
    data = np.random.default_rng(3).integers(97, 123, 60_000, np.uint8)
    before = m.befores(data)
    for order, row in zip(m.ORDERS, m.rows_of(before), strict=True):
        assert len(np.unique(row)) == len({data[k - order : k].tobytes() for k in range(8, len(data))})


def test_counts_of_all_blocks_come_back_to_each(spark, monkeypatch):
    monkeypatch.setattr(m, "BLOCK", 400)
    texts = [t for t in some_texts(11) if t]
    blocks = m.in_blocks(documents(spark, texts).withColumn("learn", F.lit(True)))
    counts = Counter()
    for text in texts:
        data = bytes([10]) * 8 + spelled(text)
        for k in range(8, len(data)):
            for row in m.rows_of(m.befores(np.frombuffer(data[k - 8 : k] + b"\0", np.uint8))):
                counts[int(row[0]), data[k]] += 1
    found, answers = {}, 0
    for row in m.block_counts(blocks).collect():
        got = m._unpacked(row.packed)
        answers += len(got.keys)
        pairs = zip(np.repeat(got.keys, got.sizes).tolist(), got.symbols.tolist(), strict=True)
        found |= dict(zip(pairs, got.counts.tolist(), strict=True))
    assert found == counts
    assert answers > len({key for key, _ in counts})


def test_contexts_tell_bytes_beyond_the_common_ones_apart(spark):
    rng = random.Random(2)
    common = [chr(33 + k) for k in range(94) if not chr(33 + k).isupper()]
    main = ["".join(rng.sample(common, 40)) for _ in range(400)]
    script = "\u0905\u0906\u0907\u0908\u0909\u090a\u090b\u090c"
    minor = [(script + " ") * 3 for _ in range(40)]
    docs = documents(spark, [*main, *minor])
    row = {r.doc_id: r.score for r in m.score(docs.withColumn("learn", F.col("doc_id") != 439)).collect()}
    # each byte follows from those before it
    assert -row[439] / math.log10(2) < 1.5 * len(spelled(minor[0]))


def test_a_block_counts_its_words_by_hash(spark):
    """Learned or not, learned in some texts only, and blocks of which nothing is learned."""
    rows = [(0, "a b a", True), (0, "b c", False), (0, None, True), (1, "c c", False), (1, "", False), (2, "a", True)]
    blocks = spark.createDataFrame(rows, "block long, text string, learn boolean").coalesce(1)
    found = [tuple(row) for row in m.block_words(blocks).collect()]
    name = {h: w for w in "abc" for h in m.words_of(next(iter(pieces(pa.array([w])))), m.VISIBLE).hashes.view(np.int64).tolist()}
    assert sorted((block, name[word], n) for block, word, n in found) == [(0, "a", 2), (0, "b", 1), (0, "c", 0), (1, "c", 0), (2, "a", 1)]


def test_counts_of_tokens_against_brute_force():
    rng = np.random.default_rng(3)
    for size, shared in ((0, 0), (0, 4), (1, 0), (50, 0), (50, 9), (400, 30)):
        tokens = rng.integers(0, 40, size).astype(np.uint64) << np.uint64(58)
        word = np.unique(rng.integers(0, 60, shared).astype(np.uint64) << np.uint64(58))
        learn, count = rng.random(size) < 0.6, rng.integers(1, 1000, len(word))
        everywhere = dict(zip(word.tolist(), count.tolist(), strict=True))
        here = Counter(t for t, use in zip(tokens.tolist(), learn, strict=True) if use)
        expected = [everywhere.get(t, here[t]) for t in tokens.tolist()]
        assert m._counts(tokens, learn, word, count).tolist() == expected


def test_counts_of_tokens_whose_hashes_doubles_do_not_tell_apart():
    top = (1 << 64) - 1
    learned, shared, unseen = ([top - k for k in range(first, 60, 3)] for first in range(3))
    tokens, learn = [*learned, *learned, *shared, *unseen, 0], [True] * 40 + [False] * 41
    tokens, word = np.array(tokens, np.uint64), np.array(shared[::-1], np.uint64)
    found = m._counts(tokens, np.array(learn), word, np.arange(5, 25))
    assert found.tolist() == [2] * 40 + [*range(24, 4, -1)] + [0] * 21

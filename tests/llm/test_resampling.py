import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from awkward import LONG, awkward_rows, documents
from pyspark.sql import functions as F
from tabularium.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def features(text, runs):
    words = WORD.findall(lowered(text))
    return [" ".join(words[k : k + n]) for n in range(1, runs + 1) for k in range(len(words) - n + 1)]


def brute_force(docs, target, percent=10, least=20, runs=1, buckets=10_000, seed="2024"):
    """Rows of (doc_id, n_words, n_features, weight, score, rank) by the definition."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    source, aim = [0] * buckets, [0] * buckets
    for texts, counts in (([t for _, t in docs], source), (target, aim)):
        for text in texts:
            for f in features(text, runs):
                counts[bucket(f)] += 1
    s_all, t_all = sum(source) + buckets, sum(aim) + buckets
    out = []
    for i, text in docs:
        found = features(text, runs)
        gains = [
            math.floor(1000 * math.log((aim[b] + 1) * s_all / ((source[b] + 1) * t_all))) for b in map(bucket, found)
        ]
        weight = sum(gains) // len(gains) if gains else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(features(text, 1)), len(found), weight, score, None])
    able = sorted((r for r in out if r[0] is not None and r[1] >= least), key=lambda r: (-r[4], r[0]))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[5] = rank
    return sorted(map(tuple, out), key=str)


def check(found, docs, target, **options):
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, found.collect()), key=str) == brute_force(docs, target, **options)


def random_texts(rng, n):
    words = ["Ab", "cd", "é", "漢字", "x9", "toolong" * 12, "z"]
    return [rng.choice([" ", "-", ", "]).join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("options", [{}, {"runs": 3, "buckets": 97, "percent": 37, "least": 3, "seed": "x"}])
def test_draw_equals_the_definition(spark, monkeypatch, options):
    monkeypatch.setattr(resampling, "BLOCK_BITS", 3)
    monkeypatch.setattr(resampling, "BLOCKS_BITS", 30)
    monkeypatch.setattr(resampling, "DIGIT_BITS", 4)
    rng = random.Random(3)
    texts, target = random_texts(rng, 150), random_texts(rng, 20)
    found = resampling.resample(documents(spark, texts), documents(spark, target), **options)
    check(found, list(enumerate(texts)), target, **options)


def test_awkward_rows(spark):
    docs = awkward_rows(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = resampling.resample(docs, docs, percent=100, least=2)
    # rows given twice take ranks one after the other, either may be first
    check(found, rows, [t for _, t in rows], percent=100, least=2)
    assert max(r.n_words for r in found.collect()) == len(LONG.split())


def test_empty_tables(spark):
    docs = documents(spark, ["one two three four"] * 10)
    none = docs.limit(0)
    assert resampling.resample(none, docs).collect() == []
    found = resampling.resample(docs, none, percent=50, least=1)
    check(found, [(k, "one two three four") for k in range(10)], [], percent=50, least=1)


@pytest.mark.parametrize("digit_bits", [2, 11])
def test_radix_ranks_are_those_of_a_sort(spark, monkeypatch, digit_bits):
    monkeypatch.setattr(resampling, "DIGIT_BITS", digit_bits)
    monkeypatch.setattr(resampling, "BLOCK_BITS", 2)
    monkeypatch.setattr(resampling, "BLOCKS_BITS", 30)
    rng = random.Random(digit_bits)
    limit = 1 << 62 if digit_bits == 11 else 9
    rows = [(rng.randint(-limit, limit), rng.randint(0, limit), k) for k in range(60)]
    rows += [(0, 0, 100 + k) for k in range(40)]  # a third and more are equal
    frame = spark.createDataFrame(rows, "a long, b long, payload long").repartition(5)
    ranked = sorted(resampling.radix_ranks(frame, ["a", "b"], "place").collect(), key=lambda r: r.place)
    assert [r.place for r in ranked] == list(range(1, len(rows) + 1))
    assert [(r.a, r.b) for r in ranked] == sorted((a, b) for a, b, _ in rows)
    assert sorted(r.payload for r in ranked) == sorted(k for *_, k in rows)


def test_equal_keys_and_one_row(spark):
    one = spark.range(7).select(F.lit(5).cast("long").alias("a"))
    assert sorted(r.place for r in resampling.radix_ranks(one, ["a"], "place").collect()) == list(range(1, 8))


def test_hashes_of_short_and_long_features():
    rng = np.random.default_rng(5)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = rng.integers(0, 4000, 300)
    ends = starts + rng.integers(1, 200, 300)
    expected = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
    assert resampling.crc32s(data, starts, ends).tolist() == expected

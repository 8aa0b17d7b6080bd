import random
import re

import numpy as np
import pytest
from awkward import awkward_rows, documents
from tabularium.llm import components as c, minhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def groups(pairs, ids):
    found = {i: i for i in ids}
    for a, b in pairs:
        low, high = sorted((found[a], found[b]))
        for i, g in found.items():
            if g == high:
                found[i] = low
    return found


def brute_force(texts, percent):
    sets = [shingles(t) for t in texts]
    pairs = [
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    found = groups(pairs, range(len(texts)))
    return sorted((i, len(sets[i]), found[i], found[i] == i) for i in found)


def near_copies(seed, roots=12, copies=9):
    """Chains and stars of copies around the threshold, exact copies and short texts."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    texts = []
    for _ in range(roots):
        made = [[word() for _ in range(rng.choice([30, 60, 150]))]]
        for _ in range(copies):
            text = list(rng.choice(made))
            for _ in range(rng.randrange(4)):
                text[rng.randrange(len(text))] = word()
            made.append(text)
        texts += [" ".join(t) for t in made]
    texts += ["Same  short", "same short ", "one", "", None, "  \n"]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("percent, cell", [(85, 512), (80, 2), (85, 3)])
def test_groups_are_those_of_all_pairs(spark, monkeypatch, percent, cell):
    monkeypatch.setattr(minhash, "CELL", cell)
    texts = near_copies(percent + cell)
    found = minhash.near_duplicates(documents(spark, texts), percent)
    assert sorted(map(tuple, found.collect())) == brute_force(texts, percent)


def test_estimates_follow_similarity():
    rng = np.random.default_rng(3)
    shared = rng.integers(0, 1 << 63, 900, np.uint64)
    sets = [np.concatenate((shared, rng.integers(0, 1 << 63, 100, np.uint64))) for _ in range(2)]
    minima = minhash._minima(np.concatenate(sets), np.array([0, 1000]))
    words = minhash._packed(minima).view(np.uint64)
    chance = 2.0**-minhash.BITS
    estimate = (minhash.agreeing(words[0], words[1]) / minhash.MINIMA - chance) / (1 - chance)
    assert estimate == pytest.approx(900 / 1100, abs=0.08)
    assert minhash.agreeing(words[0], words[0]) == minhash.MINIMA


def test_bands_miss_next_to_nothing():
    for percent in (80, 85, 100):
        limits = minhash.Limits.of(percent)
        assert (1 - (percent / 100) ** minhash.ROWS) ** limits.bands <= minhash.MISS
    with pytest.raises(ValueError):
        minhash.Limits.of(20)


def test_awkward_rows(spark):
    docs = awkward_rows(spark)
    found = {(r.doc_id, r.n_shingles > 0, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert found == {
        (1, True, 1, True),
        (2, False, 2, True),
        (3, False, 3, True),
        (4, True, 4, True),
        (5, True, 5, True),
        (6, True, 6, True),
        (None, True, None, True),
    }
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == 7
    assert minhash.near_duplicates(docs.limit(0)).count() == minhash.keep_one(docs.limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    texts = near_copies(5)
    kept = {r.doc_id for r in minhash.keep_one(documents(spark, texts), 80).collect()}
    assert kept == {i for i, _, group, _ in brute_force(texts, 80) if i == group}


@pytest.mark.parametrize("shape", ["path", "star", "random", "none", "loops"])
def test_components(spark, shape):
    rng = random.Random(9)
    ids = rng.sample(range(-500, 500), 120)
    pairs = {
        "path": list(zip(ids[:-1], ids[1:], strict=True)),
        "star": [(ids[0], x) for x in ids[1:]],
        "random": [tuple(rng.sample(ids, 2)) for _ in range(80)],
        "none": [],
        "loops": [(5, 5), (5, 6), (6, 5), (6, 7), (None, 5), (7, None)],
    }[shape]
    table = spark.createDataFrame(pairs, "a long, b long").repartition(3)
    whole = [(a, b) for a, b in pairs if a is not None and b is not None and a != b]
    expected = groups(whole, {x for pair in whole for x in pair})
    found = c.components(table).collect()
    assert len(found) == len(expected) and {r.id: r.component for r in found} == expected


def test_one_id_with_several_texts(spark):
    rng = random.Random(4)
    text = lambda n: " ".join(f"w{rng.randrange(10_000)}" for _ in range(n))
    a, b, clean = text(80), text(90), text(70)
    near = lambda t: f"{t} more"
    rows = [(1, a), (2, near(a)), (2, clean), (3, near(clean)), (4, b), (4, b), (4, near(b)), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted((r.doc_id or 0, r.text) for r in minhash.keep_one(docs, 80).collect())
    assert (1, a) in kept and (2, clean) in kept and (0, a) in kept
    assert len(kept) == 4 and [i for i, t in kept if t in (b, near(b))] == [4]


def test_rows_that_are_there_many_times_are_read_once(spark, monkeypatch):
    """Two near copies, each a thousand times: one pair of texts is compared, not a million."""
    rng = random.Random(5)
    text = " ".join(f"w{rng.randrange(10_000)}" for _ in range(60))
    rows = [(1, text), (2, f"{text} more")] * 1000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    read = []
    confirmed = minhash._confirmed

    def counted(pairs, texts, limits):
        read.append((pairs.count(), texts.count()))
        return confirmed(pairs, texts, limits)

    monkeypatch.setattr(minhash, "_confirmed", counted)
    found = minhash.near_duplicates(docs, 80).collect()
    assert len(found) == 2000 and {r.component_id for r in found} == {1}
    assert read == [(1, 2), (0, 2), (0, 2)]
    assert [r.doc_id for r in minhash.keep_one(docs, 80).collect()] == [1]

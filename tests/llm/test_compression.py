import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from tabularium.llm import compression

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error string"


def table(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(partitions)


def brute_force(rows, parts=4, entries=256, rounds=4, scale=1024):
    """Rows of (vec_id, code, error, label_error, sha256) by the definition, in unbounded numbers."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = max(1, -(-max((len(r[1]) for r in rows), default=0) // parts))
    cut = []
    for _, vector, _ in rows:
        whole = [math.floor(Fraction(x) * scale) for x in vector]
        whole += [0] * (parts * width - len(whole))
        cut.append([whole[p * width : (p + 1) * width] for p in range(parts)])
    first = sorted({(r[0], tuple(r[1])): c for r, c in zip(rows, cut, strict=True) if r[0] is not None}.items())
    books = [[c[p] for _, c in first[:entries]] for p in range(parts)]

    def place(part, p):
        far = [sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)) for entry in books[p]]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            at = [place(c[p], p)[0] for c in cut]
            for k in range(len(books[p])):
                mine = [c[p] for c, a in zip(cut, at, strict=True) if a == k]
                if mine:
                    books[p][k] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    coded = [[place(c[p], p) for p in range(parts)] for c in cut]
    errors = [sum(e for _, e in c) for c in coded]
    total = {}
    for r, e in zip(rows, errors, strict=True):
        total[r[2]] = total.get(r[2], 0) + e
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    sha = hashlib.sha256(text.encode()).hexdigest()
    long = lambda x: x if x < 2**63 else None
    return [
        (r[0], "".join(f"{k:02x}" for k, _ in c), long(e), long(total[r[2]]), sha)
        for r, c, e in zip(rows, coded, errors, strict=True)
    ]


def check(spark, rows, **options):
    found = compression.compress(table(spark, rows), **options)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(brute_force(rows, **options), key=str)


@pytest.mark.parametrize("width, options", [(12, {"entries": 7}), (8, {"parts": 2, "entries": 9, "rounds": 2, "scale": 3})])
def test_codes_equal_the_definition(spark, width, options):
    rng = random.Random(width)
    # few values, so that distances tie; a third of all rows are one vector
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(width)], rng.choice([1, 2, None])) for i in range(80)]
    rows += [(1000 + i, [0.25] * width, 2) for i in range(40)]
    rng.shuffle(rows)
    check(spark, rows, **options)


def test_awkward_rows(spark):
    vector = [0.1, -0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8]
    rows = [(1, vector, 1), (1, vector, 1), (1, vector[::-1], 1), (None, [0.3] * 8, None), (2, None, 1)]
    rows += [(3, [None, *vector[1:]], 1), (4, [math.nan] * 8, 1), (5, [math.inf] * 8, None), (6, [], 3)]
    rows += [(7, [1.5], None), (8, [0.2] * 9, 4), (-9, [0.0, -0.0] * 4, 4)]
    check(spark, rows)
    check(spark, rows, entries=2, rounds=1)


def test_numbers_of_any_size(spark):
    rows = [(i, [0.5 * i, -1e7, 3e15 * i, 1.0], i % 2) for i in range(6)]
    rows += [(10, [1e300, -1e300, 1.7e308, 5e-324], 5), (11, [1e19, 2.0, -1e19, 0.0], 5)]
    check(spark, rows, entries=4)


def test_empty_and_unusable_tables(spark):
    assert compression.compress(table(spark, [(1, [1.0], 1)]).limit(0)).collect() == []
    assert compression.compress(table(spark, [(1, None, 1), (None, [1.0], 2)])).collect() == []


def test_transform_counts_sign_changes_and_keeps_distances():
    for n in (1, 2, 8, 16):
        walsh = compression.transform(np.eye(n, dtype=np.int64)).T
        assert [(row[1:] != row[:-1]).sum() for row in walsh] == list(range(n))
        assert (walsh @ walsh.T == n * np.eye(n)).all()


def test_entries_go_early():
    rng = np.random.default_rng(3)
    smooth = np.cumsum(rng.integers(-9, 10, (400, 16)), axis=1)
    place, error = compression.nearest(smooth, smooth[:50])
    far = ((smooth[:, None] - smooth[None, :50]) ** 2).sum(axis=2)
    assert (place == far.argmin(axis=1)).all() and (error == far.min(axis=1)).all()


def test_decoded_vectors_are_near(spark):
    rng = random.Random(1)
    rows = [(i, [rng.random() for _ in range(8)], 1) for i in range(30)]
    usable = compression.usable(table(spark, rows))
    books = compression.learn(usable, entries=30, rounds=0)
    for row in compression.encode(usable, books).collect():
        assert row.error == 0
        assert max(abs(a - b) for a, b in zip(compression.decode(row.code, books), rows[row.vec_id][1], strict=True)) < 1 / 1024

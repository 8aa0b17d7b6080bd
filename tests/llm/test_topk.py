import math
import random

import numpy as np
import pytest
from tabularium.llm import topk

SCHEMA = "vec_id long, embedding array<float>, rank string, score double"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0.0) for i, v in rows], SCHEMA).repartition(3)


def brute_force(rows, asked, k):
    whole = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            whole[i] = [math.floor(256 * x) for x in v]
    out = []
    for q in asked:
        if q in whole:
            scores = [
                (-sum(a * b for a, b in zip(whole[q], v, strict=True)), i)
                for i, v in whole.items()
                if i != q and len(v) == len(whole[q])
            ]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block, query_block", [(8192, 4096), (7, 3), (1, 1)])
def test_the_best_are_those_of_all_pairs(spark, monkeypatch, block, query_block):
    monkeypatch.setattr(topk, "BLOCK", block)
    rng = random.Random(block)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 0.5]) for _ in range(6)]) for i in range(60)]
    rows += [(100, [0.0] * 6), (150, None), (151, []), (152, [1.0, None] + [0.0] * 4), (153, [math.nan] * 6)]
    rows += [(154, [math.inf] * 6), (155, [1.0, 2.0]), (156, [2.0, 2.0]), rows[3], rows[3], (None, [1.0] * 6)]
    vectors = topk.scaled(table(spark, rows))
    asked = [0, 3, 10, 50, 100, 150, 153, 155]
    queries = vectors.where(vectors.vec_id.isin(asked))
    found = topk.top_k(queries, vectors, k=4, query_block=query_block).collect()
    assert sorted(map(tuple, found)) == brute_force(rows, asked, 4)


def test_empty_tables(spark):
    vectors = topk.scaled(table(spark, [(1, [1.0])]))
    none = vectors.limit(0)
    assert topk.top_k(none, vectors).collect() == []
    assert topk.top_k(vectors, none).collect() == []
    assert topk.top_k(vectors, vectors).collect() == []


def test_reading_stops_early():
    import numpy as np

    rng = np.random.default_rng(1)
    block = np.floor(rng.normal(0, 5, (4096, 4)))
    block[:20] += 500
    best = topk.Best(np.full((1, 5), 1 << 60), np.full((1, 5), -math.inf))
    scored = topk.search_block(np.arange(4096), block, np.array([-1]), np.ones((1, 4)), best)
    assert scored < 1000
    assert set(best.ids[0]) <= set(range(20))


def test_rows_given_twice_hide_no_others(spark):
    rng = random.Random(8)
    rows = [(i, [rng.randrange(-256, 257) / 256 for _ in range(6)]) for i in range(1500)]
    best = max(range(1500), key=lambda i: sum(a * b for a, b in zip(rows[3][1], rows[i][1], strict=True)))
    for given in (rows * 2, [*rows, *[rows[best]] * 8]):
        vectors = topk.scaled(table(spark, given).coalesce(1))
        asked = list(range(20))
        found = topk.top_k(vectors.where(vectors.vec_id.isin(asked)), vectors, k=5).collect()
        assert sorted(map(tuple, found)) == brute_force(rows, asked, 5)


def test_equal_scores_of_one_id_hide_no_others():
    import numpy as np

    best = topk.Best(np.full((1, 3), topk._LAST), np.full((1, 3), topk._NONE))
    best.take(0, np.array([7] * 12 + [8, 9]), np.array([5.0] * 12 + [4.0, 3.0]))
    assert (best.ids[0].tolist(), best.scores[0].tolist()) == ([7, 8, 9], [5.0, 4.0, 3.0])


@pytest.mark.parametrize("large", [1e7, 1e30, 3e38])
def test_large_components_are_scored_exactly(spark, large):
    rng = random.Random(large)
    small = [(i, [float(rng.randint(-3, 3)) for _ in range(8)]) for i in range(40)]
    big = [(100 + i, [large * rng.choice([-1.0, 0.0, 1.0]) + rng.randint(-2, 2) for _ in range(8)]) for i in range(20)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in small + big]
    vectors = topk.scaled(table(spark, rows))
    asked = [0, 7, 100, 111]
    found = topk.top_k(vectors.where(vectors.vec_id.isin(asked)), vectors, k=4).collect()
    expected = [(q, r, i, s if -(2**63) <= s < 2**63 else None) for q, r, i, s in brute_force(rows, asked, 4)]
    assert sorted(map(tuple, found), key=lambda r: r[:2]) == expected
    assert large == 1e7 or any(score is None for *_, score in expected)


def test_components_beyond_all_doubles_take_no_part(spark):
    schema = "vec_id long, embedding array<double>"
    rows = [(0, [1.0, 2.0]), (1, [1.7e308, 0.0]), (2, [1e300, 1.0]), (3, [-3.0, 0.5])]
    vectors = topk.scaled(spark.createDataFrame(rows, schema))
    found = topk.top_k(vectors.where("vec_id = 0"), vectors, k=4).collect()
    assert sorted(map(tuple, found)) == [(0, 1, 2, None), (0, 2, 3, 256 * 256 * (-3 * 1 + 1))]


def test_one_block_of_queries_is_held_at_a_time(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1.0, 0.5, 2.0]) for _ in range(3)]) for i in range(30)]
    vectors = topk.scaled(table(spark, rows))
    sizes, search = [], topk._search

    def counted(asked, vectors, k):
        sizes.append(len(asked))
        return search(asked, vectors, k)

    monkeypatch.setattr(topk, "_search", counted)
    found = topk.top_k(vectors, vectors, k=2, query_block=5).collect()
    assert sorted(map(tuple, found)) == brute_force(rows, range(30), 2)
    assert len(sizes) == 6 and sum(sizes) == 30 and max(sizes) <= 12

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from awkward import awkward_rows, documents
from pyspark.sql import functions as F
from tabularium.llm import lbfgs, toxicity


def scores(docs, machine):
    return {r.doc_id: r.s for r in docs.select("doc_id", toxicity.score(F.col("text"), machine).alias("s")).collect()}


def interacting(spark):
    """Two words that are harmless alone, or with each other's like, and toxic together."""
    rng = random.Random(4)
    texts, labels = [], []
    for k in range(1600):
        text = rng.choices([f"w{i}" for i in range(40)], k=12)
        one, other = k % 4 in (0, 1), k % 4 in (0, 2)
        text += ["Insult!"] * one + ["group"] * other
        texts.append(" ".join(rng.sample(text, len(text))))
        labels.append((k, int(one and other)))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id long, label int")


def test_pairs_count_where_sums_do_not(spark):
    docs, labels = interacting(spark)
    machine = toxicity.learn(docs, labels)
    found = scores(docs, machine)
    toxic = {r.doc_id for r in labels.where("label = 1").collect()}
    assert min(found[i] for i in toxic) > max(s for i, s in found.items() if i not in toxic)
    assert all((s >= 0.3) == (i in toxic) for i, s in found.items())
    model = machine.value
    assert abs(model.factors).max() > 0.5


def test_the_model_depends_on_the_rows_only(spark):
    docs, labels = interacting(spark)
    one = toxicity.learn(docs.repartition(1), labels.repartition(5), sample=500)
    other = toxicity.learn(docs.repartition(7), labels, sample=500)
    assert one.value.weights == pytest.approx(other.value.weights, abs=1e-9)
    assert 400 < toxicity.sample_labels(labels, 500).count() < 600


def test_awkward_rows(spark):
    docs = awkward_rows(spark)
    labels = spark.createDataFrame(
        [(1, 1), (1, 1), (2, 0), (3, None), (None, 1), (6, 0), (99, 1)], "doc_id long, label int"
    )
    machine = toxicity.learn(docs, labels)
    found = scores(docs, machine)
    assert all(0 <= s <= 1 for s in found.values())
    assert found[2] == found[3] == found[4]
    assert scores(docs.limit(0), machine) == {}


@pytest.mark.parametrize("rows", [[], [(1, 0)], [(1, 1)], [(1, None)]])
def test_without_two_kinds_of_labels_the_bias_is_all(spark, rows):
    docs = documents(spark, ["a", "b c", None])
    machine = toxicity.learn(docs, spark.createDataFrame(rows, "doc_id long, label int"))
    found = set(scores(docs, machine).values())
    assert len(found) == 1
    if not [1 for _, label in rows if label is not None]:
        assert found == {0.0}


def test_pairs_count_where_each_term_alone_tells_nothing(spark):
    rng = random.Random(6)
    texts, labels = [], []
    for k in range(3200):
        text = rng.choices([f"w{i}" for i in range(40)], k=12)
        one, other = k % 4 in (0, 1), k % 4 in (0, 2)  # each in half of either kind
        text += ["insult"] * one + ["group"] * other
        texts.append(" ".join(rng.sample(text, len(text))))
        labels.append((k, int(one == other)))
    known = [row for row in labels if row[0] % 8 < 4]
    machine = toxicity.learn(documents(spark, texts), spark.createDataFrame(known, "doc_id long, label int"))
    found = scores(documents(spark, texts), machine)
    right = [(found[k] >= 0.5) == label for k, label in labels if k % 8 >= 4]
    assert sum(right) > 0.95 * len(right)


@pytest.mark.parametrize("share", [0.1, 0.05])
def test_pairs_of_uncommon_terms_that_tell_nothing_alone(spark, share):
    """In a share of the texts two of four words decide by agreeing; all other labels are thrown."""
    rng = random.Random(share)
    texts, labels, told = [], [], set()
    for k in range(4000):
        text, label = rng.choices([f"w{i}" for i in range(40)], k=12), rng.randrange(2)
        if rng.random() < share:
            one, other = rng.randrange(2), rng.randrange(2)
            text, label = [*text, f"insult{one}", f"group{other}"], int(one == other)
            told.add(k)
        texts.append(" ".join(rng.sample(text, len(text))))
        labels.append((k, label))
    known = [row for row in labels if row[0] % 4]
    machine = toxicity.learn(documents(spark, texts), spark.createDataFrame(known, "doc_id long, label int"))
    found = scores(documents(spark, texts), machine)
    right = [(found[k] >= 0.5) == label for k, label in labels if not k % 4 and k in told]
    assert len(right) > 30 and sum(right) >= 0.95 * len(right)


def test_scores_are_the_sum_over_pairs(spark):
    rng = np.random.default_rng(3)
    feature = np.zeros(toxicity.SLOTS, np.int32)
    feature[rng.choice(toxicity.SLOTS, toxicity.SLOTS // 2, replace=False)] = rng.integers(1, 30, toxicity.SLOTS // 2)
    machine = toxicity.Machine(feature, 0.3, rng.normal(size=30), rng.normal(size=(30, 4)))
    texts = ["a b c d e f g", "Z y, z; x", "", "unknown", None, "é 漢字 one two " * 9]
    found = scores(documents(spark, texts), toxicity.send(spark, machine))
    for k, text in enumerate(texts):
        terms = set()
        for piece in toxicity.pieces(pa.array([text], pa.string())):
            hashes = toxicity.words_of(piece, toxicity.ALNUM).hashes.tolist()
            terms = {int(feature[h % toxicity.SLOTS]) for h in hashes} - {0}
        logit = machine.bias + sum(machine.weights[i] for i in terms)
        logit += sum(machine.factors[i] @ machine.factors[j] for i, j in itertools.combinations(sorted(terms), 2))
        assert found[k] == pytest.approx(1 / (1 + np.exp(-logit)))


def test_the_slope_is_that_of_the_value():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9, 5)) for _ in range(30)]
    posterior = toxicity.Posterior(toxicity.Sample(sets, rng.integers(0, 2, 30).astype(float)))
    point = rng.normal(size=1 + 3 * posterior.sample.width)
    _, slope = posterior(point)
    for k in range(len(point)):
        step = np.zeros(len(point))
        step[k] = 1e-6
        assert (posterior(point + step)[0] - posterior(point - step)[0]) / 2e-6 == pytest.approx(slope[k], abs=1e-5)


def test_directions_are_the_leading_eigenvectors():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 12, 5)) for _ in range(200)]
    labels = np.array([float(3 in s) if 5 in s else float(3 not in s) for s in sets])
    posterior = toxicity.Posterior(toxicity.Sample(sets, labels))
    sample, rate = posterior.sample, labels.mean()
    held = np.zeros((len(sets), sample.width))
    held[sample.owner, sample.feature] = 1
    lean = (labels - rate) * np.minimum(1, toxicity.LEVERAGE / (held @ (1 / posterior.doubt)))
    centred = held - held.mean(axis=0)
    matrix = (centred * lean[:, None]).T @ centred
    np.fill_diagonal(matrix, 0)
    scale = 1 / np.sqrt(posterior.doubt)
    values, vectors = np.linalg.eigh(scale[:, None] * matrix * scale)
    found = toxicity.directions(posterior, rate)
    first = scale * vectors[:, -1]
    assert abs(found[0] @ first) == pytest.approx(np.linalg.norm(found[0]) * np.linalg.norm(first), rel=1e-6)
    assert set(np.argsort(-abs(found[0] / scale))[:2]) == {3, 5}


def test_a_penalty_holds_coordinates_at_rest():
    target = np.array([3.0, 0.5, -2.0, 4.0])
    found = lbfgs.minimise(lambda x: (((x - target) ** 2).sum() / 2, x - target), np.zeros(4), np.array([1.0, 1.0, 1.0, 0.0]), 50)
    assert found == pytest.approx([2, 0, -1, 4], abs=1e-4) and found[1] == 0
    rng = np.random.default_rng(5)
    a = rng.normal(size=(20, 20))
    a = a @ a.T + np.eye(20)
    b = rng.normal(size=20)
    found = lbfgs.minimise(lambda x: (x @ a @ x / 2 - b @ x, a @ x - b), np.zeros(20), np.zeros(20), 300)
    assert np.allclose(found, np.linalg.solve(a, b), atol=0.05)

"""Toxicity of texts by a factorisation machine over hashed terms.

A text is the set of slots that its lower-cased words hash to. Its score is the logistic function of

    bias + sum of w[i] + sum over pairs of <v[i], v[j]>

so that two terms may mean together what neither means alone. All slots that at least ``LEAST`` sample texts
hold have a weight and factors, whether or not they tell labels apart alone.

The machine is the most probable one under priors that say how little a few texts prove (:func:`fit`). Weights have a Laplace
prior: a term's evidence must exceed what chance gives the clearest of so many terms that as many texts hold; the weights that
do are fitted again under a weaker one, so that they are not kept small by it. Factors have a Gaussian prior whose precision grows with the
texts that hold a term and with the length of texts, as one text's label speaks for all pairs of its terms at once. They start
along the directions in which pairs of terms, beyond what each says alone, tell labels apart most (the leading
eigenvectors of the centred pair matrix, found by multiplications, without making it); from 0 they could not move.

The machine is learned from a bounded sample of labelled texts (``sample``, the expected size). Tasks turn texts to slots; the
slot sets of the sample go to one task, which fits, and the driver gets the weights and factors only. Rows are
put in order by the hashes of the texts, so the same rows give the same machine however they are stored. Scoring looks
words up in a table of fixed size.

Empty, null and wordless texts score as the bias alone. Rows whose label is null are not learned from; a
text under two labels counts once for each. Without labels every score is 0; with one kind of label
the bias is all there is.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabularium.llm.arrow import Sent, batchwise, send, tidy
from tabularium.llm.lbfgs import minimise
from tabularium.llm.words import ALNUM, pieces, words_of

#: Expected number of labelled texts that are learned from.
SAMPLE = 20_000
#: Hash slots of terms; a slot is kept if this many sample texts hold it.
SLOTS, LEAST = 1 << 20, 2
FACTORS, ROUNDS, TURNS = 4, 60, 30
#: The share of a round's gain below which the fit ends; what would follow is mostly learned by heart.
ENOUGH = 3e-4
#: Priors, picked by three-fold tests within the learning fold: of weights as shares of the bound of chance, first and of
#: those that are left; of their squares; and of factors' squares, for each term of a text and each text that holds the term,
#: as if ``UNSEEN`` more did: with few of these, rare terms learn single texts by heart.
CHANCE, AGAIN, RIDGE, DOUBT, UNSEEN = 0.35, 0.1, 0.2, 0.0015, 250
#: How much one text counts at most where the factors' directions are looked for.
LEVERAGE = 0.1


class Machine(NamedTuple):
    """``feature`` maps slots to 0 (none) or to a row of weights and factors."""

    feature: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def logits(self, features: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Of ``n`` texts, from distinct (text, feature) pairs."""
        out = self.bias + np.bincount(owner, self.weights[features], n)
        for factor in self.factors.T:
            value = factor[features]
            total = np.bincount(owner, value, n)
            out += (total * total - np.bincount(owner, value * value, n)) / 2
        return out


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(SLOTS - 1)).astype(np.int64)


def _distinct(owner: np.ndarray, feature: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    return np.divmod(np.unique(owner * width + feature), width)


def _owners(bounds: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def _slot_sets(sample: DataFrame) -> DataFrame:
    """``label, place, slots``: the distinct slots of each text, and a hash to order texts by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch["text"]):
                words = words_of(piece, ALNUM)
                owner, slot = _distinct(_owners(words.bounds), _slots(words.hashes), SLOTS)
                starts = np.searchsorted(owner, np.arange(len(piece.bounds)))
                part = batch.slice(piece.first, piece.last - piece.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["label"],
                        part["place"],
                        pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(slot, pa.int32())),
                    ],
                    ["label", "place", "slots"],
                )

    return sample.select("text", "label", F.xxhash64("text").alias("place")).mapInArrow(
        run, "label int, place long, slots array<int>"
    )


class Sample:
    """Texts as sets of kept slots, for sums over texts and over features.

    ``feature`` has the features of all texts, one after the other, ``owner`` their texts.
    """

    def __init__(self, sets: list[np.ndarray], labels: np.ndarray):
        counts = np.bincount(np.concatenate([*sets, np.empty(0, np.int64)]).astype(np.int64), minlength=SLOTS)
        self.slots = np.flatnonzero(counts >= LEAST)
        place = np.zeros(SLOTS, np.int32)
        place[self.slots] = np.arange(len(self.slots))
        kept = [place[s[counts[s] >= LEAST]] for s in sets]
        self.labels, self.n = labels, len(sets)
        self.width = len(self.slots)
        self.held = counts[self.slots].astype(float)  # how many texts hold each feature
        self.owner = np.repeat(np.arange(self.n), [len(k) for k in kept])
        self.feature = np.concatenate([*kept, np.empty(0, np.int32)])
        del kept
        order = np.argsort(self.feature, kind="stable").astype(np.int32)
        self.owner_by_feature = self.owner[order].astype(np.int32)
        self.begins = np.append(0, np.cumsum(counts[self.slots]))[:-1].astype(np.int64)
        del order
        self.length = len(self.feature) / max(1, self.n)

    def by_text(self, values: np.ndarray) -> np.ndarray:
        """Of each text, the sum of its features' values."""
        return np.bincount(self.owner, values[self.feature], self.n)

    def by_feature(self, values: np.ndarray) -> np.ndarray:
        """Of each feature, the sum of its texts' values."""
        return np.add.reduceat(values[self.owner_by_feature], self.begins)


def _logistic(logits: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logits, -500, 500)))


class Posterior:
    """How improbable a machine is, up to a constant, and the slope of that; but for the Laplace prior.

    A point is the bias, the weights, and the factors of all features, one factor after the other.
    """

    def __init__(self, sample: Sample):
        self.sample = sample
        self.doubt = sample.held + sample.length
        self.precision = DOUBT * sample.length * (sample.held + UNSEEN)

    def parts(self, point: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        width = self.sample.width
        return point[0], point[1 : 1 + width], point[1 + width :].reshape(-1, width)

    def __call__(self, point: np.ndarray) -> tuple[float, np.ndarray]:
        sample = self.sample
        bias, weights, factors = self.parts(point)
        sums = [sample.by_text(factor) for factor in factors]
        # of all factors at once, the squares that are no pairs
        own = sample.by_text((factors * factors).sum(axis=0) / 2 - weights)
        logits = bias - own + sum((s * s for s in sums), np.zeros(sample.n)) / 2
        value = float(np.logaddexp(0, logits).sum() - sample.labels @ logits)
        value += RIDGE / 2 * float(weights @ weights) + float((self.precision * factors * factors).sum()) / 2
        error = _logistic(logits) - sample.labels
        pull = sample.by_feature(error)
        slope = [[error.sum()], pull + RIDGE * weights]
        for factor, total in zip(factors, sums, strict=True):
            slope.append(sample.by_feature(error * total) + (self.precision - pull) * factor)
        return value, np.concatenate(slope)


def directions(posterior: Posterior, rate: float) -> np.ndarray:
    """Factors along which pairs of features tell labels apart most, at most ``FACTORS`` of them."""
    sample = posterior.sample
    scale = 1 / np.sqrt(posterior.doubt)
    lean = sample.labels - rate
    lean = lean * np.minimum(1, LEVERAGE / np.maximum(sample.by_text(1 / posterior.doubt), 1e-12))
    usual = sample.held / sample.n
    own = sample.by_feature(lean) * (1 - 2 * usual) + usual * usual * lean.sum()

    def pairs(column: np.ndarray) -> np.ndarray:
        """The centred pair matrix, scaled and without its diagonal, times a column."""
        column = scale * column
        through = lean * (sample.by_text(column) - usual @ column)
        return scale * (sample.by_feature(through) - usual * through.sum() - own * column)

    n = min(sample.width, FACTORS + 4)
    found = np.linalg.qr(np.random.default_rng(7).normal(size=(sample.width, n)))[0]
    for _ in range(TURNS):  # moved by one, so that negative directions don't win
        found = np.linalg.qr(np.stack([pairs(c) + c for c in found.T], axis=1))[0]
    inner = found.T @ np.stack([pairs(c) for c in found.T], axis=1)
    strength, turn = np.linalg.eigh((inner + inner.T) / 2)
    best = np.argsort(-strength)[:FACTORS]
    best = best[strength[best] > 0]
    return scale * (found @ turn[:, best]).T


def fit(sets: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """Kept slots, bias, weights and factors (features by ``FACTORS``) from texts as sets of slots, and their labels."""
    sample = Sample(sets, labels)
    positive = float(labels.sum())
    bias = float(np.log((positive + 0.5) / (sample.n - positive + 0.5)))
    factors = np.zeros((sample.width, FACTORS))
    if not sample.width or not 0 < positive < sample.n:
        return sample.slots, bias, np.zeros(sample.width), factors
    rate = positive / sample.n
    posterior = Posterior(sample)
    begin = np.append(bias, np.zeros(sample.width))
    ways = directions(posterior, rate)
    sizes = [2.0**k for k in range(-3, 8)]
    points = [np.append(begin, (size * ways).ravel()) for size in sizes] if len(ways) else [begin]
    point = min(points, key=lambda p: posterior(p)[0])
    # the largest of so many sums of coin throws
    chance = np.sqrt(2 * np.log(max(2, sample.width)) * sample.held * rate * (1 - rate))
    penalty = np.zeros(len(point))
    penalty[1 : 1 + sample.width] = CHANCE * chance
    point = minimise(posterior, point, penalty, ROUNDS, ENOUGH)
    left = point[1 : 1 + sample.width] != 0
    penalty[1 : 1 + sample.width] = np.where(left, AGAIN * CHANCE * chance, 1e300)  # 0 stays 0
    point = minimise(posterior, point, penalty, ROUNDS, ENOUGH)
    bias, weights, found = posterior.parts(point)
    factors[:, : len(found)] = found.T
    return sample.slots, float(bias), weights, factors


def _fitted(sets: DataFrame) -> Machine:
    """The machine of all slot sets, which one task fits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        rows = [
            (label.as_py(), slots.values.to_numpy())
            for batch in batches
            for label, slots in zip(batch["label"], batch["slots"], strict=True)
        ]
        if rows:
            labels = np.array([label for label, _ in rows], np.float64)
            slots, bias, weights, factors = fit([slots for _, slots in rows], labels)
            parts = [slots.astype("<i4"), weights.astype("<f4"), factors.astype("<f4")]
            yield pa.RecordBatch.from_pydict({"bias": [bias], **{f"p{k}": [x.tobytes()] for k, x in enumerate(parts)}})
            del rows
        tidy()

    ordered = sets.repartition(1).sortWithinPartitions("place", "label")
    made = ordered.mapInArrow(run, "bias double, p0 binary, p1 binary, p2 binary").collect()
    feature = np.zeros(SLOTS, np.int32)
    if not made:
        return Machine(feature, -np.inf, np.zeros(1, "<f4"), np.zeros((1, FACTORS), "<f4"))
    row = made[0]
    slots = np.frombuffer(row.p0, "<i4")
    feature[slots] = np.arange(1, len(slots) + 1)
    weights = np.append(np.float32(0), np.frombuffer(row.p1, "<f4"))
    factors = np.frombuffer(row.p2, "<f4").reshape(-1, FACTORS)
    return Machine(feature, row.bias, weights, np.vstack([np.zeros((1, FACTORS), "<f4"), factors]))


def sample_labels(labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """About ``size`` rows of ``doc_id, label``, by the hash of the id; nulls and repeats are left out."""
    known = labels.select("doc_id", F.col("label").cast("int").alias("label")).where(
        "doc_id is not null and label is not null"
    )
    n, buckets = known.count(), 1 << 24
    cut = min(buckets, -(-buckets * size // max(1, n)))
    return known.where(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(buckets)) < cut).distinct()


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Sent:
    """A machine from ``doc_id, text`` and ``doc_id, label`` (0 or 1).

    Only the sampled ids are broadcast to find their texts: about ``sample`` of them, whatever the
    number of labels.
    """
    spark = docs.sparkSession
    chosen = F.broadcast(sample_labels(labels, sample))
    return send(spark, _fitted(_slot_sets(docs.select("doc_id", "text").join(chosen, "doc_id"))))


def score(text: Column, machine: Sent) -> Column:
    """Probability that a text is toxic."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = machine.value
        for batch in batches:
            out = []
            for piece in pieces(batch):
                words = words_of(piece, ALNUM)
                feature = model.feature[_slots(words.hashes)]
                used = np.flatnonzero(feature)
                owner = np.searchsorted(words.bounds, used, "right") - 1
                owner, feature = _distinct(owner, feature[used].astype(np.int64), len(model.weights))
                with np.errstate(over="ignore"):
                    logits = model.logits(feature, owner, piece.last - piece.first)
                    out.append(1 / (1 + np.exp(-logits)))
            yield pa.array(np.concatenate([np.empty(0), *out]), pa.float64())

    return batchwise("double", run)(text)

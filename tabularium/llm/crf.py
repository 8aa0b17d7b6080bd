"""Linear-chain conditional random fields over sparse features, in numpy.

A sequence is a run of tokens; each token has ``K`` active features, given as rows of the weight table, and a path of labels scores the
sum of its tokens' weights and of the weights between neighbouring labels.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Field(NamedTuple):
    """``weights``: features by labels; ``steps``: from label by to label; ``first``: of a sequence's first label."""

    weights: np.ndarray
    steps: np.ndarray
    first: np.ndarray


def emissions(field: Field, active: np.ndarray) -> np.ndarray:
    """Of each token, the score of each label by its own features."""
    out = np.zeros((len(active), field.weights.shape[1]), field.weights.dtype)
    for column in active.T:
        out += field.weights[column]
    return out


def _by_length(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences from the longest to the shortest: where they begin, how long they are, and how many reach each place."""
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    reach = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), "left")
    return bounds[:-1][order], lengths, reach


def viterbi(field: Field, scores: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The label of each token on its sequence's best path; all sequences go one token further at a time.

    ``bounds`` is where sequences begin, and the number of tokens. Of equally good paths the one with lower labels at
    the end is taken.
    """
    begins, lengths, reach = _by_length(bounds)
    came = np.zeros(scores.shape, np.int8)
    best = scores.copy()
    for place, n in enumerate(reach.tolist()):
        at = begins[:n] + place
        if not place:
            best[at] += field.first
            continue
        through = best[at - 1][:, :, None] + field.steps[None]
        came[at] = through.argmax(axis=1)
        best[at] += through.max(axis=1)
    labels = np.zeros(len(scores), np.int64)
    ends = begins + lengths - 1
    labels[ends] = best[ends].argmax(axis=1)
    for place in range(len(reach) - 1, 0, -1):
        at = begins[: reach[place]] + place
        labels[at - 1] = came[at, labels[at]]
    return labels


def _sum_exp(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.log(np.exp(values - top).sum(axis=axis)) + top.squeeze(axis)


def loss(field: Field, active: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> tuple[float, Field]:
    """The negative log-likelihood of the labels, and its gradient, by forward and backward sums."""
    scores = emissions(field, active)
    begins, lengths, reach = _by_length(bounds)
    ahead, behind = scores.copy(), np.zeros_like(scores)
    for place, n in enumerate(reach.tolist()):
        at = begins[:n] + place
        if not place:
            ahead[at] += field.first
        else:
            ahead[at] += _sum_exp(ahead[at - 1][:, :, None] + field.steps[None], 1)
    pairs = np.zeros_like(field.steps)
    whole = np.zeros(len(scores))
    whole[begins] = _sum_exp(ahead[begins + lengths - 1], 1)
    for place in range(len(reach)):
        whole[begins[: reach[place]] + place] = whole[begins[: reach[place]]]
    for place in range(len(reach) - 1, 0, -1):
        at = begins[: reach[place]] + place
        after = field.steps[None] + (scores[at] + behind[at])[:, None, :]
        pairs += np.exp(ahead[at - 1][:, :, None] + after - whole[at][:, None, None]).sum(axis=0)
        behind[at - 1] = _sum_exp(after, 2)
    shares = np.exp(ahead + behind - whole[:, None])
    told = np.zeros_like(shares)
    told[np.arange(len(labels)), labels] = 1
    follows = np.ones(len(labels), bool)
    follows[bounds[:-1]] = False
    at = np.flatnonzero(follows)
    np.add.at(pairs, (labels[at - 1], labels[at]), -1)
    right = scores[np.arange(len(labels)), labels].sum() + field.first[labels[begins]].sum()
    right += field.steps[labels[at - 1], labels[at]].sum()
    over = shares - told
    gradient = np.stack(
        [
            np.bincount(active.ravel(), np.repeat(column, active.shape[1]), len(field.weights))
            for column in over.T
        ],
        axis=1,
    )
    return float(whole[begins].sum() - right), Field(gradient, pairs, over[begins].sum(axis=0))


def train(
    active: np.ndarray, bounds: np.ndarray, labels: np.ndarray, features: int, kinds: int, rounds: int = 120, prior: float = 0.02
) -> Field:
    """A field fitted by gradient steps with momentum (Adam) and a Gaussian prior; the same for the same input."""
    field = Field(np.zeros((features, kinds)), np.zeros((kinds, kinds)), np.zeros(kinds))
    slow = [np.zeros_like(x) for x in field]
    spread = [np.zeros_like(x) for x in field]
    for number in range(1, rounds + 1):
        _, gradient = loss(field, active, bounds, labels)
        pace = 0.15 * (1 - (number - 1) / rounds)
        for x, g, m, v in zip(field, gradient, slow, spread, strict=True):
            g = g + prior * x
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= pace * (m / (1 - 0.9**number)) / (np.sqrt(v / (1 - 0.99**number)) + 1e-6)
    return field

"""Minimising smooth functions, with an absolute penalty on some coordinates (OWL-QN)."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable

import numpy as np

Objective = Callable[[np.ndarray], tuple[float, np.ndarray]]

#: Past steps whose curvature is remembered, and halvings of a step.
MEMORY, HALVINGS = 4, 20


def minimise(
    objective: Objective, x: np.ndarray, penalty: np.ndarray, rounds: int, enough: float = 1e-5
) -> np.ndarray:
    """A point near ``x`` where ``objective + sum(penalty * |x|)`` is small.

    ``objective`` gives value and gradient. Coordinates without penalty move freely; others never change their sign within a
    round, so that they can rest at 0 exactly. Steps follow the curvature of the last few (L-BFGS). A round that gains a smaller
    share than ``enough`` is the last.
    """
    held = penalty > 0
    value, slope = objective(x)
    value += float(penalty @ np.abs(x))
    past: deque = deque(maxlen=MEMORY)
    for _ in range(rounds):
        down = _steepest(x, slope, penalty)
        way = _bent(down, past)
        way[held & (way * down <= 0)] = 0
        gain = float(way @ down)
        if gain <= 0:
            way, gain = down, float(down @ down)
            past.clear()
        if gain == 0:
            break
        side = np.where(x != 0, np.sign(x), np.sign(down))
        length = 1.0
        for _ in range(HALVINGS):
            to = x + length * way
            to[held & (np.sign(to) != side)] = 0
            there, turned = objective(to)
            there += float(penalty @ np.abs(to))
            if there <= value - 1e-4 * float(down @ (to - x)):
                break
            length /= 2
        else:
            break
        step, bend = to - x, turned - slope
        curve = float(step @ bend)
        if curve > 1e-10 * np.sqrt(float(step @ step) * float(bend @ bend)):
            past.append((step, bend, 1 / curve))
        done = value - there < enough * abs(value)
        x, value, slope = to, there, turned
        if done:
            break
    return x


def _steepest(x: np.ndarray, slope: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """The way down, of a coordinate at 0 only if its slope is more than the penalty."""
    at_rest = -np.sign(slope) * np.maximum(np.abs(slope) - penalty, 0)
    return np.where(x != 0, -slope - np.sign(x) * penalty, at_rest)


def _bent(way: np.ndarray, past: deque) -> np.ndarray:
    """A way down, bent by the curvature of past steps."""
    way, shares = way.copy(), []
    for step, bend, scale in reversed(past):
        share = scale * (step @ way)
        shares.append(share)
        way -= share * bend
    if past:
        step, bend, _ = past[-1]
        way *= (step @ bend) / (bend @ bend)
    else:
        way /= max(1.0, np.sqrt(way @ way))
    for (step, bend, scale), share in zip(past, reversed(shares), strict=True):
        way += step * (share - scale * (bend @ way))
    return way

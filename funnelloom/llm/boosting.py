"""Gradient-boosted trees on small integer features, and their sum as a Spark expression.

Fitting is for bounded training tables (rows of a documented number); the fitted trees
are a nested CASE expression, so that scoring stays among Spark's own functions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Split:
    """Left where ``feature`` is at most ``limit``. A leaf is a float in a split's place."""

    feature: int
    limit: int
    left: Split | float
    right: Split | float


@dataclass(frozen=True)
class Boosted:
    """Log-odds: a constant and a sum of trees."""

    start: float
    trees: tuple[Split | float, ...]

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum(_leaves(t, x) for t in self.trees)

    def column(self, features: Column) -> Column:
        """The same sum over an array column of features."""

        def of(node: Split | float) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            return F.when(F.get(features, F.lit(node.feature)) <= node.limit, of(node.left)).otherwise(of(node.right))

        return reduce(add, map(of, self.trees), F.lit(self.start))


def _leaves(node: Split | float, x: np.ndarray) -> np.ndarray:
    if isinstance(node, float):
        return np.full(len(x), node)
    return np.where(x[:, node.feature] <= node.limit, _leaves(node.left, x), _leaves(node.right, x))


def _grow(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, depth: int, rate: float, ridge: float) -> Split | float:
    g, h = grad[rows].sum(), hess[rows].sum()
    leaf = float(round(rate * g / (h + ridge), 6))
    if not depth:
        return leaf
    best = (1e-3, 0, 0)
    for feature in range(x.shape[1]):
        values = x[rows, feature]
        left_g, left_h = (np.cumsum(np.bincount(values, v[rows]))[:-1] for v in (grad, hess))
        if len(left_g):
            gain = left_g**2 / (left_h + ridge) + (g - left_g) ** 2 / (h - left_h + ridge) - g**2 / (h + ridge)
            at = int(gain.argmax())
            best = max(best, (float(gain[at]), -feature, at))
    gain, feature, limit = best[0], -best[1], best[2]
    low = x[rows, feature] <= limit
    if gain <= 1e-3 or low.all() or not low.any():
        return leaf
    sides = (_grow(x, grad, hess, rows[side], depth - 1, rate, ridge) for side in (low, ~low))
    return Split(feature, limit, *sides)


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 4, rate: float = 0.3, ridge: float = 1.0) -> Boosted:
    """Logistic loss, second-order leaves; the same rows give the same trees."""
    share = min(max(float(y.mean()), 1e-6), 1 - 1e-6)
    start = float(round(np.log(share / (1 - share)), 6))
    score, trees, rows = np.full(len(y), start), [], np.arange(len(y))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        tree = _grow(x, y - p, p * (1 - p), rows, depth, rate, ridge)
        trees.append(tree)
        score = score + _leaves(tree, x)
    return Boosted(start, tuple(trees))


def threshold(score: np.ndarray, y: np.ndarray, precision: float) -> float:
    """Lowest score from which the share of positives is at least ``precision``; infinite if there is none."""
    order = np.argsort(-score, kind="stable")
    hits = np.cumsum(y[order])
    ends = np.append(score[order][1:] != score[order][:-1], True)
    good = np.flatnonzero(ends & (hits >= precision * np.arange(1, len(y) + 1)))
    return float(score[order][good[-1]]) if len(good) and hits[good[-1]] else float("inf")

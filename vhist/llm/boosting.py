"""Boosted depth-two trees over binned features, fitted on aggregated cells.

A cell is one combination of the small binned features with its counts of
positive and negative candidates, so the fitted data is bounded by the number
of combinations, whatever the corpus.  The model becomes a SQL expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 20
RATE = 0.3
SMOOTH = 1.0


def _leaf(grad: float, hess: float) -> float:
    return -RATE * grad / (hess + SMOOTH)


def _best_split(rows, n_features: int):
    """(gain, feature, bin): left takes cells with feature <= bin."""
    total_g, total_h = sum(g for _, g, _ in rows), sum(h for _, _, h in rows)
    base, best = total_g**2 / (total_h + SMOOTH), (1e-6, None, None)
    for f in range(n_features):
        sums: dict[int, list[float]] = {}
        for x, g, h in rows:
            s = sums.setdefault(x[f], [0.0, 0.0])
            s[0] += g
            s[1] += h
        g = h = 0.0
        for b in sorted(sums)[:-1]:
            g += sums[b][0]
            h += sums[b][1]
            gain = g**2 / (h + SMOOTH) + (total_g - g) ** 2 / (total_h - h + SMOOTH) - base
            if gain > best[0]:
                best = (gain, f, b)
    return best


def _grow(rows, n_features: int, depth: int):
    _, f, b = _best_split(rows, n_features) if depth else (0, None, None)
    if f is None:
        return _leaf(sum(g for _, g, _ in rows), sum(h for _, _, h in rows))
    left, right = [r for r in rows if r[0][f] <= b], [r for r in rows if r[0][f] > b]
    return f, b, _grow(left, n_features, depth - 1), _grow(right, n_features, depth - 1)


def _value(tree, x) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


def fit(cells: Sequence[tuple[tuple[int, ...], int, int]], rounds: int = ROUNDS):
    """(intercept, trees) from (features, positives, negatives) cells."""
    pos, neg = sum(p for _, p, _ in cells), sum(n for _, _, n in cells)
    intercept = math.log((pos + 1) / (neg + 1))
    scores, trees = [intercept] * len(cells), []
    width = len(cells[0][0]) if cells else 0
    for _ in range(rounds if pos and neg else 0):
        rows = []
        for (x, p, n), s in zip(cells, scores):
            q = 1 / (1 + math.exp(-s))
            rows.append((x, (p + n) * q - p, (p + n) * q * (1 - q)))
        tree = _grow(rows, width, 2)
        trees.append(tree)
        scores = [s + _value(tree, x) for s, (x, _, _) in zip(scores, cells)]
    return intercept, trees


def predict(model, x) -> float:
    return model[0] + sum(_value(t, x) for t in model[1])


def threshold(model, cells, precision: float) -> float:
    """The smallest score from which on the calibration cells' share of
    positives is at least ``precision`` (infinite if there is none)."""
    scored = sorted(((predict(model, x), p, n) for x, p, n in cells), reverse=True)
    best, pos, neg = math.inf, 0, 0
    for i, (s, p, n) in enumerate(scored):
        pos, neg = pos + p, neg + n
        last_of_score = i + 1 == len(scored) or scored[i + 1][0] != s
        if last_of_score and pos and pos >= precision * (pos + neg):
            best = s
    return best


def expression(model, names: Sequence[str]) -> Column:
    """The score as a SQL expression over the feature columns."""

    def node(t):
        if not isinstance(t, tuple):
            return F.lit(float(t))
        return F.when(F.col(names[t[0]]) <= t[1], node(t[2])).otherwise(node(t[3]))

    score = F.lit(float(model[0]))
    for t in model[1]:
        score = score + node(t)
    return score

"""Histogram gradient-boosted trees for a 0/1 label, in numpy, scored from flat node arrays.

Features are cut into at most 64 bins by quantiles. Trees grow level by level from histograms of
first and second derivatives of the logistic loss. A feature may be held monotonic: a split on
it must order its two leaves that way, and both sides are then bounded by the middle value, so
the score of every tree, and of the sum, never moves against the constraint.

Training sees a bounded sample on the driver; scoring runs inside tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """All trees in shared arrays; ``feature`` is -1 at a leaf, which points to itself."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of leaf values of each row of features; all rows step down together."""
        rows = np.arange(len(x))
        total = np.full(len(x), self.base)
        for root in self.roots.tolist():
            node = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[node]
                goes = x[rows, np.maximum(f, 0)] <= self.threshold[node]
                node = np.where(f < 0, node, np.where(goes, self.left[node], self.right[node]))
            total += self.value[node]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        return 1 / (1 + np.exp(-self.margin(x)))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    """Upper ends of the bins of one feature."""
    values = np.unique(column)
    if len(values) > bins:
        values = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))
        return values
    return (values[:-1] + values[1:]) / 2


def train(
    x: np.ndarray, y: np.ndarray, monotone: dict[int, int] | None = None, trees: int = 60,
    depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0, least: float = 1.0,
) -> Forest:
    """Fit trees; ``monotone`` maps a feature to 1 (never falls) or -1 (never rises).

    Without rows, or with one kind of label only, the forest is that constant.
    """
    n, width = x.shape
    monotone = monotone or {}
    share = (y.sum() + 1) / (n + 2)
    base = float(np.log(share / (1 - share)))
    nodes: list[list] = []
    roots: list[int] = []
    cuts = [_cuts(x[:, f], bins) for f in range(width)] if n else []
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1) if n else None
    margin = np.full(n, base)
    for _ in range(trees if 0 < y.sum() < n else 0):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        roots.append(len(nodes))
        nodes.append([-1, 0.0, len(nodes), len(nodes), 0.0])
        where = np.full(n, roots[-1])
        bounds = {roots[-1]: (-np.inf, np.inf)}
        for level in range(depth + 1):
            fresh: dict[int, tuple[float, float]] = {}
            for node, (low, high) in bounds.items():
                mine = np.flatnonzero(where == node)
                value = lambda a, b: np.clip(a / (b + ridge), low, high)  # noqa: E731, B023
                gain_of = lambda a, b, v: 2 * a * v - (b + ridge) * v * v  # noqa: E731, B023
                gs, hs = g[mine].sum(), h[mine].sum()
                nodes[node][4] = rate * float(value(gs, hs))
                if level == depth or hs < 2 * least:
                    continue
                best = (1e-6, -1, 0, 0.0, 0.0)
                whole = gain_of(gs, hs, value(gs, hs))
                for f in range(width):
                    if not len(cuts[f]):
                        continue
                    at = binned[mine, f]
                    a = np.cumsum(np.bincount(at, g[mine], len(cuts[f]) + 1))[:-1]
                    b = np.cumsum(np.bincount(at, h[mine], len(cuts[f]) + 1))[:-1]
                    lv, rv = value(a, b), value(gs - a, hs - b)
                    gain = gain_of(a, b, lv) + gain_of(gs - a, hs - b, rv) - whole
                    wrong = (b < least) | (hs - b < least)
                    if f in monotone:
                        wrong |= (rv - lv) * monotone[f] < 0
                    gain[wrong] = -np.inf
                    i = int(np.argmax(gain))
                    if gain[i] > best[0]:
                        best = (float(gain[i]), f, i, float(lv[i]), float(rv[i]))
                _, f, i, lv, rv = best
                if f < 0:
                    continue
                kids = (len(nodes), len(nodes) + 1)
                nodes += [[-1, 0.0, k, k, 0.0] for k in kids]
                nodes[node][:4] = [f, float(cuts[f][i]), *kids]
                where[mine] = np.where(binned[mine, f] <= i, *kids)
                middle = (lv + rv) / 2
                sides = [(low, high), (low, high)]
                if monotone.get(f, 0) > 0:
                    sides = [(low, middle), (middle, high)]
                elif monotone.get(f, 0) < 0:
                    sides = [(middle, high), (low, middle)]
                fresh |= dict(zip(kids, sides))
            bounds = fresh
        margin += np.array([v[4] for v in nodes])[where]
    flat = list(zip(*nodes)) or [(), (), (), (), ()]
    return Forest(
        np.array(roots, np.int64), np.array(flat[0], np.int64), np.array(flat[1], float),
        np.array(flat[2], np.int64), np.array(flat[3], np.int64), np.array(flat[4], float), base, depth,
    )

"""Gradient-boosted trees in numpy: histograms, logistic loss, monotonic constraints, flat node arrays.

Trees are grown level by level to ``DEPTH`` on quantile bins of the features.
A feature with the direction -1 (or 1) may only lower (raise) the score: a
split on it whose sides come in the other order is not taken, and the middle
of the two sides' values bounds all values further down on either side, so the
whole sum of trees is monotonic in that feature.

The trees are kept as one set of node arrays; all rows go down all trees at
once, ``DEPTH`` steps of array look-ups.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TREES, DEPTH, RATE, BINS = 60, 3, 0.2, 32
#: Added to the second derivatives of a leaf, and what each side of a split has at least.
SMOOTH, LEAST = 1.0, 1.0


@dataclass
class Forest:
    """Node arrays: a leaf has itself as both children; ``roots`` is the first node of each tree."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of label 1 for each row of features."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            below = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(below, self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _edges(column: np.ndarray) -> np.ndarray:
    """Thresholds between bins: up to BINS - 1 quantiles that have rows on both sides."""
    found = np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1], method="lower"))
    return found[found < column.max()]


class _Grower:
    def __init__(self, x: np.ndarray, direction: np.ndarray):
        self.direction = direction
        self.edges = [_edges(c) for c in x.T]
        self.bins = np.stack([np.searchsorted(e, c, "left") for e, c in zip(self.edges, x.T)], axis=1)
        self.nodes: list[list] = []

    def _leaf(self, value: float) -> int:
        n = len(self.nodes)
        self.nodes.append([0, np.inf, n, n, RATE * value])
        return n

    def split(self, rows: np.ndarray, g: np.ndarray, h: np.ndarray, low: float, high: float):
        """(gain, feature, bin, left value, right value) of the best split that keeps the directions; None without a gain."""

        def value(gs, hs):
            return np.clip(-gs / (hs + SMOOTH), low, high)

        def gain(gs, hs, v):
            return -(gs * v + 0.5 * (hs + SMOOTH) * v * v)

        all_g, all_h = g[rows].sum(), h[rows].sum()
        best, own = None, gain(all_g, all_h, value(all_g, all_h))
        for f, edges in enumerate(self.edges):
            if not len(edges):
                continue
            b = self.bins[rows, f]
            gs = np.cumsum(np.bincount(b, g[rows], len(edges) + 1))[:-1]
            hs = np.cumsum(np.bincount(b, h[rows], len(edges) + 1))[:-1]
            vl, vr = value(gs, hs), value(all_g - gs, all_h - hs)
            gains = gain(gs, hs, vl) + gain(all_g - gs, all_h - hs, vr) - own
            gains[(hs < LEAST) | (all_h - hs < LEAST) | (self.direction[f] * (vr - vl) < 0)] = 0
            k = int(gains.argmax())
            if gains[k] > 1e-9 and (best is None or gains[k] > best[0]):
                best = (gains[k], f, k, vl[k], vr[k])
        return best

    def grow(self, rows: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int = DEPTH,
             low: float = -np.inf, high: float = np.inf) -> int:
        found = self.split(rows, g, h, low, high) if depth and len(rows) else None
        if found is None:
            return self._leaf(float(np.clip(-g[rows].sum() / (h[rows].sum() + SMOOTH), low, high)))
        _, f, k, vl, vr = found
        n = self._leaf(0.0)
        below = self.bins[rows, f] <= k
        middle = (vl + vr) / 2
        bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)),
                  -1: ((middle, high), (low, middle))}[int(self.direction[f])]
        left = self.grow(rows[below], g, h, depth - 1, *bounds[0])
        right = self.grow(rows[~below], g, h, depth - 1, *bounds[1])
        self.nodes[n] = [f, self.edges[f][k], left, right, 0.0]
        return n


def train(x: np.ndarray, y: np.ndarray, direction: np.ndarray, trees: int = TREES) -> Forest:
    """Trees fitted to rows of features ``x`` and labels 0 or 1; ``direction`` has -1, 0 or 1 for each feature."""
    grower = _Grower(x, direction)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    margin, roots, rows = np.full(len(y), base), [], np.arange(len(y))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        roots.append(grower.grow(rows, p - y, p * (1 - p)))
        forest = flatten(grower.nodes, roots[-1:], 0.0)
        margin += forest.margin(x)
    return flatten(grower.nodes, roots, base)


def flatten(nodes: list[list], roots: list[int], base: float) -> Forest:
    feature, threshold, left, right, value = map(np.array, zip(*nodes))
    return Forest(feature, threshold, left, right, value, np.array(roots), base)

"""A geometric near-neighbour access tree over a small set of integer points.

A node chooses some of its points as split points and hands each other point
to the nearest of them.  For every split point and every child it keeps the
range of distances from the split point to the points of the child.  A query
works out its distance to the split points one by one; by the triangle
inequality a child whose range lies farther from that distance than the best
point found cannot hold a nearer one, and its whole subtree is left out.

Squared distances are exact integers.  Ranges and query distances are rounded
outwards to whole numbers, and a child goes only if it must be strictly
farther, so that every point at the smallest distance is looked at and the
tie goes to the lowest index.  Many queries go down together as numpy rows,
each with its own set of subtrees that are still alive.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Split points of a node.
DEGREE = 4


def root_below(squares: np.ndarray) -> np.ndarray:
    """Largest integers whose squares are at most ``squares``."""
    r = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    r -= r * r > squares
    r += (r + 1) * (r + 1) <= squares
    return r


def root_above(squares: np.ndarray) -> np.ndarray:
    """Smallest integers whose squares are at least ``squares``."""
    r = root_below(squares)
    return r + (r * r < squares)


@dataclass
class Node:
    """Indexes of the split points, a child (or None) for each, and the ranges [split point, child]."""

    splits: list[int]
    children: list[Node | None] = field(default_factory=list)
    low: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.int64))
    high: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.int64))


def _squares(points: np.ndarray, one: np.ndarray) -> np.ndarray:
    step = points - one
    return (step * step).sum(axis=-1)


def _far_apart(points: np.ndarray, indexes: list[int], degree: int) -> list[int]:
    """Split points: the first index, then again and again the point farthest from those chosen."""
    chosen = [indexes[0]]
    gap = _squares(points[indexes], points[chosen[0]])
    while len(chosen) < degree and gap.max() > 0:
        chosen.append(indexes[int(gap.argmax())])
        gap = np.minimum(gap, _squares(points[indexes], points[chosen[-1]]))
    return chosen


def build(points: np.ndarray, indexes: list[int] | None = None, degree: int = DEGREE) -> Node | None:
    """The tree over the rows of ``points`` (int64); None without points."""
    indexes = list(range(len(points))) if indexes is None else indexes
    if not indexes:
        return None
    if len(indexes) <= degree:
        return Node(indexes, [None] * len(indexes))
    splits = _far_apart(points, indexes, degree)
    rest = [i for i in indexes if i not in set(splits)]
    to_split = np.stack([_squares(points[rest], points[s]) for s in splits])
    home = to_split.argmin(axis=0)
    groups = [[i for i, h in zip(rest, home) if h == k] for k in range(len(splits))]
    node = Node(splits, [build(points, g, degree) if len(splits) > 1 else Node(g, [None] * len(g)) for g in groups])
    node.low = np.full((len(splits), len(splits)), np.iinfo(np.int64).max)
    node.high = np.full((len(splits), len(splits)), -1)
    for i in range(len(splits)):
        for j, group in enumerate(groups):
            if group:
                own = to_split[i][home == j]
                node.low[i, j], node.high[i, j] = root_below(own.min()), root_above(own.max())
    return node


class Search:
    """Nearest points of many queries; ``looked`` counts the distances worked out."""

    def __init__(self, points: np.ndarray, degree: int = DEGREE):
        self.points, self.root, self.looked = points, build(points, degree=degree), 0

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest point of each query, ties to the lowest index."""
        n = len(queries)
        best = np.full(n, np.iinfo(np.int64).max)
        found = np.full(n, len(self.points))
        if self.root is not None and n:
            self._visit(self.root, queries, np.arange(n), best, found)
        return found, best

    def _visit(self, node: Node, queries: np.ndarray, rows: np.ndarray, best: np.ndarray, found: np.ndarray) -> None:
        alive = np.ones((len(node.splits), len(rows)), dtype=bool)
        for i, split in enumerate(node.splits):
            squares = _squares(queries[rows], self.points[split])
            self.looked += len(rows)
            old = best[rows]
            better = (squares < old) | ((squares == old) & (split < found[rows]))
            best[rows[better]], found[rows[better]] = squares[better], split
            if node.low.size:
                near, far, reach = root_below(squares), root_above(squares), root_above(best[rows])
                for j in range(len(node.splits)):
                    if node.children[j] is not None:
                        alive[j] &= (node.low[i, j] <= far + reach) & (node.high[i, j] >= near - reach)
        for child, lives in zip(node.children, alive):
            if child is not None and lives.any():
                self._visit(child, queries, rows[lives], best, found)

"""K-Means to its fixed point for several k at once, and exact silhouettes.

Centres start from a bounded sample by k-means++ (several tries, refined on the
sample, the cheapest kept); the sample is drawn and ordered by the points
alone, so that the start does not depend on how rows are spread.  Then every
pass over the packed points adds up, for all k that still move, the points of
each cluster, and the means become the next centres, until no centre moves.

The silhouette of the squared Euclidean distance has a closed form: the mean
squared distance of a point to a cluster follows from the cluster's size, sum
and sum of squares, so one more pass gives it exactly for every point.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import added_up, packed

#: Points that the start may see; tries per k and steps of each on them.
SAMPLE, TRIES, SAMPLE_STEPS = 20_000, 10, 50
MOST_ROUNDS = 500


@dataclass
class Clusters:
    """Centres with each cluster's size, sum and sum of squares; ``converged`` when the last pass moved no centre."""

    centres: np.ndarray
    sizes: np.ndarray
    sums: np.ndarray
    squares: np.ndarray
    cost: float
    rounds: int
    converged: bool

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802  (as fitted models of Spark's library name it)
        return list(self.centres)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)


def _moved(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, float]:
    d = _distances(x, centres)
    own = d.argmin(axis=1)
    sizes = np.bincount(own, minlength=len(centres))
    sums = np.zeros_like(centres)
    np.add.at(sums, own, x)
    return np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres), float(d.min(axis=1).sum())


def start_centres(sample: np.ndarray, k: int, seed: int, tries: int = TRIES) -> np.ndarray:
    """The cheapest of several k-means++ starts, each refined on the sample; fewer points than k repeat."""
    rng = np.random.default_rng([seed, k])
    best, least = sample[np.arange(k) % len(sample)], np.inf
    for _ in range(tries):
        centres = sample[rng.integers(len(sample))][None]
        while len(centres) < k:
            near = _distances(sample, centres).min(axis=1)
            pick = rng.choice(len(sample), p=near / near.sum()) if near.sum() > 0 else rng.integers(len(sample))
            centres = np.vstack([centres, sample[pick]])
        for _ in range(SAMPLE_STEPS):
            new, cost = _moved(sample, centres)
            if np.array_equal(new, centres):
                break
            centres = new
        if cost < least * (1 - 1e-12):
            best, least = centres, cost
    return best


def sampled(points: DataFrame, columns: Iterable[str], n: int, size: int = SAMPLE) -> np.ndarray:
    """At most about ``size`` distinct points of ``n``, drawn by their own hash, in order of their coordinates."""
    columns = list(columns)
    share = min(1.0, size / max(n, 1))
    draw = F.pmod(F.xxhash64(*columns), F.lit(1 << 30))
    rows = points.where(draw < int(share * (1 << 30)) + 1).select(*columns).distinct().collect()
    return np.array(sorted(tuple(r) for r in rows), dtype=np.float64).reshape(-1, len(columns))


def fit_all(points: DataFrame, columns: Iterable[str], ks: Iterable[int], seed: int, most_rounds: int = MOST_ROUNDS) -> dict[int, Clusters]:
    """A fixed point of Lloyd's steps for every k; all k share each pass."""
    columns = list(columns)
    d, ks = len(columns), sorted(set(ks))
    blocks = packed(points, F.array(*[F.col(c).cast("double") for c in columns]), F.lit(0.0), d)
    n = int(added_up(blocks, d, lambda x, y: np.array([float(len(y))]), 1)[0])
    if not n:
        blocks.unpersist()
        raise ValueError("no points to cluster")
    sample = sampled(points, columns, n)
    at = {k: start_centres(sample, k, seed) for k in ks}
    found: dict[int, Clusters] = {}
    for done in range(1, most_rounds + 1):
        open_ks = [k for k in ks if k not in found or not found[k].converged]
        if not open_ks:
            break
        centres = {k: at[k] for k in open_ks}
        totals = added_up(blocks, d, lambda x, y: _cell_sums(x, centres), sum(open_ks) * (d + 2) + len(open_ks))
        place = 0
        for k in open_ks:
            own = totals[place: place + k * (d + 2)].reshape(k, d + 2)
            cost = float(totals[place + k * (d + 2)])
            place += k * (d + 2) + 1
            sizes, sums = np.rint(own[:, 0]).astype(int), own[:, 1: d + 1]
            new = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], at[k])
            still = bool((np.abs(new - at[k]) <= 1e-11 * (1 + np.abs(at[k]))).all())
            found[k] = Clusters(at[k], sizes, sums, own[:, d + 1], cost, done, still)
            at[k] = at[k] if still else new
    blocks.unpersist()
    return found


def _cell_sums(x: np.ndarray, centres: dict[int, np.ndarray]) -> np.ndarray:
    """Per k: size, sum and sum of squares of each cluster, then the cost."""
    out, squares = [], (x * x).sum(axis=1)
    full = np.column_stack([np.ones(len(x)), x, squares])
    for k, c in centres.items():
        d = _distances(x, c)
        cells = np.zeros((k, full.shape[1]))
        np.add.at(cells, d.argmin(axis=1), full)
        out += [cells.reshape(-1), [d.min(axis=1).sum()]]
    return np.concatenate(out)


def silhouettes(points: DataFrame, columns: Iterable[str], fits: dict[int, Clusters]) -> dict[int, float]:
    """The mean silhouette of squared Euclidean distances for every k, exact, in one pass; alone in a cluster counts 0."""
    columns = list(columns)
    d = len(columns)
    blocks = packed(points, F.array(*[F.col(c).cast("double") for c in columns]), F.lit(0.0), d)

    def of_block(x, y):
        squares = (x * x).sum(axis=1)[:, None]
        out = []
        for c in fits.values():
            size = np.maximum(c.sizes, 1)
            mean = np.maximum(squares - 2 * x @ (c.sums / size[:, None]).T + c.squares / size, 0)
            mean[:, c.sizes == 0] = np.inf
            own = _distances(x, c.centres).argmin(axis=1)
            row = np.arange(len(x))
            inner = mean[row, own] * c.sizes[own] / np.maximum(c.sizes[own] - 1, 1)
            mean[row, own] = np.inf
            outer = mean.min(axis=1)
            most = np.maximum(inner, outer)
            s = np.where((c.sizes[own] > 1) & (most > 0) & np.isfinite(outer), (outer - inner) / np.where(most > 0, most, 1), 0)
            out.append(s.sum())
        return np.append(out, len(x))

    total = added_up(blocks, d, of_block, len(fits) + 1)
    blocks.unpersist()
    return {k: float(total[i] / total[-1]) for i, k in enumerate(fits)}


def squared_distances(columns: Iterable[str], centres: np.ndarray) -> Column:
    """The array of squared distances of a row to each centre."""
    return F.array(*[sum(((F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(columns, centre)), F.lit(0.0))
                     for centre in centres])


def nearest(columns: Iterable[str], centres: np.ndarray) -> Column:
    """The 0-based index of the nearest centre, the first among equals."""
    d = squared_distances(list(columns), centres)
    return (F.array_position(d, F.array_min(d)) - 1).cast("int")


def certificate(assigned: DataFrame, columns: Iterable[str], centres: np.ndarray, cluster: str = "cluster") -> DataFrame:
    """``n_points, n_nearer_elsewhere, centres_hold``: rows nearer to a centre other than their cluster's, and whether
    every centre is the mean of its rows; one aggregate over the assignment."""
    columns = list(columns)
    d = squared_distances(columns, centres)
    cells = assigned.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.get(d, F.col(cluster)) > F.array_min(d)).alias("off"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)])
    table = F.array(*[F.array(*[F.lit(float(v)) for v in centre]) for centre in centres])
    holds = F.lit(True)
    for i in range(len(columns)):
        want = F.get(F.get(table, F.col(cluster)), F.lit(i))
        holds = holds & (F.abs(F.col(f"m{i}") - want) <= 1e-9 * (1 + F.abs(want)))
    return cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_points"), F.coalesce(F.sum("off"), F.lit(0)).alias("n_nearer_elsewhere"),
                     F.coalesce(F.bool_and(holds), F.lit(True)).alias("centres_hold"))

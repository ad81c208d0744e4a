"""Linear models by Newton steps on one packed matrix, with optimality certificates.

The (features, label) rows are packed once into blocks of dense numbers, the
one matrix that all fits share.  A step is one aggregate over the blocks: each
task adds up the loss, its gradient and its curvature at the current
coefficients, and Spark adds up the tasks.  What reaches the driver is a square
of the vector width, whatever the number of rows; the small penalised quadratic
problem is solved there.  A penalty path starts each fit from the last one's
coefficients, so that it takes two to four passes where a first-order
optimiser takes dozens.

All fits are in standardised slots (unit sample variance; centred, which only
moves the free intercept).  A slot without variance keeps a coefficient of 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import added_up, packed

#: Largest part of the optimality conditions that may be left, and Newton steps of a fit.
TOLERANCE, MOST_STEPS = 1e-7, 100
#: Wider vectors make the curvature too large; they are left to first-order optimisers.
MOST_SLOTS = 1000


@dataclass
class Matrix:
    """Packed rows with what standardising needs; ``release`` when the fits are done."""

    blocks: DataFrame
    width: int
    n: int
    mean: np.ndarray
    sd: np.ndarray
    label_mean: float

    def release(self) -> None:
        self.blocks.unpersist()

    @property
    def live(self) -> np.ndarray:
        return self.sd > 0

    def raw(self, scaled: np.ndarray) -> tuple[np.ndarray, float]:
        """Coefficients on the original scale, and the intercept, of standardised ones (intercept last)."""
        w = np.zeros(self.width)
        w[self.live] = scaled[:-1][self.live] / self.sd[self.live]
        return w, float(scaled[-1] - w @ self.mean)

    def scaled(self, w: np.ndarray, intercept: float) -> np.ndarray:
        return np.append(w * self.sd, intercept + w @ self.mean)

    def sums(self, of_block, size: int) -> np.ndarray:
        return added_up(self.blocks, self.width, of_block, size)

    def standard(self, gradient: np.ndarray, curvature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A mean gradient and curvature in raw slots and intercept, in standardised ones."""
        t = np.zeros((self.width + 1, self.width + 1))
        inverse = np.where(self.live, 1 / np.where(self.live, self.sd, 1), 0)
        t[np.arange(self.width), np.arange(self.width)] = inverse
        t[-1, :-1], t[-1, -1] = -self.mean * inverse, 1
        return t.T @ gradient, t.T @ curvature @ t


def pack(rows: DataFrame, features: str, label: str, width: int) -> Matrix:
    """Blocks of the rows, persisted, and their moments."""

    blocks = packed(rows, vector_to_array(features), F.col(label), width)
    first = added_up(blocks, width, lambda x, y: np.concatenate([[len(y), y.sum()], x.sum(axis=0)]), width + 2)
    n = int(first[0])
    if not n:
        raise ValueError("no rows to fit")
    mean = first[2:] / n
    spread = added_up(blocks, width, lambda x, y: ((x - mean) ** 2).sum(axis=0), width)
    sd = np.sqrt(spread / max(n - 1, 1))
    sd[sd <= 1e-12 * np.maximum(np.abs(mean), 1)] = 0
    return Matrix(blocks, width, n, mean, sd, float(first[1] / n))


def log_loss(matrix: Matrix, scaled: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean logistic loss, its gradient and its curvature at standardised coefficients: one pass."""
    w, b = matrix.raw(scaled)
    d = matrix.width + 1

    def of_block(x, y):
        z = x @ w + b
        small = np.exp(-np.abs(z))
        p = np.where(z < 0, small, 1) / (1 + small)
        full = np.vstack([x.T, np.ones(len(y))])  # a row per slot, as the block has them
        return np.concatenate([[(np.maximum(z, 0) + np.log1p(small) - y * z).sum()], full @ (p - y),
                               ((full * (p * (1 - p))) @ full.T).reshape(-1)])

    total = matrix.sums(of_block, 1 + d + d * d) / matrix.n
    return (float(total[0]), *matrix.standard(total[1: d + 1], total[d + 1:].reshape(d, d)))


def residual(gradient: np.ndarray, scaled: np.ndarray, l1: float, live: np.ndarray) -> float:
    """How far the L1 optimality conditions are from holding, over all slots and the intercept.

    A non-zero coefficient needs a gradient of -l1 times its sign, a zero one
    a gradient of at most l1 in size, the intercept one of 0.
    """
    g, w = gradient[:-1][live], scaled[:-1][live]
    off = np.where(w != 0, np.abs(g + l1 * np.sign(w)), np.maximum(np.abs(g) - l1, 0))
    return float(max(off.max(initial=0), abs(gradient[-1])))


def _penalised_step(gradient: np.ndarray, curvature: np.ndarray, scaled: np.ndarray, l1: float, live: np.ndarray) -> np.ndarray:
    """Minimises the quadratic model plus the L1 penalty, by accelerated proximal gradient with restarts.

    Slots that are copies of each other get equal shares, as their order makes no difference here.
    """
    keep = np.append(live, True)
    g, h, start = gradient[keep], curvature[np.ix_(keep, keep)], scaled[keep]
    cost = np.full(len(g), l1)
    cost[-1] = 0
    speed = max(float(np.linalg.eigvalsh(h)[-1]), 1e-12)
    x, v, t = start.copy(), start.copy(), 1.0
    for _ in range(50_000):
        u = v - (g + h @ (v - start)) / speed
        new = np.sign(u) * np.maximum(np.abs(u) - cost / speed, 0)
        if (v - new) @ (new - x) > 0:
            t = 1.0
        later = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / later * (new - x)
        done = np.abs(new - x).max() <= 1e-13 * max(1.0, np.abs(new).max())
        x, t = new, later
        if done:
            break
    out = np.zeros(len(scaled))
    out[keep] = x
    return out


@dataclass
class Fit:
    """Standardised coefficients (intercept last), the objective, what is left of the conditions, and the passes taken.

    ``there`` is the mean loss, its gradient and its curvature at the coefficients.
    """

    scaled: np.ndarray
    objective: float
    residual: float
    passes: int
    there: tuple[float, np.ndarray, np.ndarray]

    @property
    def converged(self) -> bool:
        return self.residual <= TOLERANCE


def l1_logistic(matrix: Matrix, l1: float, start: Fit | None = None, most_steps: int = MOST_STEPS) -> Fit:
    """Mean logistic loss plus ``l1`` times the sum of the standardised coefficients' sizes.

    A start from another fit takes over what that fit's last pass found.
    """
    rate = min(max(matrix.label_mean, 1e-9), 1 - 1e-9)
    at = np.append(np.zeros(matrix.width), np.log(rate / (1 - rate))) if start is None else start.scaled.copy()

    def objective(loss, scaled):
        return loss + l1 * np.abs(scaled[:-1]).sum()

    there, passes = (log_loss(matrix, at), 1) if start is None else (start.there, 0)
    value = objective(there[0], at)
    for _ in range(most_steps):
        _, g, h = there
        left = residual(g, at, l1, matrix.live)
        if left <= TOLERANCE:
            break
        goal, size = _penalised_step(g, h, at, l1, matrix.live), 1.0
        while True:
            new = goal if size == 1 else at + size * (goal - at)
            new_there = log_loss(matrix, new)
            passes += 1
            if objective(new_there[0], new) <= value + 1e-12 * abs(value) or size < 1e-6:
                break
            size /= 2
        if np.array_equal(new, at):
            break
        at, value, there = new, objective(new_there[0], new), new_there
    return Fit(at, value, residual(there[1], at, l1, matrix.live), passes, there)


def l1_path(matrix: Matrix, penalties, most_steps: int = MOST_STEPS) -> list[Fit]:
    """A fit per penalty, in the order given (strong to weak is quickest), each from the last one's coefficients."""
    fits: list[Fit] = []
    for p in penalties:
        fits.append(l1_logistic(matrix, float(p), fits[-1] if fits else None, most_steps))
    return fits


def l1_residuals(matrix: Matrix, models: list[tuple[float, np.ndarray, float]]) -> list[float]:
    """The L1 optimality residual of each (penalty, raw coefficients, intercept), all in one pass.

    Takes coefficients from any optimiser: it certifies a fit, not a method.
    """
    w = np.column_stack([m[1] for m in models])
    b = np.array([m[2] for m in models])
    d = matrix.width + 1

    def of_block(x, y):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -500, 500))) - y[:, None]
        return np.concatenate([x.T @ p, p.sum(axis=0)[None]]).reshape(-1)

    g = matrix.sums(of_block, d * len(models)).reshape(d, len(models)) / matrix.n
    flat = np.zeros((d, d))
    return [residual(matrix.standard(g[:, k], flat)[0], matrix.scaled(w_k, b_k), p, matrix.live)
            for k, (p, w_k, b_k) in enumerate(models)]


def _smooth_hinge(matrix: Matrix, scaled: np.ndarray, soft: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean hinge loss with its corner rounded over a width of ``soft``, gradient and curvature: one pass."""
    w, b = matrix.raw(scaled)
    d = matrix.width + 1

    def of_block(x, y):
        side = np.where(y > 0, 1.0, -1.0)
        short = 1 - side * (x @ w + b)
        a = np.clip(short / soft, 0, 1)
        full = np.vstack([x.T, np.ones(len(y))])
        bent = full[:, (short > 0) & (short < soft)]
        return np.concatenate([[(a * short - soft * a * a / 2).sum()], -(full @ (a * side)),
                               (bent @ bent.T).reshape(-1) / soft])

    total = matrix.sums(of_block, 1 + d + d * d) / matrix.n
    return (float(total[0]), *matrix.standard(total[1: d + 1], total[d + 1:].reshape(d, d)))


def _hinge_values(matrix: Matrix, points: list[np.ndarray], soft: float) -> np.ndarray:
    """The mean rounded hinge loss at several standardised coefficients, in one pass."""
    raw = [matrix.raw(p) for p in points]
    w, b = np.column_stack([r[0] for r in raw]), np.array([r[1] for r in raw])

    def of_block(x, y):
        short = 1 - np.where(y > 0, 1.0, -1.0)[:, None] * (x @ w + b)
        a = np.clip(short / soft, 0, 1)
        return (a * short - soft * a * a / 2).sum(axis=0)

    return matrix.sums(of_block, len(points)) / matrix.n


#: Step sizes tried in one pass.
SIZES = 2.0 ** -np.arange(12)


def hinge_dual_bound(matrix: Matrix, l2: float, start: np.ndarray | None = None, softs=(1.0, 0.3, 0.1),
                     most_steps: int = 25, enough: float = 1e-4) -> tuple[float, int]:
    """A lower bound of the smallest mean hinge loss plus ``l2 / 2`` times the squared standardised coefficients.

    Newton steps on the rounded hinge, rounder first, lead to dual weights in
    [0, 1] per row; scaled so that both classes weigh the same, they are dual
    feasible whatever the steps have reached, and the dual's value bounds the
    problem from below.  A start from a fit of the same problem is best.  Two passes a step (curvature, then all step sizes at
    once) and one per bound; returns the best bound and the passes taken.
    """
    at = np.zeros(matrix.width + 1) if start is None else start.copy()
    ridge = np.append(np.where(matrix.live, l2, 0), 0)
    best, passes = 0.0, 0
    for soft in softs:
        for _ in range(most_steps):
            loss, g, h = _smooth_hinge(matrix, at, soft)
            full, value = g + ridge * at, loss + (ridge * at * at).sum() / 2
            step = -np.linalg.lstsq(h + np.diag(ridge + 1e-9), full, rcond=None)[0]
            passes += 1
            if -full @ step <= 2 * enough * value:  # the quadratic model promises no more than this
                break
            tried = [at + size * step for size in SIZES]
            values = _hinge_values(matrix, tried, soft) + np.array([(ridge * t * t).sum() / 2 for t in tried])
            passes += 1
            if values.min() >= value:
                break
            at = tried[int(values.argmin())]
        best = max(best, _dual_value(matrix, at, l2, soft))
        passes += 1
    return best, passes


def _dual_value(matrix: Matrix, scaled: np.ndarray, l2: float, soft: float) -> float:
    w, b = matrix.raw(scaled)
    d = matrix.width

    def of_block(x, y):
        side = np.where(y > 0, 1.0, -1.0)
        a = np.clip((1 - side * (x @ w + b)) / soft, 0, 1)
        up, down = a * (side > 0), a * (side < 0)
        return np.concatenate([[up.sum(), down.sum()], up @ x, down @ x])

    total = matrix.sums(of_block, 2 + 2 * d) / matrix.n
    up, down, x_up, x_down = total[0], total[1], total[2: 2 + d], total[2 + d:]
    both = min(up, down)
    if both <= 0:
        return 0.0
    pull = (both / up) * (x_up - up * matrix.mean) - (both / down) * (x_down - down * matrix.mean)
    pull = np.where(matrix.live, pull / np.where(matrix.live, matrix.sd, 1), 0)
    return float(2 * both - pull @ pull / (2 * l2))


def hinge_objective(matrix: Matrix, w: np.ndarray, intercept: float, l2: float) -> float:
    """Mean hinge loss plus ``l2 / 2`` times the squared standardised coefficients, in one pass."""

    def of_block(x, y):
        side = np.where(y > 0, 1.0, -1.0)
        return np.array([np.maximum(0, 1 - side * (x @ w + intercept)).sum()])

    return float(matrix.sums(of_block, 1)[0] / matrix.n + l2 / 2 * ((w * matrix.sd) ** 2).sum())

"""Non-negative positive-unlabelled learning (Kiryo et al. 2017) of a linear model over sets of
binary features, in numpy.

With class prior pi, positives P and unlabelled U, the risk is
``pi R_P(+1) + max(0, R_U(-1) - pi R_P(-1))``: what U costs as negatives, less the share of it that
its own positives cause, and never below zero. Where the second part is negative its gradient is
stepped against, as published."""

from __future__ import annotations

import numpy as np


class Sets:
    """Rows of feature numbers, end to end."""

    def __init__(self, rows: list[np.ndarray]):
        self.n = len(rows)
        self.flat = np.concatenate([np.asarray(r, np.int64) for r in rows]) if rows else np.empty(0, np.int64)
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])

    def margin(self, w: np.ndarray, b: float) -> np.ndarray:
        return np.bincount(self.row, w[self.flat], self.n) + b

    def gradient(self, each: np.ndarray, size: int) -> tuple[np.ndarray, float]:
        return np.bincount(self.flat, each[self.row], size), float(each.sum())


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], size: int, prior: float, steps: int = 200,
        rate: float = 0.1, sparsity: float = 0.0, ridge: float = 0.0, beta: float = 0.0,
        gamma: float = 1.0, rising: bool = False) -> tuple[np.ndarray, float]:
    """Weights and bias. ``sparsity`` is an L1 penalty; ``beta`` the tolerance below zero and ``gamma``
    the size of a step back, as published; ``rising`` keeps weights from going below zero: a feature may speak for the positive class or
    stay silent, so that a long text's many silent words cannot outvote one that speaks."""
    w, b = np.zeros(size), 0.0
    if not positive or not unlabelled or not 0 < prior < 1:
        return w, 60.0 if prior >= 1 else -60.0
    p, u = Sets(positive), Sets(unlabelled)
    b = float(np.log(prior / (1 - prior)))
    mean, square, mean_b, square_b = np.zeros(size), np.zeros(size), 0.0, 0.0
    for t in range(1, steps + 1):
        zp, zu = sigmoid(p.margin(w, b)), sigmoid(u.margin(w, b))
        negative = np.mean(-np.log(1 - zu + 1e-12)) - prior * np.mean(-np.log(1 - zp + 1e-12))
        gp, bp = p.gradient(zp / p.n, size)  # d R_P(-1)
        gu, bu = u.gradient(zu / u.n, size)  # d R_U(-1)
        if negative >= -beta:
            gt, bt = p.gradient((zp - 1) / p.n, size)  # d R_P(+1)
            g, gb = prior * gt + gu - prior * gp, prior * bt + bu - prior * bp
        else:
            g, gb = gamma * (prior * gp - gu), gamma * (prior * bp - bu)
        g = g + ridge * w + sparsity * (np.sign(w) + (w == 0) * rising)
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        mean_b, square_b = 0.9 * mean_b + 0.1 * gb, 0.999 * square_b + 0.001 * gb * gb
        fix, fix2 = 1 - 0.9 ** t, 1 - 0.999 ** t
        w = w - rate * (mean / fix) / (np.sqrt(square / fix2) + 1e-8)
        b = b - rate * (mean_b / fix) / (np.sqrt(square_b / fix2) + 1e-8)
        if rising:
            w = np.maximum(0, w)
    return w, float(b)

"""Multinomial logistic regression by follow-the-regularised-leader (proximal),
with L1 and L2 penalties, on sparse rows; temperature calibration."""

from __future__ import annotations

import numpy as np


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _weights(z, n, alpha, beta, l1, l2):
    w = -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)
    return np.where(np.abs(z) > l1, w, 0.0)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], dims: int, classes: int, epochs: int = 3,
        alpha: float = 1.0, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-4, seed: int = 1) -> np.ndarray:
    """Weights (dims, classes).  A row is (indices without repeats, values, class).
    Rows are visited in a seeded order; the result depends on nothing else."""
    z, n = np.zeros((dims, classes)), np.zeros((dims, classes))
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            idx, val, y = rows[k]
            zi, ni = z[idx], n[idx]
            w = _weights(zi, ni, alpha, beta, l1, l2)
            p = softmax(val @ w)
            p[y] -= 1.0
            g = val[:, None] * p
            grown = ni + g * g
            z[idx] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / alpha * w
            n[idx] = grown
    return _weights(z, n, alpha, beta, l1, l2)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least log loss (golden section over its logarithm)."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        z = logits / np.exp(t)
        z = z - z.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(y)), y]))

    lo, hi, r = -4.0, 4.0, (5 ** 0.5 - 1) / 2
    a, b = hi - r * (hi - lo), lo + r * (hi - lo)
    fa, fb = loss(a), loss(b)
    for _ in range(40):
        if fa <= fb:
            hi, b, fb = b, a, fa
            a = hi - r * (hi - lo)
            fa = loss(a)
        else:
            lo, a, fa = a, b, fb
            b = lo + r * (hi - lo)
            fb = loss(b)
    return float(np.exp((lo + hi) / 2))

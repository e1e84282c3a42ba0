"""Logistic regression for the bounded training samples of the classifiers."""

from __future__ import annotations

import numpy as np


def fit_logistic(row: np.ndarray, col: np.ndarray, value: np.ndarray, y: np.ndarray, width: int,
                 ridge: float = 3e-4, rounds: int = 400, step: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights and intercept for sparse rows ``(row, col, value)``, by Adam over the whole sample."""
    w = np.zeros(width + 1)
    base = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    w[-1] = np.log(base / (1 - base))
    m, v = np.zeros_like(w), np.zeros_like(w)
    n = len(y)
    for t in range(1, rounds + 1):
        z = np.bincount(row, value * w[col], n) + w[-1]
        d = (sigmoid(z) - y) / n
        g = np.concatenate([np.bincount(col, value * d[row], width), [d.sum()]])
        g[:-1] += ridge * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def fit_scaled(cols: list[np.ndarray], y: np.ndarray, scale: np.ndarray, ridge: float = 3e-4, rounds: int = 60,
               step: float = 0.1, chunk: int = 1 << 20) -> tuple[np.ndarray, float]:
    """Weight times scale of every feature, and intercept, for rows that have the features ``cols``.

    Works through ``chunk`` features at a time, so that only the features themselves are held.
    """
    width, n = len(scale), len(y)
    sizes = np.array([len(c) for c in cols], np.int64)
    cuts = [0]                                       # rows of each chunk
    for i, total in enumerate(np.cumsum(sizes)):
        if total - sizes[:cuts[-1]].sum() > chunk and i > cuts[-1]:
            cuts.append(i)
    cuts.append(n)
    parts = [(slice(a, b), np.concatenate(cols[a:b]).astype(np.int32), sizes[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]
    w, m, v = (np.zeros(width + 1) for _ in range(3))
    base = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    w[-1] = np.log(base / (1 - base))
    for t in range(1, rounds + 1):
        own, g = w[:-1] * scale, np.zeros(width + 1)
        for rows, col, size in parts:
            row = np.repeat(np.arange(len(size)), size)
            d = (sigmoid(np.bincount(row, own[col], len(size)) + w[-1]) - y[rows]) / n
            g[:-1] += np.bincount(col, d[row], width)
            g[-1] += d.sum()
        g[:-1] = g[:-1] * scale + ridge * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1] * scale, float(w[-1])


def calibration(s: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope (kept above 0.05) and offset that make ``sigmoid(slope * s + offset)`` fit the labels of rows not fitted on."""
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    at = np.array([1.0, 0.0])
    x = np.stack([s, np.ones(len(s))])
    for _ in range(rounds):
        p = sigmoid(at @ x)
        grad, curve = x @ (weight * (p - t)), (x * (weight * p * (1 - p) + 1e-9)) @ x.T + 1e-6 * np.eye(2)
        at = at - np.clip(np.linalg.solve(curve, grad), -1, 1)
    return max(0.05, float(at[0])), float(at[1])


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))

"""Small dense and sparse logistic models, fitted on bounded samples."""

from __future__ import annotations

import numpy as np


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_dense(x: np.ndarray, y: np.ndarray, steps: int = 80, l2: float = 1e-5, rate: float = 0.5) -> np.ndarray:
    """Logistic regressions of the columns of ``y`` (0/1) on ``x``, by Adam on
    full batches from zero; the last row of the result is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w = np.zeros((x.shape[1], y.shape[1]), np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = x.T @ (sigmoid(x @ w) - y).astype(x.dtype) / len(x) + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return w


class Sparse:
    """Rows of feature indices (all values 1) plus a few dense columns."""

    def __init__(self, rows: list[np.ndarray], width: int, dense: np.ndarray | None = None):
        self.n, self.width = len(rows), width
        self.of = np.repeat(np.arange(self.n), [len(r) for r in rows])
        self.idx = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        self.dense = np.zeros((self.n, 0)) if dense is None else dense

    def take(self, keep: np.ndarray) -> "Sparse":
        on = keep[self.of]
        out = Sparse([], self.width, self.dense[keep])
        out.n, out.of, out.idx = int(keep.sum()), (np.cumsum(keep) - 1)[self.of[on]], self.idx[on]
        return out

    def dot(self, w, v, b):
        return np.bincount(self.of, w[self.idx], self.n) + self.dense @ v + b

    def fit(self, y: np.ndarray, steps: int = 60, l2: float = 2e-4, rate: float = 0.15):
        """Logistic regression with balanced classes: ``(w, v, b)``."""
        pos = max(y.mean(), 1e-9)
        weight = np.where(y > 0, 0.5 / pos, 0.5 / max(1 - pos, 1e-9)) / max(self.n, 1)
        p = np.zeros(self.width + self.dense.shape[1] + 1)
        m, s = np.zeros_like(p), np.zeros_like(p)
        cut = self.width, self.width + self.dense.shape[1]
        for t in range(1, steps + 1):
            err = (sigmoid(self.dot(p[:cut[0]], p[cut[0]:cut[1]], p[-1])) - y) * weight
            g = np.concatenate([np.bincount(self.idx, err[self.of], self.width), self.dense.T @ err, [err.sum()]])
            g[:cut[0]] += l2 * p[:cut[0]]
            m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
            p -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.999 ** t)) + 1e-8)
        return p[:cut[0]], p[cut[0]:cut[1]], p[-1]

"""Small logistic models that are fitted on the driver from bounded samples, and applied in batches."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weight + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, l2: float | np.ndarray = 1.0, weight: np.ndarray | None = None, steps: int = 60) -> Logistic:
    """Ridge logistic regression by Newton steps on standardized columns; a ridge for all or for each. One class only: a constant model."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    k = x.shape[1]
    w = np.ones(len(y)) if weight is None else weight
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1)
        return Logistic(np.zeros(k), np.ones(k), np.zeros(k), float(np.log(rate / (1 - rate))))
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.hstack([np.clip((x - mean) / scale, -8, 8), np.ones((len(y), 1))])
    ridge = np.append(np.broadcast_to(np.asarray(l2, float), (k,)), 1e-6)
    b = np.zeros(k + 1)

    def loss(b: np.ndarray) -> float:
        m = z @ b
        return float((w * (np.logaddexp(0, m) - y * m)).sum() + (ridge * b * b).sum() / 2)

    now = loss(b)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -40, 40)))
        grad = z.T @ (w * (p - y)) + ridge * b
        hess = (z * (w * p * (1 - p))[:, None]).T @ z + np.diag(ridge + 1e-9)
        step = np.linalg.solve(hess, grad)
        size = 1.0
        while size > 1e-6 and loss(b - size * step) > now:
            size /= 2
        if size <= 1e-6:
            break
        b = b - size * step
        before, now = now, loss(b)
        if before - now < 1e-9 * max(1.0, abs(now)):
            break
    return Logistic(mean, scale, b[:-1], float(b[-1]))

"""Small linear models, fitted on the driver over bounded samples."""

from __future__ import annotations

import numpy as np


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 1.0, rounds: int = 200) -> np.ndarray:
    """Weights (bias last) of an L2-regularised squared-hinge SVM; y is -1 or 1.

    Accelerated gradient descent with a fixed step below 1 / L; deterministic.
    Classes weigh alike whatever their sizes.
    """
    def forward(v: np.ndarray) -> np.ndarray:  # products in the type of x: no copy of the sample
        return (x @ v[:-1].astype(x.dtype)).astype(np.float64) + v[-1]

    def back(u: np.ndarray) -> np.ndarray:
        return np.r_[(u.astype(x.dtype) @ x).astype(np.float64), u.sum()]

    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum()))
    penalty = 1.0 / (c * max(1, len(x)))
    # largest eigenvalue of a' diag(share) a by power iteration, a being x and a column of ones
    v = np.ones(x.shape[1] + 1)
    for _ in range(20):
        v = back(share * forward(v))
        v /= np.linalg.norm(v) or 1.0
    step = 1.0 / (2.2 * float(v @ back(share * forward(v))) + penalty)
    w = np.zeros(x.shape[1] + 1)
    z, t = w.copy(), 1.0
    for _ in range(rounds):
        slack = np.maximum(0.0, 1.0 - y * forward(z))
        grad = -2.0 * back(share * y * slack) + penalty * z
        after = z - step * grad
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = after + (t - 1) / t2 * (after - w)
        w, t = after, t2
    return w


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = 30) -> np.ndarray:
    """Weights (bias last) of an L2-regularised logistic regression by Newton steps; y is 0 or 1."""
    a = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    w = np.zeros(a.shape[1])
    ridge = np.full(len(w), penalty * len(x))
    ridge[-1] = 1e-9 + penalty
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge)
        d = np.linalg.solve(h, a.T @ (p - y) + ridge * w)
        w -= d
        if np.abs(d).max() < 1e-6:
            break
    return w


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

"""Small learners for the driver: Adam and probability calibration."""

from __future__ import annotations

import numpy as np


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.99 * self.v[k] + 0.01 * g * g
            self.params[k] -= self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.99**self.t)) + 1e-8)


def platt(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """a and b so that sigmoid(a * raw + b) is calibrated; a isn't negative.

    Newton's method on smoothed targets, with a weak prior that keeps separable
    or one-sided data finite.
    """
    if not len(y):
        return 1.0, 0.0
    pos, n = float(y.sum()), len(y)
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (n - pos + 2))
    mean, scale = float(raw.mean()), float(raw.std()) or 1.0
    x = np.stack([(raw - mean) / scale, np.ones(n)], 1)
    w = np.array([1.0, np.log((pos + 1) / (n - pos + 1))])
    for _ in range(50):
        p = sigmoid(x @ w)
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag([1e-2, 1e-6]), x.T @ (p - target) + np.array([1e-2, 1e-6]) * w)
        w -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    a = max(float(w[0]), 0.0) / scale
    return a, float(w[1]) - a * mean

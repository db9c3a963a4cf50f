"""A small two-layer network in NumPy: training with Adam and temperature calibration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class TwoLayer:
    """``score = sigmoid((tanh(((x - mean) / scale) W1 + b1) W2 + b2) / temperature)``."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.temperature)


def constant_model(width: int, p: float) -> TwoLayer:
    """A model that gives every row the probability ``p``."""
    p = min(max(p, 1e-6), 1 - 1e-6)
    zero = np.zeros((width, 1))
    return TwoLayer(np.zeros(width), np.ones(width), zero, np.zeros(1), np.zeros(1), float(np.log(p / (1 - p))))


def fit_two_layer(
    x: np.ndarray,
    y: np.ndarray,
    weight: np.ndarray,
    hidden: int = 32,
    epochs: int = 60,
    batch: int = 128,
    rate: float = 0.01,
    decay: float = 1e-4,
    seed: int = 7,
) -> TwoLayer:
    """Weighted cross entropy with Adam on four fifths of the rows; the temperature minimises
    the weighted loss on the other fifth."""
    if len(y) == 0 or y.min() == y.max():
        return constant_model(x.shape[1] if x.ndim == 2 else 1, float(y.mean()) if len(y) else 0.5)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    cut = max(1, len(y) // 5)
    held, train = order[:cut], order[cut:]
    mean = x[train].mean(0)
    scale = x[train].std(0) + 1e-6
    z = np.clip((x - mean) / scale, -8, 8)
    p = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    step = 0
    for _ in range(epochs):
        train = rng.permutation(train)
        for at in range(0, len(train), batch):
            rows = train[at : at + batch]
            a = np.tanh(z[rows] @ p[0] + p[1])
            err = (sigmoid(a @ p[2] + p[3]) - y[rows]) * weight[rows] / len(rows)
            back = np.outer(err, p[2]) * (1 - a * a)
            grads = [z[rows].T @ back + decay * p[0], back.sum(0), a.T @ err + decay * p[2], np.array([err.sum()])]
            step += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    model = TwoLayer(mean, scale, p[0], p[1], p[2], float(p[3][0]))
    logits, best = model.logits(x[held]), (np.inf, 1.0)
    for t in np.geomspace(0.25, 8, 41):
        q = np.clip(sigmoid(logits / t), 1e-9, 1 - 1e-9)
        loss = -(weight[held] * (y[held] * np.log(q) + (1 - y[held]) * np.log(1 - q))).sum()
        best = min(best, (loss, float(t)))
    model.temperature = best[1]
    return model

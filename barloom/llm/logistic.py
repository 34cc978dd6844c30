"""Logistic regression on a bounded table of numbers, for models fitted on a sample."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35.0, 35.0)))


@dataclass
class Logistic:
    """Weights on standardised inputs; the last weight is the intercept."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def constant(cls, share: float, inputs: int) -> "Logistic":
        weights = np.zeros(inputs + 1)
        weights[-1] = np.log(share / (1.0 - share))
        return cls(np.zeros(inputs), np.ones(inputs), weights)

    def predict(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        return sigmoid((x - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> Logistic:
    """Newton steps on the ridge-penalised log loss; the intercept carries no penalty."""
    mean, scale = x.mean(0), x.std(0)
    scale[scale == 0] = 1.0
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    penalty = np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = sigmoid(z @ w)
        gradient = z.T @ (p - y) + penalty * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return Logistic(mean, scale, w)

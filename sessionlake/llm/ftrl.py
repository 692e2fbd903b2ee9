"""Sparse multinomial logistic regression, trained by follow-the-regularised-leader with elastic-net penalties."""

from __future__ import annotations

import numpy as np


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Weights are a function of two sums for each feature and class; most are exactly zero under the L1 penalty."""

    def __init__(self, features: int, classes: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5):
        self.z, self.n = np.zeros((features, classes)), np.zeros((features, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, rows=slice(None)) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, rows: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(rows)
        error = softmax(values @ w)
        error[label] -= 1
        g = values[:, None] * error
        before = self.n[rows]
        self.n[rows] = after = before + g * g
        self.z[rows] += g - (np.sqrt(after) - np.sqrt(before)) / self.alpha * w


def trained(examples: list[tuple[np.ndarray, np.ndarray, int]], features: int, classes: int, epochs: int = 3, seed: int = 1, **penalties) -> np.ndarray:
    """Weights (features, classes) after some passes over (rows, values, label) in shuffled order."""
    model, order = Ftrl(features, classes, **penalties), np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(examples)):
            model.learn(*examples[i])
    return model.weights()


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """What to divide logits by so that the labels are likeliest; 1 where there are none."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.02), np.log(20), 120))
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])

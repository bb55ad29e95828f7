"""Logistic regression on bounded samples, for the classifiers of this folder."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    """Logistic function without overflow."""
    return np.where(x >= 0, 1 / (1 + np.exp(-np.abs(x))), np.exp(-np.abs(x)) / (1 + np.exp(-np.abs(x))))


def fit_logistic(
    x: np.ndarray, y: np.ndarray, ridge: float, weight: np.ndarray | None = None, same: np.ndarray | None = None, tie: float = 0.0
) -> np.ndarray:
    """Weights (the last one is the constant) by Newton steps with a ridge penalty.

    ``same`` holds rows of differences between an example and its counterfactual;
    ``tie`` times the squared change of the linear score over them is added to
    the loss. With one class only, the constant says so and nothing else.
    """
    n, p = x.shape
    w = np.ones(n) if weight is None else weight
    beta = np.zeros(p + 1)
    if n == 0 or y.min() == y.max():
        beta[-1] = 0.0 if n == 0 else (4.0 if y[0] else -4.0)
        return beta
    x1 = np.concatenate([x, np.ones((n, 1))], axis=1)
    penalty = np.full(p + 1, ridge)
    penalty[-1] = 1e-6
    fixed = np.diag(penalty)
    if same is not None and len(same):
        s1 = np.concatenate([same, np.zeros((len(same), 1))], axis=1)
        fixed = fixed + 2 * tie * s1.T @ s1
    loss_of = lambda b: float(
        (w * np.logaddexp(0, np.where(y > 0, -1, 1) * (x1 @ b))).sum() + 0.5 * b @ fixed @ b
    )
    loss = loss_of(beta)
    for _ in range(100):
        prob = sigmoid(x1 @ beta)
        gradient = x1.T @ (w * (prob - y)) + fixed @ beta
        hessian = (x1 * (w * np.maximum(prob * (1 - prob), 1e-9))[:, None]).T @ x1 + fixed
        step = np.linalg.solve(hessian, gradient)
        size = 1.0
        while (new := loss_of(beta - size * step)) > loss and size > 1e-6:
            size /= 2
        beta = beta - size * step
        if loss - new < 1e-8 * (1 + abs(loss)):
            break
        loss = new
    return beta

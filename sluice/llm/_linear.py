"""Linear models on sparse rows, trained on the driver from bounded samples."""

from __future__ import annotations

import numpy as np

LEAST_STEPS = 600  # a small sample is gone over more often


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def scores(bounds: np.ndarray, index: np.ndarray, value: np.ndarray, w: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """rows x classes: the weighted sums of sparse rows."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    return np.stack([np.bincount(row, weights=value * w[index, c], minlength=len(bounds) - 1) + bias[c] for c in range(w.shape[1])], axis=1)


def ftrl(
    bounds: np.ndarray, index: np.ndarray, value: np.ndarray, target: np.ndarray, size: int,
    alpha: float = 0.5, beta: float = 1.0, l1: float = 0.0, l2: float = 0.0, epochs: int = 6, batch: int = 64, seed: int = 1,
) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression by follow-the-regularised-leader (proximal) with an elastic-net penalty.

    target: rows x classes, rows sum to 1 (soft labels).  Returns weights (size x classes) and bias.  l1 and l2 are per row seen.
    """
    classes, n = target.shape[1], len(bounds) - 1
    z, g2 = np.zeros((size + 1, classes)), np.zeros((size + 1, classes))  # the last is the bias, without penalty
    w = np.zeros((size + 1, classes))
    rng = np.random.default_rng(seed)
    seen = 0
    for _ in range(max(epochs, -(-LEAST_STEPS * batch // max(1, n)))):
        for part in np.array_split(rng.permutation(n), max(1, n // batch)):
            if not len(part):
                continue
            length = bounds[part + 1] - bounds[part]
            at = np.repeat(bounds[part] - np.concatenate(([0], np.cumsum(length)[:-1])), length) + np.arange(length.sum())
            row, f, v = np.repeat(np.arange(len(part)), length), index[at], value[at]
            out = np.stack([np.bincount(row, weights=v * w[f, c], minlength=len(part)) for c in range(classes)], axis=1) + w[size]
            error = (softmax(out) - target[part]) / len(part)
            g = np.stack([np.bincount(f, weights=v * error[row, c], minlength=size + 1) for c in range(classes)], axis=1)
            g[size] = error.sum(axis=0)
            sigma = (np.sqrt(g2 + g * g) - np.sqrt(g2)) / alpha
            z += g - sigma * w
            g2 += g * g
            seen += 1
            small = l1 * np.sqrt(seen)
            w = np.where(np.abs(z) <= small, 0, -(z - np.sign(z) * small) / ((beta + np.sqrt(g2)) / alpha + l2 * seen))
            w[size] = -z[size] / ((beta + np.sqrt(g2[size])) / alpha)
    return w[:size], w[size]


def temperature(z: np.ndarray, label: np.ndarray) -> float:
    """The temperature that makes softmax(z / t) likeliest on held-out rows; golden-section search on its logarithm."""
    if not len(z):
        return 1.0
    loss = lambda lt: -np.log(softmax(z / np.exp(lt))[np.arange(len(z)), label] + 1e-12).mean()
    a, b, r = -4.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))

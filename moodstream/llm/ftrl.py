"""Follow-the-regularised-leader (proximal) for sparse linear models.

Every coordinate has its own rate, ``alpha / (beta + sqrt(sum of squared
gradients))``, and its weight is 0 while its accumulated gradient stays within
``l1``; ``l2`` shrinks the others. Weights are made when they are needed, from
the two running sums per coordinate.
"""

from __future__ import annotations

import numpy as np


class Ftrl:
    """``shape``: features, or features x classes."""

    def __init__(self, shape, alpha: float, beta: float, l1: float, l2: float):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(shape), np.zeros(shape)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        rate = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / rate)

    def update(self, at, weights: np.ndarray, gradient: np.ndarray) -> None:
        """``at`` holds each feature once; ``weights`` as used for the gradient."""
        n = self.n[at]
        more = n + gradient * gradient
        self.z[at] += gradient - (np.sqrt(more) - np.sqrt(n)) / self.alpha * weights
        self.n[at] = more

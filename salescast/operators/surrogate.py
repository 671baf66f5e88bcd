"""Which points of the unit cube to try next: expected improvement under a Gaussian process (Matern 5/2).

The values seen are few, one per fitted model; what makes them runs on Spark.
"""

from __future__ import annotations

import math

import numpy as np

#: Length scale of the process, which the few values seen could not tell, and the noise of the values.
SCALE = 0.8
NOISE = 1e-6


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    r = np.sqrt(5 * ((a[:, None] - b[None]) ** 2).sum(2)) / SCALE
    return (1 + r + r * r / 3) * np.exp(-r)


def next_points(x: np.ndarray, y: np.ndarray, n: int, pool: np.ndarray) -> list[int]:
    """Places in ``pool`` of the ``n`` points that promise most below the least of ``y``.

    They are tried at the same time, so each counts at its expected value when the next one is chosen.
    """
    chosen: list[int] = []
    for _ in range(n):
        middle, spread = y.mean(), y.std() or 1.0
        z = (y - middle) / spread
        low = np.linalg.cholesky(kernel(x, x) + NOISE * np.eye(len(x)))
        near = kernel(pool, x)
        mean = near @ np.linalg.solve(low.T, np.linalg.solve(low, z))
        sd = np.sqrt(np.maximum(1 - (np.linalg.solve(low, near.T) ** 2).sum(0), 1e-12))
        below = (z.min() - mean) / sd
        share = np.array([0.5 * math.erfc(-b / math.sqrt(2)) for b in below])
        gain = sd * (below * share + np.exp(-0.5 * below * below) / math.sqrt(2 * math.pi))
        gain[chosen] = -1
        chosen.append(int(gain.argmax()))
        x, y = np.vstack([x, pool[chosen[-1]]]), np.append(y, mean[chosen[-1]] * spread + middle)
    return chosen

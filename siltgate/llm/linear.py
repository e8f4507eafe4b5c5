"""Small logistic models in numpy, over sparse 0/1 features or dense columns."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from siltgate.llm.common import sigmoid


@dataclass(frozen=True)
class Sparse:
    """Rows of 0/1 features: row ``i`` has ``columns[starts[i]:starts[i + 1]]``."""

    starts: np.ndarray
    columns: np.ndarray
    width: int

    @classmethod
    def sorted(cls, row_of: np.ndarray, columns: np.ndarray, n: int, width: int) -> Sparse:
        """From pairs of row and column in row order."""
        starts = np.concatenate(([0], np.cumsum(np.bincount(row_of, minlength=n))))
        return cls(starts.astype(np.int64), columns, width)

    def take(self, mask: np.ndarray) -> Sparse:
        keep = mask[self.row_of]
        rows = (np.cumsum(mask) - 1)[self.row_of[keep]]
        return Sparse.sorted(rows, self.columns[keep], int(mask.sum()), self.width)

    @property
    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(
            self.row_of, weights=weights[self.columns], minlength=len(self.starts) - 1
        )


def fit_logistic(
    x: Sparse,
    dense: np.ndarray,
    y: np.ndarray,
    l2: float = 1.0,
    steps: int = 200,
) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights of the sparse and the dense features and the intercept.

    Accelerated gradient descent on the mean loss plus ``l2 / (2 n)`` times the squared
    weights; starts from zero, so equal data give equal weights.
    """
    n = max(1, len(y))
    row_of = x.row_of
    w, v, b = np.zeros(x.width), np.zeros(dense.shape[1]), 0.0
    # Adam: rare features take steps as long as frequent ones.
    m = [np.zeros_like(w), np.zeros_like(v), 0.0]
    s = [np.zeros_like(w), np.zeros_like(v), 0.0]
    for step in range(1, steps + 1):
        z = np.bincount(row_of, weights=w[x.columns], minlength=len(y)) + dense @ v + b
        r = (sigmoid(z) - y) / n
        grads = (
            np.bincount(x.columns, weights=r[row_of], minlength=x.width) + l2 * w / n,
            dense.T @ r + l2 * v / n,
            float(r.sum()),
        )
        rate = 0.1 * min(1.0, 3 * (1 - step / (steps + 1)))
        for k, g in enumerate(grads):
            m[k] = 0.9 * m[k] + 0.1 * g
            s[k] = 0.99 * s[k] + 0.01 * g * g
        move = [
            rate * (mk / (1 - 0.9**step)) / (np.sqrt(sk / (1 - 0.99**step)) + 1e-8)
            for mk, sk in zip(m, s, strict=True)
        ]
        w, v, b = w - move[0], v - move[1], b - float(move[2])
    return w, v, b


def chi_square(present: np.ndarray, positive: np.ndarray, n: int, n_positive: int) -> np.ndarray:
    """2x2 chi-square of each feature against a label."""
    a = positive.astype(float)
    b = present - a
    c = n_positive - a
    d = n - n_positive - b
    low = np.maximum((a + b) * (c + d) * (a + c) * (b + d), 1e-9)
    return n * (a * d - b * c) ** 2 / low

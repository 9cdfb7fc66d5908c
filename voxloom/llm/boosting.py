"""Gradient-boosted regression trees for a 0/1 label, on histograms; for training samples that fit the driver."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete trees: inner nodes 0 to 2^depth - 2 by feature and threshold, then the leaves' values."""

    depth: int
    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.base)
        lines = np.arange(len(rows))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(rows), dtype=np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (rows[lines, feature[at]] > threshold[at])
            out += leaf[at - (len(threshold))]
        return out


def boost(
    rows: np.ndarray, labels: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.25, bins: int = 32, ridge: float = 1.0,
    weights: np.ndarray | None = None,
) -> Trees:
    """Newton boosting of the logistic loss. Equal input gives equal trees."""
    n, m = rows.shape
    weights = np.ones(n) if weights is None else weights
    cuts = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.column_stack([np.searchsorted(c, rows[:, j], side="left") for j, c in enumerate(cuts)])
    share = float((weights * labels).sum() + 1) / float(weights.sum() + 2)
    base = float(np.log(share / (1 - share)))
    score = np.full(n, base)
    inner, width = 2**depth - 1, bins + 1
    flat = binned + np.arange(m) * width
    out = Trees(depth, base, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf, np.float32), np.zeros((trees, inner + 1)))
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        gradient, hessian = weights * (labels - p), weights * np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first = 2**level - 1
            for node in range(first, 2 * first + 1):
                mine = np.flatnonzero(at == node)
                # rows of a node that is not split go to its left child
                at[mine] = 2 * node + 1
                if len(mine) < 4:
                    continue
                keys = flat[mine].ravel()
                g = np.bincount(keys, np.repeat(gradient[mine], m), m * width).reshape(m, width).cumsum(axis=1)
                h = np.bincount(keys, np.repeat(hessian[mine], m), m * width).reshape(m, width).cumsum(axis=1)
                whole_g, whole_h = g[0, -1], h[0, -1]
                gain = g**2 / (h + ridge) + (whole_g - g) ** 2 / (whole_h - h + ridge) - whole_g**2 / (whole_h + ridge)
                gain[(h < 0.5) | (whole_h - h < 0.5)] = 0
                j, cut = divmod(int(gain.argmax()), width)
                if gain[j, cut] <= 1e-3 or cut >= len(cuts[j]):
                    continue
                out.feature[t, node], out.threshold[t, node] = j, cuts[j][cut]
                at[mine] += binned[mine, j] > cut
        leaves = at - inner
        g, h = np.bincount(leaves, gradient, inner + 1), np.bincount(leaves, hessian, inner + 1)
        out.leaf[t] = rate * g / (h + ridge)
        score += out.leaf[t][leaves]
    return out

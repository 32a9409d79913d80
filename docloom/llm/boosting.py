"""Gradient-boosted trees for two classes, on a few dozen numeric features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    feature: np.ndarray  # (trees, inner nodes) of complete binary trees
    cut: np.ndarray
    leaf: np.ndarray  # (trees, leaves)
    base: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows, depth = np.arange(len(x)), self.leaf.shape[1].bit_length() - 1
        for f, c, leaf in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > c[at])
            out += leaf[at - (2**depth - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.25, bins: int = 32, ridge: float = 2.0) -> Trees:
    """Second-order boosting on the logistic loss with histograms of quantile bins."""
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    code = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
    base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    margin = np.full(n, base)
    features, thresholds, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        at = np.zeros(n, np.int64)
        feature, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        for node in range(2**depth - 1):
            rows = np.flatnonzero(at == node)
            best = (1e-6, 0, np.inf)
            if len(rows) > 1:
                gs, hs = g[rows].sum(), h[rows].sum()
                for j in range(m):
                    if not len(cuts[j]):
                        continue
                    gl = np.cumsum(np.bincount(code[rows, j], g[rows], len(cuts[j]) + 1))[:-1]
                    hl = np.cumsum(np.bincount(code[rows, j], h[rows], len(cuts[j]) + 1))[:-1]
                    gain = gl**2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs**2 / (hs + ridge)
                    k = int(np.argmax(gain))
                    if gain[k] > best[0]:
                        best = (gain[k], j, cuts[j][k])
            feature[node], cut[node] = best[1], best[2]
            at[rows] = 2 * node + 1 + (x[rows, best[1]] > best[2])
        leaf = at - (2**depth - 1)
        value = rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + ridge)
        margin += value[leaf]
        features.append(feature)
        thresholds.append(cut)
        leaves.append(value)
    return Trees(np.array(features), np.array(thresholds), np.array(leaves), base)

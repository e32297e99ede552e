"""Histogram gradient-boosted trees for two classes, in numpy.

Features are cut into bins at quantiles of the training rows. Trees grow level by level from sums of
gradients per bin and are kept as flat arrays, a complete binary tree per row: the children of node i
are 2i+1 and 2i+2. All rows walk all trees at once, one level a step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves
    base: float
    depth: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of x."""
        at = np.zeros((len(x), len(self.feature)), np.int64)
        tree = np.arange(len(self.feature))
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = 2 * at + 1 + (x[row, self.feature[tree, at]] > self.threshold[tree, at])
        inner = (1 << self.depth) - 1
        return 1 / (1 + np.exp(-(self.base + self.leaf[tree, at - inner].sum(axis=1))))


def fit_forest(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 1.0
) -> Forest:
    """Fit label 0 or 1. Without rows, or with one class only, every score is the smoothed share of label 1."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    inner, leaves = (1 << depth) - 1, 1 << depth
    if len(np.unique(y)) < 2:
        return Forest(np.zeros((1, inner), np.int64), np.zeros((1, inner)), np.zeros((1, leaves)), base, depth)
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    # Bin b holds cuts[b-1] < value <= cuts[b]; a split after bin b asks for value > cuts[b].
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], "left") for f in range(width)], axis=1)
    cell = binned + np.arange(width) * bins
    margin = np.full(n, base)
    kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = y - p, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            count = 1 << level
            local = node - (count - 1)
            flat = (local[:, None] * (width * bins) + cell).ravel()
            size = count * width * bins
            g = np.bincount(flat, np.repeat(gradient, width), size).reshape(count, width, bins).cumsum(axis=2)
            h = np.bincount(flat, np.repeat(weight, width), size).reshape(count, width, bins).cumsum(axis=2)
            whole_g, whole_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + l2) + (whole_g - g) ** 2 / (whole_h - h + l2) - whole_g**2 / (whole_h + l2)
            gain[(h < 1) | (whole_h - h < 1)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            for k in np.flatnonzero(gain.reshape(count, -1).max(axis=1) > 1e-6):
                f, b = divmod(int(best[k]), bins)
                if b < len(cuts[f]):
                    feature[count - 1 + k], threshold[count - 1 + k] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf = node - inner
        values = rate * np.bincount(leaf, gradient, leaves) / (np.bincount(leaf, weight, leaves) + l2)
        margin += values[leaf]
        kept.append((feature, threshold, values))
    return Forest(*(np.stack(part) for part in zip(*kept, strict=True)), base, depth)

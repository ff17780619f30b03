"""Gradient-boosted trees for two classes, fitted on a bounded sample of rows.

Values are binned by quantiles; each tree is grown level by level from
histograms of gradients, and scores are sums of leaf values (log-odds).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Forest:
    """Fitted trees: per tree the feature and bin of each inner node (a full binary tree in
    breadth-first order) and the value of each leaf."""

    edges: list[np.ndarray]
    depth: int
    base: float = 0.0
    features: list[np.ndarray] = field(default_factory=list)
    bins: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    def binned(self, values: np.ndarray) -> np.ndarray:
        """Bin number of each value; a row per feature."""
        out = np.empty(values.shape[::-1], np.uint8)
        for f, edges in enumerate(self.edges):
            out[f] = np.searchsorted(edges, values[:, f])
        return out

    def _leaf(self, binned: np.ndarray, tree: int) -> np.ndarray:
        each = np.arange(binned.shape[1])
        at = np.zeros(binned.shape[1], np.int64)
        for _ in range(self.depth):
            at = 2 * at + 1 + (binned[self.features[tree][at], each] > self.bins[tree][at])
        return at - len(self.features[tree])

    def scores(self, values: np.ndarray) -> np.ndarray:
        """Log-odds of each row (0 for all, if nothing was fitted)."""
        out = np.full(len(values), self.base)
        if self.leaves and len(values):
            binned = self.binned(values)
            for t, leaf in enumerate(self.leaves):
                out += leaf[self._leaf(binned, t)]
        return out


def fit(values: np.ndarray, labels: np.ndarray, trees: int = 40, depth: int = 4,
        rate: float = 0.25, bins: int = 48, ridge: float = 2.0, least: float = 1.0) -> Forest:
    """Trees for ``labels`` (0 or 1) over the columns of ``values``; none without both classes."""
    edges = []
    for column in values.T:
        cuts = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) \
            if len(column) else np.empty(0)
        edges.append(cuts)
    forest = Forest(edges, depth)
    if len(labels) == 0 or labels.min() == labels.max():
        return forest
    binned = forest.binned(values)
    n, width = len(labels), len(edges)
    varied = [f for f in range(width) if len(edges[f])]
    share = labels.mean()
    forest.base = float(np.log(share / (1 - share)))
    score = np.full(n, forest.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        slope, curve = labels - p, p * (1 - p)
        feature = np.zeros((1 << depth) - 1, np.int64)
        cut = np.full((1 << depth) - 1, 255, np.int64)  # all rows to the left
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, many = (1 << level) - 1, 1 << level
            gains = np.full((width, many, bins), -np.inf)
            for f in varied:
                at = (node - first) * bins + binned[f]
                g = np.bincount(at, slope, many * bins).reshape(many, bins).cumsum(axis=1)
                h = np.bincount(at, curve, many * bins).reshape(many, bins).cumsum(axis=1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                fits = (h >= least) & (h_all - h >= least)
                gain = g**2 / (h + ridge) + (g_all - g)**2 / (h_all - h + ridge) \
                    - g_all**2 / (h_all + ridge)
                gains[f] = np.where(fits, gain, -np.inf)
            flat = gains.transpose(1, 0, 2).reshape(many, -1)
            best = flat.argmax(axis=1)
            good = flat[np.arange(many), best] > 1e-6
            feature[first:first + many] = np.where(good, best // bins, 0)
            cut[first:first + many] = np.where(good, best % bins, 255)
            node = 2 * node + 1 + (binned[feature[node], np.arange(n)] > cut[node])
        leaf = node - len(feature)
        g = np.bincount(leaf, slope, 1 << depth)
        h = np.bincount(leaf, curve, 1 << depth)
        forest.features.append(feature)
        forest.bins.append(cut)
        forest.leaves.append(rate * g / (h + ridge))
        score += forest.leaves[-1][leaf]
    return forest

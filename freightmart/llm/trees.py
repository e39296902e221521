"""Histogram gradient-boosted trees in numpy, fitted on a bounded sample, kept as flat arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Boosted:
    """Complete binary trees of one depth: node i of a tree has the children 2i + 1 and 2i + 2.

    ``feature`` and ``cut`` are (trees, inner nodes), ``leaf`` is (trees, leaves). A node that was not
    split sends everything left, by an infinite cut.
    """

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        """All rows go down all trees together, one level at a time."""
        trees, inner = self.feature.shape
        at = np.zeros((len(x), trees), np.int64)
        rows, own = np.arange(len(x))[:, None], np.arange(trees)[None, :]
        for _ in range(int(np.log2(inner + 1))):
            at = 2 * at + 1 + (x[rows, self.feature[own, at]] > self.cut[own, at])
        return self.base + self.leaf[own, at - inner].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        parts = [self.margin(x[i:i + 4096]) for i in range(0, len(x), 4096)]
        return sigmoid(np.concatenate(parts)) if parts else np.zeros(0)


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
        smooth: float = 2.0, least: float = 3.0) -> Boosted:
    """Logistic loss; ``y`` may be any share from 0 to 1. Without rows the score is 0.5 everywhere.

    ``smooth`` is the L2 term of a leaf, ``least`` the smallest sum of second derivatives of a leaf.
    """
    inner, leaves = 2**depth - 1, 2**depth
    if not len(x):
        return Boosted(0.0, np.zeros((1, inner), np.int64), np.full((1, inner), np.inf), np.zeros((1, leaves)))
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    table = np.full((width, bins), np.inf)
    for j, c in enumerate(cuts):
        table[j, :len(c)] = c
    features, chosen, values = [], [], []
    margin = np.full(n, base)
    for _ in range(trees):
        p = sigmoid(margin)
        slope, bend = y - p, p * (1 - p)
        at = np.zeros(n, np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            key = ((at - first)[:, None] * width + np.arange(width)) * bins + binned
            g = np.bincount(key.ravel(), np.repeat(slope, width), nodes * width * bins).reshape(nodes, width, bins).cumsum(axis=2)
            h = np.bincount(key.ravel(), np.repeat(bend, width), nodes * width * bins).reshape(nodes, width, bins).cumsum(axis=2)
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + smooth) + (g_all - g)**2 / (h_all - h + smooth) - g_all**2 / (h_all + smooth)
            gain[(h < least) | (h_all - h < least) | ~np.isfinite(table)[None]] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            split = gain.reshape(nodes, -1)[np.arange(nodes), best] > 1e-6
            j, b = best // bins, best % bins
            feature[first:first + nodes] = j
            cut[first:first + nodes] = np.where(split, table[j, b], np.inf)
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > cut[at])
        leaf = at - inner
        g, h = np.bincount(leaf, slope, leaves), np.bincount(leaf, bend, leaves)
        value = rate * g / (h + smooth)
        margin += value[leaf]
        features.append(feature), chosen.append(cut), values.append(value)
    return Boosted(base, np.array(features), np.array(chosen), np.array(values))

"""Gradient-boosted regression trees and isotonic calibration for dense features, on arrays.

They are fitted on a bounded sample and are small: a model is some thousand numbers.
"""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Trees of fixed depth on binned features under the logistic loss."""

    def __init__(self, rounds: int = 80, depth: int = 3, rate: float = 0.2, bins: int = 64, least_weight: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.least_weight = rounds, depth, rate, bins, least_weight
        self.base, self.trees = 0.0, []

    def fit(self, features: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> BoostedTrees:
        self.edges = [np.unique(np.quantile(column, np.linspace(0, 1, self.bins)[1:-1])) for column in features.T]
        binned = self._bin(features)
        mean = np.clip(np.average(labels, weights=weights), 1e-6, 1 - 1e-6)
        self.base = float(np.log(mean / (1 - mean)))
        margin = np.full(len(labels), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            tree, leaves = self._grow(binned, weights * (labels - p), weights * np.maximum(p * (1 - p), 1e-6))
            self.trees.append(tree)
            margin += tree[2][leaves]
        return self

    def _bin(self, features):
        return np.stack([np.searchsorted(e, c, side="right") for e, c in zip(self.edges, features.T, strict=True)], axis=1)

    def _grow(self, binned, gradient, curvature):
        """One tree as arrays: feature and bin of each inner node (heap order), value of each leaf."""
        inner = (1 << self.depth) - 1
        feature, limit = np.zeros(inner, dtype=np.int64), np.full(inner, self.bins, dtype=np.int64)
        node = np.zeros(len(binned), dtype=np.int64)
        for level in range(self.depth):
            first = (1 << level) - 1
            width = 1 << level
            best = np.full(width, 1e-9)
            for f in range(binned.shape[1]):
                place = (node - first) * (self.bins + 1) + binned[:, f]
                size = width * (self.bins + 1)
                g = np.bincount(place, gradient, size).reshape(width, -1).cumsum(axis=1)
                h = np.bincount(place, curvature, size).reshape(width, -1).cumsum(axis=1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + 1) + (all_g - g) ** 2 / (all_h - h + 1) - all_g**2 / (all_h + 1)
                gain[(h < self.least_weight) | (all_h - h < self.least_weight)] = 0
                at = gain.argmax(axis=1)
                top = gain[np.arange(width), at]
                better = top > best
                best[better] = top[better]
                feature[first : first + width][better] = f
                limit[first : first + width][better] = at[better]
            node = 2 * node + 1 + (binned[np.arange(len(node)), feature[node]] > limit[node])
        leaves = node - inner
        size = 1 << self.depth
        value = self.rate * np.bincount(leaves, gradient, size) / (np.bincount(leaves, curvature, size) + 1)
        return (feature, limit, value), leaves

    def margins(self, features: np.ndarray) -> np.ndarray:
        binned = self._bin(features) if len(features) else np.zeros((0, len(self.edges)), dtype=np.int64)
        margin = np.full(len(features), self.base)
        rows = np.arange(len(features))
        for feature, limit, value in self.trees:
            node = np.zeros(len(features), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (binned[rows, feature[node]] > limit[node])
            margin += value[node - len(feature)]
        return margin


class Isotonic:
    """The non-decreasing map of margins to probabilities nearest to the labels (pool adjacent violators)."""

    def fit(self, margins: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> Isotonic:
        order = np.argsort(margins, kind="stable")
        blocks: list[list[float]] = []  # weight, weighted label, weighted margin
        for m, y, w in zip(margins[order], labels[order], weights[order], strict=True):
            blocks.append([w, w * y, w * m])
            while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
                last = blocks.pop()
                blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
        self.at = np.array([b[2] / b[0] for b in blocks])
        self.value = np.array([b[1] / b[0] for b in blocks])
        return self

    def probabilities(self, margins: np.ndarray) -> np.ndarray:
        """Between two blocks' mean margins the map is linear; a small slope keeps the order of equals."""
        slope = 1 / (1 + np.exp(-margins))
        return np.clip(0.999 * np.interp(margins, self.at, self.value) + 0.001 * slope, 0.0, 1.0)

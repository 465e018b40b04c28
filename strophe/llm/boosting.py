"""Gradient-boosted trees for yes/no decisions, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class BoostedTrees:
    """Logistic loss, trees of fixed depth over binned features. NaN is a bin of its own, below all values."""

    rounds: int = 30
    depth: int = 3
    rate: float = 0.3
    bins: int = 32
    smooth: float = 1.0
    edges: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    base: float = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(x.shape, dtype=np.int64)
        for j, edges in enumerate(self.edges):
            known = ~np.isnan(x[:, j])
            out[known, j] = 1 + np.searchsorted(edges, x[known, j], side="right")
        return out

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        """x: rows by features; y: 0 or 1. With no rows every decision is no."""
        self.trees = []
        if not len(y):
            self.edges, self.base = [np.zeros(0)] * x.shape[1], -4.0
            return self
        self.edges = []
        for j in range(x.shape[1]):
            known = x[~np.isnan(x[:, j]), j]
            self.edges.append(np.unique(np.quantile(known, np.linspace(0, 1, self.bins)[1:-1])) if len(known) else np.zeros(0))
        binned, width = self._binned(x), self.bins + 1
        rate = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.base = float(np.log(rate / (1 - rate)))
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            slope, bend = y - p, p * (1 - p)
            node = np.zeros(len(y), dtype=np.int64)
            feature = np.zeros(2**self.depth - 1, dtype=np.int64)
            cut = np.full(2**self.depth - 1, width, dtype=np.int64)
            for level in range(self.depth):
                first, count = 2**level - 1, 2**level
                best = np.full(count, 1e-9)
                for j in range(x.shape[1]):
                    place = (node - first) * width + binned[:, j]
                    g = np.bincount(place, slope, count * width).reshape(count, width)
                    h = np.bincount(place, bend, count * width).reshape(count, width)
                    gl, hl = g.cumsum(1), h.cumsum(1)
                    gt, ht = gl[:, -1:], hl[:, -1:]
                    gain = gl**2 / (hl + self.smooth) + (gt - gl) ** 2 / (ht - hl + self.smooth) - gt**2 / (ht + self.smooth)
                    at = gain.argmax(1)
                    top = gain[np.arange(count), at]
                    better = top > best
                    best = np.where(better, top, best)
                    feature[first : first + count] = np.where(better, j, feature[first : first + count])
                    cut[first : first + count] = np.where(better, at, cut[first : first + count])
                right = binned[np.arange(len(y)), feature[node]] > cut[node]
                node = 2 * node + 1 + right
            leaf = node - (2**self.depth - 1)
            g = np.bincount(leaf, slope, 2**self.depth)
            h = np.bincount(leaf, bend, 2**self.depth)
            value = self.rate * g / (h + self.smooth)
            self.trees.append((feature, cut, value))
            score += value[leaf]
        return self

    def decide(self, x: np.ndarray) -> np.ndarray:
        """Scores; above 0 is yes."""
        score = np.full(len(x), self.base)
        if self.trees and len(x):
            binned, rows = self._binned(x), np.arange(len(x))
            for feature, cut, value in self.trees:
                node = np.zeros(len(x), dtype=np.int64)
                for _ in range(self.depth):
                    node = 2 * node + 1 + (binned[rows, feature[node]] > cut[node])
                score += value[node - (2**self.depth - 1)]
        return score

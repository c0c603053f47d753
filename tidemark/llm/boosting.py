"""Gradient-boosted trees for two classes, over binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Trees:
    """Complete trees of one depth: at each inner node a feature and the last bin that goes left; a value per leaf."""

    edges: list[np.ndarray]
    features: np.ndarray
    bins: np.ndarray
    leaves: np.ndarray
    start: float

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of class 1 for every row."""
        binned, out, every = self.binned(x), np.full(len(x), self.start), np.arange(len(x))
        depth = int(np.log2(self.leaves.shape[1]))
        for feature, last, leaf in zip(self.features, self.bins, self.leaves, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (binned[every, feature[at]] > last[at])
            out += leaf[at - (len(leaf) - 1)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.2, ridge: float = 2.0) -> Trees:
    """Boost ``rounds`` trees on the logistic loss; splits have the largest gain over all features and bins."""
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS)[1:-1])) for k in range(x.shape[1])]
    start = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    inner, n_features = (1 << depth) - 1, x.shape[1]
    model = Trees(edges, np.zeros((rounds, inner), np.int64), np.full((rounds, inner), BINS, np.int64), np.zeros((rounds, inner + 1)), start)
    binned, odds = model.binned(x), np.full(len(y), start)
    for k in range(rounds):
        p = 1 / (1 + np.exp(-odds))
        slope, bend = y - p, np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            best = np.full(width, 1e-6)
            for f in range(n_features):
                cell = (at - first) * BINS + binned[:, f]
                g = np.bincount(cell, slope, width * BINS).reshape(width, BINS).cumsum(1)
                h = np.bincount(cell, bend, width * BINS).reshape(width, BINS).cumsum(1)
                total_g, total_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + ridge) + (total_g - g) ** 2 / (total_h - h + ridge) - total_g**2 / (total_h + ridge)
                gain[(h < 1) | (total_h - h < 1)] = 0
                cut = gain.argmax(1)
                found = gain[np.arange(width), cut]
                better = found > best
                best[better] = found[better]
                model.features[k, first : first + width][better] = f
                model.bins[k, first : first + width][better] = cut[better]
            at = 2 * at + 1 + (binned[np.arange(len(y)), model.features[k, at]] > model.bins[k, at])
        leaf = at - inner
        g, h = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, bend, inner + 1)
        model.leaves[k] = rate * g / (h + ridge)
        odds += model.leaves[k, leaf]
    return model

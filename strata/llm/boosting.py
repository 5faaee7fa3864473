"""Gradient-boosted trees over binned features, for samples that fit in memory."""

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth: a feature and a threshold per inner node, a value per
    leaf. Rows with a feature above the threshold go right."""

    features: np.ndarray
    thresholds: np.ndarray
    leaves: np.ndarray
    start: float

    def logits(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.start)
        every = np.arange(len(rows))
        inner = self.features.shape[1]
        for feature, threshold, leaf in zip(self.features, self.thresholds, self.leaves):
            node = np.zeros(len(rows), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (rows[every, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return total


def fit_trees(
    rows: np.ndarray,
    target: np.ndarray,
    weight: np.ndarray,
    rounds: int = 60,
    depth: int = 4,
    rate: float = 0.2,
    smooth: float = 2.0,
) -> Trees:
    """Fit the logistic loss for targets between 0 and 1, level by level."""
    cuts = np.quantile(rows, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    bins = np.stack([np.searchsorted(c, rows[:, i], side="left") for i, c in enumerate(cuts)], 1)
    n, many = rows.shape
    mean = np.clip(np.average(target, weights=weight), 1e-3, 1 - 1e-3)
    start = float(np.log(mean / (1 - mean)))
    total = np.full(n, start)
    flat = bins + np.arange(many) * BINS
    trees = []
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-total))
        slope = (target - chance) * weight
        curve = chance * (1 - chance) * weight
        node = np.zeros(n, np.int64)
        features, thresholds = [], []
        for level in range(depth):
            size = 1 << level
            place = ((node - (size - 1))[:, None] * (many * BINS) + flat).ravel()
            shape = (size, many, BINS)
            count = size * many * BINS
            g = np.bincount(place, np.repeat(slope, many), count).reshape(shape).cumsum(2)
            h = np.bincount(place, np.repeat(curve, many), count).reshape(shape).cumsum(2)
            whole_g, whole_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + smooth) + (whole_g - g) ** 2 / (whole_h - h + smooth)
            gain[:, :, -1] = -np.inf
            best = gain.reshape(size, -1).argmax(1)
            feature, cut = best // BINS, best % BINS
            features.append(feature)
            thresholds.append(cuts[feature, np.minimum(cut, BINS - 2)])
            own = node - (size - 1)
            node = 2 * node + 1 + (bins[np.arange(n), feature[own]] > cut[own])
        leaf = node - ((1 << depth) - 1)
        g = np.bincount(leaf, slope, 1 << depth)
        h = np.bincount(leaf, curve, 1 << depth)
        values = rate * g / (h + smooth)
        total += values[leaf]
        trees.append((np.concatenate(features), np.concatenate(thresholds), values))
    return Trees(
        np.array([t[0] for t in trees]),
        np.array([t[1] for t in trees]),
        np.array([t[2] for t in trees]),
        start,
    )

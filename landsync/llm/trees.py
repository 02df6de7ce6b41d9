"""Gradient-boosted trees for two classes, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Forest:
    """Complete trees of one depth: node i has the children 2i+1 (not above the threshold) and 2i+2."""

    base: float
    feature: np.ndarray  # tree, inner node
    threshold: np.ndarray
    value: np.ndarray  # tree, leaf

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            while True:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
                if len(node) == 0 or node[0] >= len(feature):
                    break
            out += value[node - len(feature)]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2,
          pull: float = 2.0) -> Forest:
    """Newton boosting of the logistic loss over quantile bins."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    share = np.clip(np.average(y, weights=weight), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    score, inner = np.full(len(y), base), 2 ** depth - 1
    features, thresholds, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = weight * (y - p), weight * p * (1 - p)
        feature, threshold, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for level in range(depth):
            first, many = 2 ** level - 1, 2 ** level
            gain = np.full((many, x.shape[1], BINS), -np.inf)
            for f in range(x.shape[1]):
                cell = (node - first) * BINS + binned[:, f]
                gs = np.bincount(cell, g, many * BINS).reshape(many, BINS).cumsum(axis=1)
                hs = np.bincount(cell, h, many * BINS).reshape(many, BINS).cumsum(axis=1)
                total_g, total_h = gs[:, -1:], hs[:, -1:]
                gain[:, f] = (gs ** 2 / (hs + pull) + (total_g - gs) ** 2 / (total_h - hs + pull)
                              - total_g ** 2 / (total_h + pull))
                gain[:, f, len(edges[f]):] = -np.inf
            flat = gain.reshape(many, -1)
            best = flat.argmax(axis=1)
            for k in range(many):
                if flat[k, best[k]] > 1e-6:
                    f, b = divmod(int(best[k]), BINS)
                    feature[first + k], threshold[first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + pull)
        score += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Forest(base, np.array(features), np.array(thresholds), np.array(values))

"""Gradient-boosted trees for a yes/no question, fitted in numpy on binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """Complete trees of one depth: per tree the feature and threshold of every inner node and the value of every leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    start: float

    def logits(self, rows: np.ndarray) -> np.ndarray:
        depth = self.leaf.shape[1].bit_length() - 1
        out, each = np.full(len(rows), self.start), np.arange(len(rows))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (rows[each, feature[node]] > threshold[node])
            out += leaf[node - (len(leaf) - 1)]
        return out


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    values = np.unique(column)
    if len(values) > bins:
        values = np.unique(np.quantile(column, np.linspace(0, 1, bins)))
    return (values[1:] + values[:-1]) / 2


def fit(rows: np.ndarray, label: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.25, bins: int = 32, least: float = 2.0) -> Forest:
    """Logistic loss, second-order gains, trees grown level by level; `least` is added to every curvature."""
    edges = [_edges(column, bins) for column in rows.T]
    width = bins + 1
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, rows.T, strict=True)], axis=1)
    count, features = rows.shape
    mean = np.clip(label.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(mean / (1 - mean)))
    logit = np.full(count, start)
    inner, leaves = 2**depth - 1, 2**depth
    feature, threshold = np.zeros((trees, inner), dtype=np.int64), np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, leaves))
    flat = binned + np.arange(features) * width
    for t in range(trees):
        chance = 1 / (1 + np.exp(-logit))
        slope, bend = label - chance, chance * (1 - chance)
        node = np.zeros(count, dtype=np.int64)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            place = ((node - first)[:, None] * (features * width) + flat).ravel()
            size = many * features * width
            gain_of = [
                np.bincount(place, weights=np.repeat(w, features), minlength=size).reshape(many, features, width).cumsum(axis=2)
                for w in (slope, bend)
            ]
            g, h = gain_of
            total_g, total_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + least) + (total_g - g) ** 2 / (total_h - h + least) - total_g**2 / (total_h + least)
            best = gain.reshape(many, -1).argmax(axis=1)
            for k, at in enumerate(best.tolist()):
                f, cut = divmod(at, width)
                if gain[k, f, cut] > 1e-9 and cut < len(edges[f]):
                    feature[t, first + k], threshold[t, first + k] = f, edges[f][cut]
            node = 2 * node + 1 + (rows[np.arange(count), feature[t, node]] > threshold[t, node])
        end = node - inner
        leaf[t] = rate * np.bincount(end, weights=slope, minlength=leaves) / (np.bincount(end, weights=bend, minlength=leaves) + least)
        logit += leaf[t][end]
    return Forest(feature, threshold, leaf, start)

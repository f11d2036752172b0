"""Gradient-boosted trees over binned features, and isotonic calibration, in numpy.

For samples of bounded size: the caller states the bound. Trees are complete binary trees
of one depth, stored as arrays, so scoring is a handful of vector look-ups."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    base: float
    rate: float
    depth: int
    #: by tree and inner node: feature and threshold (go right if greater); by tree and leaf: value
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += self.rate * v[node - (2 ** self.depth - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32,
        ridge: float = 1.0) -> Boosted:
    """Newton boosting of the logistic loss. Ties between splits go to the first feature and bin."""
    n, width = x.shape
    share = np.clip(y.mean() if n else 0.0, 1e-4, 1 - 1e-4)
    base = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(1) for f in range(width)]
    # values that are nearly always 0 have all quantiles at 0: that edge still parts them from the rest
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1) if n else None
    size, inner = bins + 1, 2 ** depth - 1
    margin = np.full(n, base)
    features, thresholds, values = [], [], []
    for _ in range(trees if n and 0 < y.sum() < n else 0):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = y - p, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2 ** level - 1, 2 ** level
            at = node - first
            gain_best = np.full(count, 1e-9)
            for f in range(width):
                key = at * size + binned[:, f]
                g = np.bincount(key, gradient, count * size).reshape(count, size).cumsum(1)
                h = np.bincount(key, hessian, count * size).reshape(count, size).cumsum(1)
                gt, ht = g[:, -1:], h[:, -1:]
                gain = g ** 2 / (h + ridge) + (gt - g) ** 2 / (ht - h + ridge) - gt ** 2 / (ht + ridge)
                cut = gain[:, :len(edges[f])].argmax(1)
                found = gain[np.arange(count), cut]
                better = found > gain_best
                gain_best[better] = found[better]
                feature[first:first + count][better] = f
                threshold[first:first + count][better] = edges[f][cut[better]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf = node - inner
        g, h = np.bincount(leaf, gradient, inner + 1), np.bincount(leaf, hessian, inner + 1)
        value = g / (h + ridge)
        margin = margin + rate * value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    shape = (len(features), inner)
    return Boosted(base, rate, depth, np.array(features, np.int64).reshape(shape),
                   np.array(thresholds, float).reshape(shape), np.array(values, float).reshape(len(features), inner + 1))


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: score levels and the share of label 1 at each, never falling."""
    order = np.argsort(score, kind="stable")
    levels, start = np.unique(score[order], return_index=True)
    if not len(levels):
        return np.zeros(1), np.zeros(1)
    weights = np.diff(np.r_[start, len(order)]).astype(float)
    means = np.add.reduceat(y[order].astype(float), start) / weights
    blocks: list[list[float]] = []
    for mean, weight in zip(means, weights):
        blocks.append([mean, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m, w, k = blocks.pop()
            last = blocks[-1]
            last[0] = (last[0] * last[1] + m * w) / (last[1] + w)
            last[1] += w
            last[2] += k
    return levels, np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])

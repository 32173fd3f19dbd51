"""Gradient-boosted trees for two classes on binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Forest:
    """Complete trees of equal depth, level by level: ``feature[t, i]`` and the largest bin that goes left."""

    cuts: list[np.ndarray]
    feature: np.ndarray
    bin: np.ndarray
    leaf: np.ndarray
    start: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        binned = _binned(x, self.cuts)
        depth = int(np.log2(self.leaf.shape[1]))
        rows = np.arange(len(x))
        out = np.full(len(x), self.start)
        for feature, bin_, leaf in zip(self.feature, self.bin, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for level in range(depth):
                node = (1 << level) - 1 + at
                at = 2 * at + (binned[rows, feature[node]] > bin_[node])
            out += leaf[at]
        return out


def _binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    out = np.empty(x.shape, np.uint8)
    for j, cut in enumerate(cuts):
        out[:, j] = np.searchsorted(cut, x[:, j], side="left") if len(cut) else 0
    return out


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, smoothing: float = 5.0
) -> Forest:
    """Boosts the logarithmic loss; a leaf's value is a Newton step, shrunk by ``rate``."""
    cuts = [_cut(x[:, j]) for j in range(x.shape[1])]
    binned = _binned(x, cuts)
    n, width = binned.shape
    cells = binned.astype(np.int64) + np.arange(width) * BINS
    share = np.clip(y.mean(), 0.01, 0.99)
    start = float(np.log(share / (1 - share)))
    logit = np.full(n, start)
    features, bins, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-logit))
        slope, bend = y - p, p * (1 - p)
        feature, bin_ = np.zeros((1 << depth) - 1, np.int64), np.full((1 << depth) - 1, 255, np.int64)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            nodes = 1 << level
            size = nodes * width * BINS
            flat = (cells + (at * width * BINS)[:, None]).ravel()
            g = np.bincount(flat, np.repeat(slope, width), size).reshape(nodes, width, BINS).cumsum(axis=2)
            h = np.bincount(flat, np.repeat(bend, width), size).reshape(nodes, width, BINS).cumsum(axis=2)
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + smoothing) + (g_all - g) ** 2 / (h_all - h + smoothing) - g_all**2 / (h_all + smoothing)
            best = gain[:, :, :-1].reshape(nodes, -1).argmax(axis=1)
            chosen, place = np.divmod(best, BINS - 1)
            worth = gain[np.arange(nodes), chosen, place] > 1e-6
            first = nodes - 1
            feature[first : first + nodes] = np.where(worth, chosen, 0)
            bin_[first : first + nodes] = np.where(worth, place, 255)
            at = 2 * at + (binned[np.arange(n), feature[first + at]] > bin_[first + at])
        g, h = np.bincount(at, slope, 1 << depth), np.bincount(at, bend, 1 << depth)
        leaf = rate * g / (h + smoothing)
        logit += leaf[at]
        features.append(feature)
        bins.append(bin_)
        leaves.append(leaf)
    return Forest(cuts, np.array(features), np.array(bins), np.array(leaves), start)


def _cut(values: np.ndarray) -> np.ndarray:
    """At most ``BINS - 1`` thresholds between the values, at their quantiles."""
    different = np.unique(values)
    if len(different) < 2:
        return np.empty(0, values.dtype)
    if len(different) <= BINS:
        return (different[:-1] + different[1:]) / 2
    return np.unique(np.quantile(values, np.linspace(0, 1, BINS + 1)[1:-1])).astype(values.dtype)

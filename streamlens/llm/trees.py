"""Gradient-boosted decision trees for two classes, in numpy, on features cut into at most ``BINS`` bins."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Trees:
    """``edges``: cut points per feature. Trees of one depth, stored level by level."""

    edges: list[np.ndarray]
    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    depth: int

    def bins(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.uint8)
        for f, edge in enumerate(self.edges):
            out[:, f] = np.searchsorted(edge, x[:, f], "left")
        return out

    def logit(self, x: np.ndarray) -> np.ndarray:
        binned = self.bins(x)
        row = np.arange(len(x))
        out = np.full(len(x), self.base)
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (binned[row, feature[at]] > cut[at])
            out += leaf[at - (2**self.depth - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, count: int = 50, depth: int = 4, rate: float = 0.2, smooth: float = 2.0) -> Trees:
    """Newton boosting of the log loss: the split of each node has the largest gain over all features and bins."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)))[:-1] for f in range(x.shape[1])]
    p = np.clip(np.average(y, weights=weight), 0.01, 0.99)
    inner = 2**depth - 1
    out = Trees(edges, float(np.log(p / (1 - p))), np.zeros((count, inner), np.int64), np.full((count, inner), 255, np.int64), np.zeros((count, inner + 1)), depth)
    binned = np.asfortranarray(out.bins(x).astype(np.int64))
    useful = [f for f in range(x.shape[1]) if len(edges[f])]
    score = np.full(len(y), out.base)
    for t in range(count):
        q = 1 / (1 + np.exp(-score))
        slope, curve = weight * (y - q), weight * q * (1 - q)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            nodes, low = 2**level, 2**level - 1
            best = np.full(nodes, 1e-6)
            total_s, total_c = (np.bincount(at - low, v, nodes) for v in (slope, curve))
            for f in useful:
                cell = (at - low) * BINS + binned[:, f]
                s = np.bincount(cell, slope, nodes * BINS).reshape(nodes, BINS).cumsum(axis=1)[:, :-1]
                c = np.bincount(cell, curve, nodes * BINS).reshape(nodes, BINS).cumsum(axis=1)[:, :-1]
                rest_s, rest_c = total_s[:, None] - s, total_c[:, None] - c
                gain = s * s / (c + smooth) + rest_s * rest_s / (rest_c + smooth) - (total_s * total_s / (total_c + smooth))[:, None]
                cut = gain.argmax(axis=1)
                value = gain[np.arange(nodes), cut]
                better = value > best
                best[better] = value[better]
                out.feature[t, low : low + nodes][better] = f
                out.cut[t, low : low + nodes][better] = cut[better]
            at = 2 * at + 1 + (binned[np.arange(len(y)), out.feature[t][at]] > out.cut[t][at])
        leaf = at - inner
        s, c = (np.bincount(leaf, v, inner + 1) for v in (slope, curve))
        out.leaf[t] = rate * s / (c + smooth)
        score += out.leaf[t][leaf]
    return out

"""Gradient-boosted trees with monotonic constraints, kept as flat numpy node arrays.

Trees are complete binary trees of one depth, so a node's children are found by arithmetic and a
whole batch moves down all trees of the ensemble in `depth` vectorised steps.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Trees(NamedTuple):
    feature: np.ndarray  #: (trees, inner nodes) column that a node tests
    threshold: np.ndarray  #: (trees, inner nodes) larger values go right; inf where a node has no split
    value: np.ndarray  #: (trees, leaves)
    base: float
    depth: int


def constant(p: float, columns: int = 1) -> Trees:
    """A model that gives every row the same probability."""
    p = min(max(p, 1e-6), 1 - 1e-6)
    return Trees(np.zeros((1, 1), np.int64), np.full((1, 1), np.inf), np.zeros((1, 2)), float(np.log(p / (1 - p))), 1)


def margin(m: Trees, x: np.ndarray) -> np.ndarray:
    trees = np.arange(m.feature.shape[0])[None, :]
    rows = np.arange(len(x))[:, None]
    node = np.zeros((len(x), m.feature.shape[0]), np.int64)
    for _ in range(m.depth):
        node = 2 * node + 1 + (x[rows, m.feature[trees, node]] > m.threshold[trees, node])
    return m.base + m.value[trees, node - (2**m.depth - 1)].sum(axis=1)


def predict(m: Trees, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin(m, x), -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, monotone: list[int] | None = None, trees: int = 40, depth: int = 4, rate: float = 0.2, bins: int = 48, l2: float = 1.0, least: float = 5.0) -> Trees:
    """Newton boosting of the log loss on quantile bins.

    monotone: +1, -1 or 0 for each column. A split on a constrained column must order its two
    values, and their midpoint bounds everything below, so the whole ensemble is monotone in it.
    """
    x, y = np.asarray(x, float), np.asarray(y, float)
    if not len(y) or y.min() == y.max():
        return constant(y.mean() if len(y) else 0.5)
    n, columns = x.shape
    sign = np.asarray(monotone if monotone is not None else [0] * columns)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(columns)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    f = np.full(n, base)
    inner, leaves = 2**depth - 1, 2**depth
    features, thresholds, values = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    offset = (np.arange(columns) * bins)[None, :]
    for t in range(trees):
        p = 1 / (1 + np.exp(-f))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)  # within the level
        low, high = np.full(1, -np.inf), np.full(1, np.inf)
        for level in range(depth):
            width, first = 2**level, 2**level - 1
            cell = (node[:, None] * (columns * bins) + offset + binned).ravel()
            shape = (width, columns, bins)
            gs = np.bincount(cell, np.repeat(g, columns), minlength=width * columns * bins).reshape(shape)
            hs = np.bincount(cell, np.repeat(h, columns), minlength=width * columns * bins).reshape(shape)
            gl, hl = gs.cumsum(2), hs.cumsum(2)
            gt, ht = gl[:, :1, -1:], hl[:, :1, -1:]
            lo, hi = low[:, None, None], high[:, None, None]
            weight = lambda a, b: np.clip(-a / (b + l2), lo, hi)  # noqa: B023, E731
            worth = lambda a, b, w: -(a * w + 0.5 * (b + l2) * w * w)
            gr, hr = gt - gl, ht - hl
            wl, wr = weight(gl, hl), weight(gr, hr)
            gain = worth(gl, hl, wl) + worth(gr, hr, wr) - worth(gt, ht, weight(gt, ht))
            gain = np.where((hl < least * 0.05) | (hr < least * 0.05) | (sign[None, :, None] * (wr - wl) < 0), -np.inf, gain)
            best = gain.reshape(width, -1).argmax(1)
            col, cut = best // bins, best % bins
            good = gain.reshape(width, -1)[np.arange(width), best] > 1e-9
            low2, high2 = np.repeat(low, 2), np.repeat(high, 2)
            for k in np.flatnonzero(good):
                j, c = col[k], cut[k]
                if c >= len(cuts[j]):
                    good[k] = False
                    continue
                features[t, first + k], thresholds[t, first + k] = j, cuts[j][c]
                if sign[j]:
                    mid = (wl[k, j, c] + wr[k, j, c]) / 2
                    a, b = (high2, low2) if sign[j] > 0 else (low2, high2)
                    a[2 * k], b[2 * k + 1] = mid, mid
            low, high = low2, high2
            node = 2 * node + (good[node] & (binned[np.arange(n), col[node]] > cut[node]))
        g_leaf, h_leaf = np.bincount(node, g, leaves), np.bincount(node, h, leaves)
        values[t] = rate * np.clip(-g_leaf / (h_leaf + l2), low, high)
        f = f + values[t, node]
    return Trees(features, thresholds, values, base, depth)

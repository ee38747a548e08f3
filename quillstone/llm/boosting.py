"""Gradient-boosted trees for a yes/no target in numpy, kept as flat node arrays, with monotonic constraints."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Flat nodes of all trees; a leaf is its own child, so that a row settles there."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of yes for each row of x."""
        rows = np.arange(len(x))
        total = np.full(len(x), self.base)
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 64, l2: float = 1.0, least: float = 1.0) -> Trees:
    """Trees for y (0 or 1). monotone: +1, -1 or 0 for each feature, the direction in which the score may move with it."""
    y = y.astype(float)
    rate_yes = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(rate_yes / (1 - rate_yes)))
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, column, "left") for e, column in zip(edges, x.T, strict=True)], axis=1)
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots, total = [], np.full(len(y), base)

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
        me = len(nodes)
        value = float(np.clip(-g[rows].sum() / (h[rows].sum() + l2), low, high))
        nodes.append([0, 0.0, me, me, value * rate])
        best = (1e-6, None)
        if level < depth and len(rows) > 1:
            sums_g, sums_h = g[rows].sum(), h[rows].sum()
            for f in range(x.shape[1]):
                if not len(edges[f]):
                    continue
                gl = np.cumsum(np.bincount(binned[rows, f], g[rows], len(edges[f]) + 1))[:-1]
                hl = np.cumsum(np.bincount(binned[rows, f], h[rows], len(edges[f]) + 1))[:-1]
                gr, hr = sums_g - gl, sums_h - hl
                wl, wr = np.clip(-gl / (hl + l2), low, high), np.clip(-gr / (hr + l2), low, high)
                # The loss of a clipped weight w is g w + (h + l2) w^2 / 2.
                gain = -(gl * wl + (hl + l2) * wl**2 / 2 + gr * wr + (hr + l2) * wr**2 / 2) + (sums_g * value + (sums_h + l2) * value**2 / 2)
                gain[(hl < least) | (hr < least) | (monotone[f] * (wr - wl) < 0)] = -np.inf
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], (f, k, wl[k], wr[k]))
        if best[1]:
            f, k, wl, wr = best[1]
            goes_left = binned[rows, f] <= k
            middle = (wl + wr) / 2
            bounds = ((low, high), (low, high)) if not monotone[f] else ((low, middle), (middle, high)) if monotone[f] > 0 else ((middle, high), (low, middle))
            nodes[me][:2] = [f, float(edges[f][k])]
            nodes[me][2] = grow(rows[goes_left], g, h, level + 1, *bounds[0])
            nodes[me][3] = grow(rows[~goes_left], g, h, level + 1, *bounds[1])
        return me

    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0, -np.inf, np.inf))
        node = np.full(len(y), roots[-1])
        flat = [np.array(c) for c in zip(*nodes, strict=True)]
        for _ in range(depth):
            node = np.where(x[np.arange(len(y)), flat[0][node]] <= flat[1][node], flat[2][node], flat[3][node])
        total = total + flat[4][node]
    return Trees(base, np.array(roots), *flat, depth)

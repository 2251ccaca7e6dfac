"""Histogram gradient-boosted trees for two classes, kept as flat arrays, and isotonic calibration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """All trees in one set of arrays: node i goes left if feature[i] <= threshold[i]; a leaf points to itself."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row: all trees go down one level at a time."""
        node = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return self.start + self.value[node].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def constant(probability: float, n_features: int) -> Trees:
    """A model that knows nothing but the share of label 1, for labels of one class or none."""
    p, one = min(max(probability, 1e-3), 1 - 1e-3), np.zeros(1, np.int64)
    return Trees(one, one, np.zeros(1), one, one, np.zeros(1), float(np.log(p / (1 - p))), 0)


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 1.0, least: float = 1.0) -> Trees:
    """Boosted trees for the log loss. Features are cut at quantiles; a level's splits come from one histogram.

    `least` is the smallest sum of second derivatives in a leaf. Labels of one class give a constant.
    """
    if not len(y) or y.min() == y.max():
        return constant(float(y.mean()) if len(y) else 0.5, x.shape[1])
    n, n_features = x.shape
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for column in x.T]
    binned = np.stack([np.searchsorted(cut, column, side="left") for cut, column in zip(cuts, x.T)], axis=1)
    place = np.arange(n_features) * bins
    start = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(n, start)
    parts = {name: [] for name in ("feature", "threshold", "left", "right", "value")}
    roots, offset = [], 0
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node, size = np.zeros(n, np.int64), 2 ** (depth + 1) - 1
        feature, threshold, value = np.zeros(size, np.int64), np.full(size, np.inf), np.zeros(size)
        left, right = np.arange(size), np.arange(size)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            live = np.flatnonzero(node >= first)
            if not len(live):
                break
            slot = ((node[live] - first)[:, None] * (n_features * bins) + place + binned[live]).ravel()
            shape = (width, n_features, bins)
            gs = np.bincount(slot, np.repeat(g[live], n_features), minlength=width * n_features * bins).reshape(shape).cumsum(axis=2)
            hs = np.bincount(slot, np.repeat(h[live], n_features), minlength=width * n_features * bins).reshape(shape).cumsum(axis=2)
            g_all, h_all = gs[:, :1, -1:], hs[:, :1, -1:]
            gain = gs**2 / (hs + l2) + (g_all - gs) ** 2 / (h_all - hs + l2) - g_all**2 / (h_all + l2)
            gain[(hs < least) | (h_all - hs < least)] = 0
            gain = gain.reshape(width, -1)
            best = gain.argmax(axis=1)
            splits = {}
            for k in np.flatnonzero(gain[np.arange(width), best] > 1e-6).tolist():
                f, b = divmod(int(best[k]), bins)
                i = first + k
                feature[i], threshold[i], left[i], right[i] = f, cuts[f][b], 2 * i + 1, 2 * i + 2
                splits[i] = (f, b)
            for i, (f, b) in splits.items():
                own = live[node[live] == i]
                node[own] = np.where(binned[own, f] <= b, 2 * i + 1, 2 * i + 2)
        leaves = np.unique(node)
        g_leaf, h_leaf = np.bincount(node, g, minlength=size), np.bincount(node, h, minlength=size)
        value[leaves] = -rate * g_leaf[leaves] / (h_leaf[leaves] + l2)
        margin += value[node]
        for name, own in (("feature", feature), ("threshold", threshold), ("left", left + offset), ("right", right + offset), ("value", value)):
            parts[name].append(own)
        roots.append(offset)
        offset += size
    return Trees(np.array(roots), *(np.concatenate(parts[name]) for name in ("feature", "threshold", "left", "right", "value")), start, depth)


@dataclass(frozen=True)
class Isotonic:
    """A rising map from scores to probabilities, linear between its points."""

    x: np.ndarray
    y: np.ndarray

    def __call__(self, scores: np.ndarray) -> np.ndarray:
        return np.interp(scores, self.x, self.y)


def isotonic(scores: np.ndarray, y: np.ndarray) -> Isotonic:
    """Least-squares rising map, by pooling neighbours that fall; each pool gets one pseudo-row of the overall share."""
    if not len(scores):
        return Isotonic(np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    order = np.argsort(scores, kind="stable")
    pools: list[list[float]] = []  # sum of y, rows, lowest score, highest score
    for score, label in zip(scores[order].tolist(), y[order].tolist()):
        pools.append([label, 1, score, score])
        while len(pools) > 1 and (pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1] or pools[-2][3] == pools[-1][2]):
            total, rows, _, high = pools.pop()
            pools[-1] = [pools[-1][0] + total, pools[-1][1] + rows, pools[-1][2], high]
    share = float(y.mean())
    level = np.maximum.accumulate([(total + share) / (rows + 1) for total, rows, _, _ in pools])
    xs = np.array([edge for pool in pools for edge in pool[2:]])
    return Isotonic(xs, np.repeat(level, 2))

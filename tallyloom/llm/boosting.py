"""Histogram gradient-boosted trees in numpy, flattened into arrays.

Features are cut into bins at quantiles of the training rows. A tree is grown
level by level from histograms of gradients and curvatures of the log loss. A
trained forest is a few arrays; all rows walk all trees at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Growth:
    trees: int = 120
    depth: int = 4
    rate: float = 0.1
    bins: int = 64
    least_curvature: float = 2.0
    shrink: float = 1.0
    #: rows kept apart (by place, one in so many) to choose the number of trees
    apart: int = 5


@dataclass
class Forest:
    """Trees as rows of complete arrays: node k has the children 2k+1 and 2k+2.

    A row goes left where its feature is at most the limit. Nodes that don't
    part have an infinite limit, so every path ends at a node of the last level;
    ``values`` are those of the last level.
    """

    features: np.ndarray
    limits: np.ndarray
    values: np.ndarray
    start: float

    def margins(self, rows: np.ndarray, block: int = 4096) -> np.ndarray:
        out = np.full(len(rows), self.start)
        trees, inner = self.features.shape
        if not trees:
            return out
        depth = (inner + 1).bit_length() - 1
        first, flat, cuts = np.arange(trees) * inner, self.features.ravel(), self.limits.ravel()
        for at in range(0, len(rows), block):
            some = rows[at:at + block]
            line = np.arange(len(some))[:, None]
            node = np.zeros((len(some), trees), np.int64)
            for _ in range(depth):
                where = first + node
                node = 2 * node + 1 + (some[line, flat[where]] > cuts[where])
            out[at:at + block] += self.values[np.arange(trees), node - inner].sum(axis=1)
        return out

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid(self.margins(rows))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def bin_limits(column: np.ndarray, bins: int) -> np.ndarray:
    """Rising limits between bins, taken from the column's own values."""
    steps = np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower") if len(column) else np.zeros(0)
    limits = np.unique(steps)
    return limits[limits < column.max()] if len(limits) else limits


def train(rows: np.ndarray, labels: np.ndarray, weights: np.ndarray, growth: Growth = Growth()) -> Forest:
    """Boosts the log loss of ``labels`` (0 or 1); without rows, or with one label only, the forest has no trees."""
    inner = 2 ** growth.depth - 1
    share = float(np.average(labels, weights=weights)) if len(labels) else 0.5
    share = min(max(share, 1e-3), 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    bare = Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), start)
    if not len(labels) or labels.min() == labels.max():
        return bare
    limits = [bin_limits(rows[:, f], growth.bins) for f in range(rows.shape[1])]
    binned = np.column_stack([np.searchsorted(cuts, rows[:, f], side="left") for f, cuts in enumerate(limits)])
    apart = np.arange(len(labels)) % growth.apart == 0
    few = len(np.unique(labels[~apart])) < 2
    fitted = np.ones(len(labels), bool) if few else ~apart
    margins = np.full(len(labels), start)
    grown, losses = [], []
    for _ in range(growth.trees):
        p = sigmoid(margins)
        tree, place = grow(binned, fitted, weights * (p - labels), weights * p * (1 - p), [len(c) + 1 for c in limits], growth)
        margins = margins + tree[2][place]
        grown.append(tree)
        losses.append(log_loss(margins[~fitted], labels[~fitted], weights[~fitted]) if not few else 0.0)
    grown = grown[:int(np.argmin(losses)) + 1] if not few else grown
    features = np.array([t[0] for t in grown])
    cuts = np.array([[limits[f][b] if b >= 0 else np.inf for f, b in zip(t[0], t[1])] for t in grown])
    return Forest(features, cuts, np.array([t[2] for t in grown]), start)


def log_loss(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    return float(np.average(np.logaddexp(0, np.where(labels == 1, -margins, margins)), weights=weights))


def grow(binned: np.ndarray, fitted: np.ndarray, slopes: np.ndarray, curves: np.ndarray, sizes: list[int], growth: Growth):
    """One tree: feature and bin of each inner node (bin -1: does not part), values of the last level, and each row's place there."""
    n, width = binned.shape
    bins = max(sizes)
    inner = 2 ** growth.depth - 1
    features, cuts = np.zeros(inner, np.int64), np.full(inner, -1, np.int64)
    cells = np.arange(width) * bins + binned
    node = np.zeros(n, np.int64)
    slope, curve = np.where(fitted, slopes, 0.0), np.where(fitted, curves, 0.0)
    for level in range(growth.depth):
        nodes = 2 ** level
        at = ((node * width * bins)[:, None] + cells).ravel()
        shape = (nodes, width, bins)
        g, h = (np.bincount(at, np.repeat(x, width), nodes * width * bins).reshape(shape).cumsum(axis=2) for x in (slope, curve))
        whole_g, whole_h = g[:, :, -1:], h[:, :, -1:]
        gain = g ** 2 / (h + growth.shrink) + (whole_g - g) ** 2 / (whole_h - h + growth.shrink) - whole_g ** 2 / (whole_h + growth.shrink)
        gain[(h < growth.least_curvature) | (whole_h - h < growth.least_curvature)] = 0.0
        best = gain.reshape(nodes, -1).argmax(axis=1)
        parts = gain.reshape(nodes, -1)[np.arange(nodes), best] > 1e-9
        first = nodes - 1
        features[first:first + nodes] = np.where(parts, best // bins, 0)
        cuts[first:first + nodes] = np.where(parts, best % bins, -1)
        mine = first + node
        right = (cuts[mine] >= 0) & (binned[np.arange(n), features[mine]] > cuts[mine])
        node = 2 * node + right
    g, h = (np.bincount(node, x, inner + 1) for x in (slope, curve))
    return (features, cuts, -growth.rate * g / (h + growth.shrink)), node

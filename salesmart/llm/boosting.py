"""Gradient-boosted trees for two classes on binned dense features, and isotonic calibration.

Small numpy parts for models fitted on a bounded sample; deterministic for rows
in a given order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROUNDS = 60
DEPTH = 3
RATE = 0.2
BINS = 32
L2 = 1.0
MIN_HESSIAN = 1.0


@dataclass(frozen=True)
class Trees:
    """Complete binary trees: at node k a row goes right if its feature exceeds the threshold."""

    base: float
    features: np.ndarray  # (trees, inner nodes)
    thresholds: np.ndarray  # (trees, inner nodes)
    leaves: np.ndarray  # (trees, leaves)

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of class 1 for each row of ``x``."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.features.shape[1]
        for feature, threshold, leaf in zip(self.features, self.thresholds, self.leaves):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:  # all rows are on one level
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - inner]
        return out


def _edges(column: np.ndarray) -> np.ndarray:
    """Cuts between distinct quantiles of a column."""
    values = np.unique(np.quantile(column, np.linspace(0, 1, BINS), method="inverted_cdf"))
    return (values[1:] + values[:-1]) / 2


def fit_trees(
    x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, depth: int = DEPTH, rate: float = RATE
) -> Trees:
    """Boosts on the logistic loss; both classes must be present."""
    n, width = x.shape
    edges = [_edges(x[:, f]) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    offsets = np.arange(width) * BINS
    share = y.mean()
    base = float(np.log(share / (1 - share)))
    margin = np.full(n, base)
    inner = 2**depth - 1
    features = np.zeros((rounds, inner), np.int64)
    thresholds = np.full((rounds, inner), np.inf)
    leaves = np.zeros((rounds, inner + 1))

    def histogram(cell: np.ndarray, weight: np.ndarray, nodes: int) -> np.ndarray:
        found = np.bincount(cell.ravel(), np.repeat(weight, width), nodes * width * BINS)
        return found.reshape(nodes, width, BINS)

    for t in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            cell = ((node - first) * (width * BINS))[:, None] + offsets + binned
            g = histogram(cell, slope, nodes).cumsum(axis=2)
            h = histogram(cell, bend, nodes).cumsum(axis=2)
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + L2) + (g_all - g) ** 2 / (h_all - h + L2) - g_all**2 / (h_all + L2)
            gain[(h < MIN_HESSIAN) | (h_all - h < MIN_HESSIAN)] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            for k, place in enumerate(best.tolist()):
                feature, bin_ = divmod(place, BINS)
                if gain[k, feature, bin_] > 1e-9 and bin_ < len(edges[feature]):
                    features[t, first + k] = feature
                    thresholds[t, first + k] = edges[feature][bin_]
            node = 2 * node + 1 + (x[np.arange(n), features[t, node]] > thresholds[t, node])
        leaf = node - inner
        g, h = (np.bincount(leaf, w, inner + 1) for w in (slope, bend))
        leaves[t] = -rate * g / (h + L2)
        margin += leaves[t][leaf]
    return Trees(base, features, thresholds, leaves)


@dataclass(frozen=True)
class Isotonic:
    """A non-decreasing map of margins to probabilities, linear between pooled blocks."""

    at: np.ndarray
    value: np.ndarray

    def __call__(self, margins: np.ndarray) -> np.ndarray:
        return np.interp(margins, self.at, self.value)


def fit_isotonic(margins: np.ndarray, y: np.ndarray) -> Isotonic:
    """Pools adjacent violators; a block's value is drawn half an observation towards even odds."""
    at, place = np.unique(margins, return_inverse=True)
    weight = np.bincount(place).astype(np.float64)
    total = np.bincount(place, y)
    blocks: list[list[float]] = []  # weight, sum of y, first and last margin
    for x, w, s in zip(at.tolist(), weight.tolist(), total.tolist()):
        blocks.append([w, s, x, x])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            w1, s1, _, last = blocks.pop()
            blocks[-1][0] += w1
            blocks[-1][1] += s1
            blocks[-1][3] = last
    ends, values = [], []
    for w, s, first, last in blocks:
        ends += [first, last]
        values += [(s + 0.5) / (w + 1)] * 2
    return Isotonic(np.array(ends), np.maximum.accumulate(np.array(values)))

"""Gradient-boosted trees over histograms of binned features, for two classes; training and traversal in numpy."""

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """Complete trees of one depth as flat arrays; node n has children 2n+1 (value <= threshold) and 2n+2."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes
    leaf: np.ndarray  # trees x leaves

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row; all trees go down a level at a time."""
        trees, inner = self.feature.shape
        node = np.zeros((len(x), trees), np.int64)
        rows, tree = np.arange(len(x))[:, None], np.arange(trees)[None, :]
        for _ in range(int(np.log2(inner + 1))):
            node = 2 * node + 1 + (x[rows, self.feature[tree, node]] > self.threshold[tree, node])
        margin = self.base + self.leaf[tree, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def constant(share: float) -> Forest:
    """Gives every row the same score."""
    share = min(max(share, 1e-9), 1 - 1e-9)
    nothing = np.zeros((1, 1))
    return Forest(float(np.log(share / (1 - share))), nothing.astype(int), nothing, np.zeros((1, 2)))


def bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Cuts between values at even quantiles, for each feature."""
    return [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for column in x.T]


def fit(x: np.ndarray, y: np.ndarray, trees=80, depth=4, rate=0.15, bins=64, least_weight=5.0, ridge=1.0) -> Forest:
    """Newton boosting of the logistic loss. Without rows, or with one class only, the scores are constant."""
    if not len(y) or y.min() == y.max():
        return constant((y.sum() + 1) / (len(y) + 1) if len(y) else 1.0)
    edges = bin_edges(x, bins)
    binned = np.column_stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)])
    features, inner = x.shape[1], 2**depth - 1
    offsets = np.arange(features) * bins
    cells = binned + offsets
    base = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(len(y), base)
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            size = count * features * bins
            at = ((node - first)[:, None] * (features * bins) + cells).ravel()
            g = np.bincount(at, np.repeat(gradient, features), size).reshape(count, features, bins).cumsum(axis=2)
            h = np.bincount(at, np.repeat(weight, features), size).reshape(count, features, bins).cumsum(axis=2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
            gain[(h < least_weight) | (all_h - h < least_weight)] = -np.inf
            gain = gain.reshape(count, -1)
            best = gain.argmax(axis=1)
            for n in range(count):
                f, cut = divmod(int(best[n]), bins)
                if gain[n, best[n]] > 1e-6 and cut < len(edges[f]):
                    feature[t, first + n], threshold[t, first + n] = f, edges[f][cut]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > threshold[t, node])
        place = node - inner
        g = np.bincount(place, gradient, inner + 1)
        h = np.bincount(place, weight, inner + 1)
        leaf[t] = rate * g / (h + ridge)
        margin += leaf[t, place]
    return Forest(base, feature, threshold, leaf)

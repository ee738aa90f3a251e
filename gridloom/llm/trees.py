"""Bagged decision trees in numpy: small to train on a bounded sample, plain arrays to broadcast."""

from __future__ import annotations

import numpy as np

#: Thresholds tried for a feature: its quantiles in the sample.
BINS = 48


class BaggedTrees:
    """Trees on bootstrap samples, each on a random part of the features; a probability is the mean of the leaves' shares."""

    def __init__(self, trees: int = 30, depth: int = 7, features: float = 0.6, least: int = 8, seed: int = 7):
        self.trees, self.depth, self.features, self.least, self.seed = trees, depth, features, least, seed
        self.model: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BaggedTrees:
        rng = np.random.default_rng(self.seed)
        self.cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(self.cuts)], axis=1)
        k = max(1, round(self.features * x.shape[1]))
        for _ in range(self.trees):
            rows = rng.integers(0, len(x), len(x))
            own = rng.choice(x.shape[1], k, replace=False)
            feature = np.full(2 ** (self.depth + 1), -1)
            cut = np.zeros(2 ** (self.depth + 1))
            share = np.full(2 ** (self.depth + 1), 0.5)
            self._grow(binned, y.astype(float), rows, own, 1, feature, cut, share)
            self.model.append((feature, cut, share))
        return self

    def _grow(self, b: np.ndarray, y: np.ndarray, rows: np.ndarray, own: np.ndarray, node: int, feature: np.ndarray, cut: np.ndarray, share: np.ndarray) -> None:
        """Split where the Gini impurity falls most; node n has the children 2n (up to the cut) and 2n + 1."""
        t = y[rows]
        n, s = len(rows), t.sum()
        share[node] = (s + 0.5) / (n + 1)
        if 2 * node >= len(feature) or n < 2 * self.least or s in (0, n):
            return
        best, at = 1e-9, None
        whole = s * (n - s) / n
        for f in own:
            size = len(self.cuts[f]) + 1
            count = np.bincount(b[rows, f], minlength=size).cumsum()[:-1]
            ones = np.bincount(b[rows, f], weights=t, minlength=size).cumsum()[:-1]
            good = (count >= self.least) & (n - count >= self.least)
            if not good.any():
                continue
            c, o = count[good], ones[good]
            gain = whole - o * (c - o) / c - (s - o) * (n - c - s + o) / (n - c)
            i = int(gain.argmax())
            if gain[i] > best:
                best, at = gain[i], (f, int(np.flatnonzero(good)[i]))
        if at is None:
            return
        f, i = at
        feature[node], cut[node] = f, self.cuts[f][i]
        low = b[rows, f] <= i
        self._grow(b, y, rows[low], own, 2 * node, feature, cut, share)
        self._grow(b, y, rows[~low], own, 2 * node + 1, feature, cut, share)

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feature, cut, share in self.model:
            node = np.ones(len(x), dtype=np.int64)
            for _ in range(self.depth):
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[np.arange(len(x)), np.maximum(f, 0)] > cut[node]
                node = np.where(inner, 2 * node + right, node)
            total += share[node]
        return total / max(1, len(self.model))

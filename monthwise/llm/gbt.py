"""Gradient-boosted trees for binary labels in numpy (histogram splits, log loss)."""

from __future__ import annotations

import numpy as np


class Boosted:
    def __init__(self, edges, trees, bias):
        self.edges, self.trees, self.bias = edges, trees, bias

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(self.edges)], axis=1)

    def logits(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        out = np.full(len(x), self.bias)
        for tree in self.trees:
            out += _apply(tree, b)
        return out


def _apply(tree, b):
    feature, cut, left, value = tree
    at = np.zeros(len(b), dtype=np.int64)
    while True:
        inner = np.flatnonzero(feature[at] >= 0)
        if not len(inner):
            return value[at]
        n = at[inner]
        at[inner] = left[n] + (b[inner, feature[n]] > cut[n])


def fit(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 4, rate: float = 0.3, bins: int = 32,
        l2: float = 1.0, least: int = 10) -> Boosted:
    """``x`` rows x features, ``y`` 0 or 1."""
    edges = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, bins + 1)[1:-1])) for i in range(x.shape[1])]
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(edges, [], float(np.log(p / (1 - p))))
    b = model.bins(x)
    f = np.full(len(x), model.bias)
    for _ in range(trees):
        prob = 1 / (1 + np.exp(-f))
        g, h = y - prob, prob * (1 - prob)
        feature, cut, left, value = [-1], [0], [0], [0.0]
        todo = [(0, np.arange(len(x)), 0)]
        while todo:
            node, rows, level = todo.pop()
            gs, hs = g[rows].sum(), h[rows].sum()
            value[node] = rate * gs / (hs + l2)
            if level == depth or len(rows) < 2 * least:
                continue
            best = (1e-6, None, None)
            for i, e in enumerate(edges):
                if not len(e):
                    continue
                k = len(e) + 1
                gi = np.bincount(b[rows, i], g[rows], k).cumsum()[:-1]
                hi = np.bincount(b[rows, i], h[rows], k).cumsum()[:-1]
                n = np.bincount(b[rows, i], minlength=k).cumsum()[:-1]
                gain = gi ** 2 / (hi + l2) + (gs - gi) ** 2 / (hs - hi + l2) - gs ** 2 / (hs + l2)
                gain[(n < least) | (len(rows) - n < least)] = 0
                j = int(gain.argmax())
                if gain[j] > best[0]:
                    best = (float(gain[j]), i, j)
            if best[1] is None:
                continue
            feature[node], cut[node], left[node] = best[1], best[2], len(feature)
            right = b[rows, best[1]] > best[2]
            for part in (rows[~right], rows[right]):
                feature.append(-1)
                cut.append(0)
                left.append(0)
                value.append(0.0)
                todo.append((len(feature) - 1, part, level + 1))
        tree = (np.array(feature), np.array(cut), np.array(left), np.array(value))
        model.trees.append(tree)
        f += _apply(tree, b)
    return model

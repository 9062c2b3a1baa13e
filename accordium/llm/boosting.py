"""Small boosted models, fitted with numpy on a bounded sample of rows: histogram trees, and an additive model of tables."""

from __future__ import annotations

import numpy as np


def edges_of(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Quantile edges of each column; a value's bin is the number of edges below it."""
    return [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(x.shape[1])]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1) if len(edges) else np.zeros((len(x), 0), np.int64)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def prior(y: np.ndarray) -> float:
    p = (y.sum() + 1) / (len(y) + 2)
    return float(np.log(p / (1 - p)))


class Trees:
    """Gradient-boosted trees of one depth with the logistic loss; splits are on bins, leaves are Newton steps."""

    def __init__(self, depth: int = 3, rounds: int = 60, rate: float = 0.2, bins: int = 48, ridge: float = 2.0):
        self.depth, self.rounds, self.rate, self.bins, self.ridge = depth, rounds, rate, bins, ridge

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.edges, self.base = edges_of(x, self.bins), prior(y)
        b, width = binned(x, self.edges), self.bins + 1
        z = np.full(len(y), self.base)
        inner, leaves = 2**self.depth - 1, 2**self.depth
        self.feature, self.cut, self.leaf = np.zeros((self.rounds, inner), np.int64), np.full((self.rounds, inner), width), np.zeros((self.rounds, leaves))
        if not len(y) or y.min() == y.max():
            self.rounds = 0
            return self
        for t in range(self.rounds):
            p = sigmoid(z)
            g, h = y - p, np.maximum(p * (1 - p), 1e-6)
            node = np.zeros(len(y), np.int64)
            for level in range(self.depth):
                many = 2**level
                best = np.full(many, 1e-9)
                first = many - 1
                for j in range(b.shape[1]):
                    at = node * width + b[:, j]
                    gs = np.cumsum(np.bincount(at, g, many * width).reshape(many, width), axis=1)
                    hs = np.cumsum(np.bincount(at, h, many * width).reshape(many, width), axis=1)
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = gs**2 / (hs + self.ridge) + (gt - gs) ** 2 / (ht - hs + self.ridge) - gt**2 / (ht + self.ridge)
                    gain[(hs < 1) | (ht - hs < 1)] = 0
                    k = gain.argmax(axis=1)
                    value = gain[np.arange(many), k]
                    better = value > best
                    best = np.where(better, value, best)
                    self.feature[t, first : first + many][better] = j
                    self.cut[t, first : first + many][better] = k[better]
                f, c = self.feature[t, first + node], self.cut[t, first + node]
                node = node * 2 + (b[np.arange(len(y)), f] > c)
            gl, hl = np.bincount(node, g, leaves), np.bincount(node, h, leaves)
            self.leaf[t] = self.rate * gl / (hl + self.ridge)
            z += self.leaf[t][node]
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        b, z, rows = binned(x, self.edges), np.full(len(x), self.base), np.arange(len(x))
        for t in range(self.rounds):
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                at = 2**level - 1 + node
                node = node * 2 + (b[rows, self.feature[t, at]] > self.cut[t, at])
            z += self.leaf[t][node]
        return z


class Isotonic:
    """Pool adjacent violators over raw scores; a block's value is smoothed towards one half by one row."""

    def fit(self, z: np.ndarray, y: np.ndarray) -> Isotonic:
        order = np.argsort(z, kind="stable")
        blocks: list[list[float]] = []  # rows, sum of labels, sum of scores
        for s, v in zip(z[order].tolist(), y[order].tolist(), strict=True):
            blocks.append([1.0, v, s])
            while len(blocks) > 1 and blocks[-2][1] / blocks[-2][0] >= blocks[-1][1] / blocks[-1][0]:
                n, v2, s2 = blocks.pop()
                blocks[-1] = [blocks[-1][0] + n, blocks[-1][1] + v2, blocks[-1][2] + s2]
        self.at = np.array([b[2] / b[0] for b in blocks])
        self.to = np.maximum.accumulate(np.array([(b[1] + 0.5) / (b[0] + 1) for b in blocks])) if blocks else self.at
        return self

    def __call__(self, z: np.ndarray) -> np.ndarray:
        return np.interp(z, self.at, self.to) if len(self.at) else sigmoid(z)


class Additive:
    """Generalised additive model with pairwise interactions. Rounds go through the features in turn; each fits a tree of at
    most four leaves to the gradient over one feature's bins and adds it to the feature's table. Then the pairs whose four
    quadrants explain most of what is left get tables over coarser bins, boosted the same way. A score is the sum of the
    entries that a row's bins point at."""

    def __init__(self, rounds: int = 120, rate: float = 0.15, bins: int = 32, pairs: int = 6, pair_bins: int = 8, pair_rounds: int = 40, ridge: float = 2.0):
        self.rounds, self.rate, self.bins, self.pairs, self.pair_bins, self.pair_rounds, self.ridge = rounds, rate, bins, pairs, pair_bins, pair_rounds, ridge

    def _cut(self, g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
        gs, hs = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        if not len(gs):
            return 0.0, 0
        gt, ht = g.sum(), h.sum()
        gain = gs**2 / (hs + self.ridge) + (gt - gs) ** 2 / (ht - hs + self.ridge) - gt**2 / (ht + self.ridge)
        k = int(gain.argmax())
        return float(gain[k]), k + 1

    def _tree(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Steps over the bins: one split, then one of each side."""
        _, k = self._cut(g, h)
        cuts = sorted({0, len(g), k, self._cut(g[:k], h[:k])[1], k + self._cut(g[k:], h[k:])[1]})
        out = np.zeros(len(g))
        for a, b in zip(cuts, cuts[1:], strict=False):
            out[a:b] = self.rate * g[a:b].sum() / (h[a:b].sum() + self.ridge)
        return out

    def fit(self, x: np.ndarray, y: np.ndarray) -> Additive:
        self.edges, self.base = edges_of(x, self.bins), prior(y)
        self.coarse = edges_of(x, self.pair_bins)
        b, c = binned(x, self.edges), binned(x, self.coarse)
        self.tables = np.zeros((x.shape[1], self.bins + 1))
        self.chosen: list[tuple[int, int]] = []
        width = self.pair_bins + 1
        self.pair_tables = np.zeros((0, width * width))
        self.learned = bool(len(y)) and y.min() != y.max()
        if not self.learned:
            return self
        z = np.full(len(y), self.base)
        for _ in range(self.rounds):
            for j in range(x.shape[1]):
                p = sigmoid(z)
                step = self._tree(np.bincount(b[:, j], y - p, self.bins + 1), np.bincount(b[:, j], np.maximum(p * (1 - p), 1e-6), self.bins + 1))
                self.tables[j] += step
                z += step[b[:, j]]
        gains = []
        p = sigmoid(z)
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        for j in range(x.shape[1]):
            for k in range(j):
                at = c[:, j] * width + c[:, k]
                gs, hs = (np.bincount(at, v, width * width).reshape(width, width).cumsum(0).cumsum(1) for v in (g, h))
                quads = [(s, s[-1:, :] - s, s[:, -1:] - s, s[-1, -1] - s[-1:, :] - s[:, -1:] + s) for s in (gs, hs)]
                gains.append((float(max((sum(q**2 / (r + self.ridge) for q, r in zip(*quads, strict=True))).max(), 0)), j, k))
        self.chosen = [(j, k) for _, j, k in sorted(gains, reverse=True)[: self.pairs]]
        self.pair_tables = np.zeros((len(self.chosen), width * width))
        for _ in range(self.pair_rounds):
            for i, (j, k) in enumerate(self.chosen):
                p = sigmoid(z)
                at = c[:, j] * width + c[:, k]
                gs, hs = (np.bincount(at, v, width * width).reshape(width, width) for v in (y - p, np.maximum(p * (1 - p), 1e-6)))
                r, s = self._cut(gs.sum(1), hs.sum(1))[1], self._cut(gs.sum(0), hs.sum(0))[1]
                step = np.zeros((width, width))
                for rows in (slice(0, r), slice(r, None)):
                    for cols in (slice(0, s), slice(s, None)):
                        step[rows, cols] = self.rate * gs[rows, cols].sum() / (hs[rows, cols].sum() + self.ridge)
                self.pair_tables[i] += step.reshape(-1)
                z += step.reshape(-1)[at]
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        b, c, z = binned(x, self.edges), binned(x, self.coarse), np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            z += t[b[:, j]]
        for (j, k), t in zip(self.chosen, self.pair_tables, strict=True):
            z += t[c[:, j] * (self.pair_bins + 1) + c[:, k]]
        return z

"""Gradient-boosted trees for a few classes, in numpy: histograms of binned columns, softmax loss, trees of fixed depth."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Settings:
    rounds: int = 40
    depth: int = 3
    rate: float = 0.25
    bins: int = 32
    ridge: float = 1.0
    least_weight: float = 1.0


@dataclass
class Trees:
    """``column`` and ``cut`` of every inner node (heap order) and ``leaf`` values of trees of one depth, class by class."""

    edges: list[np.ndarray]
    base: np.ndarray
    column: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    temperature: float = 1.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        codes = binned(x, self.edges)
        out = np.tile(self.base, (len(x), 1))
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[-1]))
        for by_class, cuts, leaves in zip(self.column, self.cut, self.leaf, strict=True):
            for k in range(len(self.base)):
                node = np.zeros(len(x), np.int64)
                for _ in range(depth):
                    node = 2 * node + 1 + (codes[rows, by_class[k][node]] > cuts[k][node])
                out[:, k] += leaves[k][node - (2**depth - 1)]
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return softmax(self.scores(x) / self.temperature)


def softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1).astype(np.int64)


def fit(x: np.ndarray, y: np.ndarray, classes: int, weight: np.ndarray | None = None, s: Settings = Settings()) -> Trees:  # noqa: B008
    """Trees fitted to rows ``x`` of classes ``y``; classes without rows get a low, constant score."""
    n, p = x.shape
    weight = np.ones(n) if weight is None else weight
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, s.bins + 1)[1:-1])) for j in range(p)]
    codes = binned(x, edges)
    flat = codes + np.arange(p) * s.bins
    target = np.eye(classes)[y]
    base = np.log(np.maximum((target * weight[:, None]).sum(0), 0.5) / max(weight.sum(), 1))
    score, inner = np.tile(base, (n, 1)), 2**s.depth - 1
    column, cut, leaf = np.zeros((s.rounds, classes, inner), np.int64), np.full((s.rounds, classes, inner), s.bins, np.int64), np.zeros((s.rounds, classes, inner + 1))
    for r in range(s.rounds):
        prob = softmax(score)
        for k in range(classes):
            g, h = (prob[:, k] - target[:, k]) * weight, np.maximum(prob[:, k] * (1 - prob[:, k]), 1e-6) * weight
            node = np.zeros(n, np.int64)
            for level in range(s.depth):
                count, first = 2**level, 2**level - 1
                cell = ((node - first)[:, None] * (p * s.bins) + flat).ravel()
                gs = np.bincount(cell, np.repeat(g, p), count * p * s.bins).reshape(count, p, s.bins).cumsum(2)
                hs = np.bincount(cell, np.repeat(h, p), count * p * s.bins).reshape(count, p, s.bins).cumsum(2)
                gt, ht = gs[:, :, -1:], hs[:, :, -1:]
                gain = gs**2 / (hs + s.ridge) + (gt - gs) ** 2 / (ht - hs + s.ridge) - gt**2 / (ht + s.ridge)
                gain[(hs < s.least_weight) | (ht - hs < s.least_weight)] = 0
                best = gain.reshape(count, -1).argmax(1)
                for i in range(count):
                    if gain[i].flat[best[i]] > 1e-6:
                        column[r, k, first + i], cut[r, k, first + i] = divmod(int(best[i]), s.bins)
                node = 2 * node + 1 + (codes[np.arange(n), column[r, k][node]] > cut[r, k][node])
            at = node - inner
            leaf[r, k] = -s.rate * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + s.ridge)
            score[:, k] += leaf[r, k][at]
    return Trees(edges, base, column, cut, leaf)


def calibrate(trees: Trees, x: np.ndarray, y: np.ndarray) -> Trees:
    """Sets the temperature under which the rows ``x``, of classes ``y`` known for certain, are likeliest."""
    scores, grid = trees.scores(x), np.exp(np.linspace(np.log(0.25), np.log(8), 61))
    loss = [-np.log(np.maximum(softmax(scores / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    trees.temperature = float(grid[int(np.argmin(loss))])
    return trees

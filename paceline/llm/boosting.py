"""Gradient-boosted trees for a yes/no label, on small dense feature tables; and the choice of a calibrated threshold."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Boosted:
    """Trees of depth `depth`, held as feature and cut of each inner node and a value of each leaf."""

    rounds: int = 40
    depth: int = 3
    rate: float = 0.3
    least: int = 5
    base: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base, self.trees = float(np.log(p / (1 - p))), []
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0.02, 0.98, 25))) for j in range(x.shape[1])]
        raw = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-raw))
            g, h = y - p, np.maximum(p * (1 - p), 1e-6)
            feature, cut = np.zeros(2**self.depth - 1, int), np.full(2**self.depth - 1, np.inf)
            node = np.zeros(len(y), int)
            for at in range(2**self.depth - 1):
                own = np.flatnonzero(node == at)
                best = 1e-9
                gs, hs = g[own].sum(), h[own].sum()
                for j, values in enumerate(cuts):
                    for c in values:
                        right = x[own, j] > c
                        n = right.sum()
                        if n < self.least or len(own) - n < self.least:
                            continue
                        gr, hr = g[own][right].sum(), h[own][right].sum()
                        gain = gr**2 / (hr + 1) + (gs - gr) ** 2 / (hs - hr + 1) - gs**2 / (hs + 1)
                        if gain > best:
                            best, feature[at], cut[at] = gain, j, c
                node[own] = 2 * at + 1 + (x[own, feature[at]] > cut[at])
            leaf = node - (2**self.depth - 1)
            n = 2**self.depth
            value = self.rate * np.bincount(leaf, g, n) / (np.bincount(leaf, h, n) + 1)
            self.trees.append((feature, cut, value))
            raw += value[leaf]
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of yes."""
        raw = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            raw += value[node - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-raw))


def threshold(p: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The lowest probability from which on the rows reach this precision; above 1 where none does."""
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last = np.append(p[order][1:] < p[order][:-1], True)  # ties go together
    good = np.flatnonzero((right >= precision) & last)
    return float(p[order][good[-1]]) if len(good) else 2.0

"""Gradient-boosted trees for two classes, small enough to travel with a task."""

from __future__ import annotations

import math
from bisect import bisect_left

import numpy as np

BINS = 32


def cuts_of(values: np.ndarray, weight: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Where values are cut into bins: their quantiles, each value taken ``weight`` times."""
    if not len(values):
        return np.empty(0)
    order = np.argsort(values, kind="stable")
    values, upto = values[order], np.cumsum(weight[order])
    at = np.linspace(0, 1, bins + 1)[1:-1] * max(0.0, upto[-1] - 1)
    low = np.floor(at)
    below, above = (
        values[np.minimum(np.searchsorted(upto, k, side="right"), len(values) - 1)] for k in (low, np.minimum(low + 1, upto[-1] - 1))
    )
    return np.unique(below + (above - below) * (at - low))


class Boosted:
    """Logistic boosting of trees of depth ``depth`` on binned features."""

    def __init__(
        self, x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.3, weight: np.ndarray | None = None
    ) -> None:
        x = np.asarray(x, np.float64)
        y = np.asarray(y, np.float64)
        weight = np.ones(len(y)) if weight is None else np.asarray(weight, np.float64)
        self._set_cuts([cuts_of(col, weight) for col in x.T])
        self._boost(self._bin(x), y * weight, weight, rounds, depth, rate)

    @classmethod
    def of_counts(
        cls, cuts: list[np.ndarray], binned: np.ndarray, right: np.ndarray, weight: np.ndarray, rounds: int = 60, depth: int = 3,
        rate: float = 0.3,
    ) -> Boosted:
        """The model of rows that are counted by their bins: each stands for ``weight`` rows, ``right`` of them of class 1."""
        model = cls.__new__(cls)
        model._set_cuts(cuts)
        model._boost(binned, right, weight, rounds, depth, rate)
        return model

    def _set_cuts(self, cuts: list[np.ndarray]) -> None:
        self.cuts = cuts
        self.cut_lists = [c.tolist() for c in cuts]

    def _boost(self, binned: np.ndarray, right: np.ndarray, weight: np.ndarray, rounds: int, depth: int, rate: float) -> None:
        part = right.sum() / weight.sum() if len(weight) else 0.5
        share = min(max(part, 1e-3), 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        self.trees: list[list[tuple]] = []
        score = np.full(len(weight), self.base)
        for _ in range(rounds if len(weight) and 0 < part < 1 else 0):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(binned, right - weight * p, weight * p * (1 - p), weight, depth, rate)
            self.trees.append(tree)
            score += self._walk(tree, binned)

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, col, side="left") for c, col in zip(self.cuts, x.T)], axis=1)

    def _grow(self, x: np.ndarray, grad: np.ndarray, hess: np.ndarray, weight: np.ndarray, depth: int, rate: float) -> list[tuple]:
        """Nodes in heap order: (feature, cut) inside, (None, value) at leaves."""
        nodes: list[tuple] = [(None, 0.0)] * (2 ** (depth + 1))
        todo = [(1, np.arange(len(grad)), 0)]
        while todo:
            at, rows, level = todo.pop()
            g, h = grad[rows].sum(), hess[rows].sum()
            best = (1e-6, None, 0)
            if level < depth and weight[rows].sum() >= 8:
                for f in range(x.shape[1]):
                    bins = x[rows, f]
                    gs = np.cumsum(np.bincount(bins, grad[rows], BINS + 1))[:-1]
                    hs = np.cumsum(np.bincount(bins, hess[rows], BINS + 1))[:-1]
                    gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], f, k)
            if best[1] is None:
                nodes[at] = (None, rate * g / (h + 1))
                continue
            nodes[at] = (best[1], best[2])
            low = x[rows, best[1]] <= best[2]
            todo += [(2 * at, rows[low], level + 1), (2 * at + 1, rows[~low], level + 1)]
        return nodes

    @staticmethod
    def _walk(tree: list[tuple], x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        todo = [(1, np.arange(len(x)))]
        while todo:
            at, rows = todo.pop()
            feature, value = tree[at]
            if feature is None:
                out[rows] = value
            elif len(rows):
                low = x[rows, feature] <= value
                todo += [(2 * at, rows[low]), (2 * at + 1, rows[~low])]
        return out

    def one(self, row: list[float]) -> float:
        """The probability of a single row, without arrays."""
        bins = [bisect_left(c, v) for c, v in zip(self.cut_lists, row)]
        score = self.base
        for tree in self.trees:
            at = 1
            feature, value = tree[at]
            while feature is not None:
                at = 2 * at + (bins[feature] > value)
                feature, value = tree[at]
            score += value
        return 1 / (1 + math.exp(-score))

    def probability(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, np.float64)
        if not len(x):
            return np.zeros(0)
        binned = self._bin(x)
        score = np.full(len(x), self.base)
        for tree in self.trees:
            score += self._walk(tree, binned)
        return 1 / (1 + np.exp(-score))

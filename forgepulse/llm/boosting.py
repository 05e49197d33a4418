"""Gradient-boosted trees for two classes, small enough to fit on the driver."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Tree:
    """Nodes in level order; a leaf has feature -1."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype=np.int64)
        feature, threshold = np.array(self.feature), np.array(self.threshold)
        left, value = np.array(self.left), np.array(self.value)
        while True:
            inner = feature[at] >= 0
            if not inner.any():
                return value[at]
            rows = np.flatnonzero(inner)
            node = at[rows]
            at[rows] = left[node] + (x[rows, feature[node]] > threshold[node])


@dataclass
class Booster:
    """Logistic loss, Newton leaves, splits at histogram edges; same data, same model."""

    rounds: int = 60
    depth: int = 3
    rate: float = 0.2
    penalty: float = 1.0
    bins: int = 32
    least: float = 1.0
    start: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    slope: float = 1.0
    shift: float = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Booster:
        mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        self.start, self.trees = float(np.log(mean / (1 - mean))), []
        edges = [np.unique(np.quantile(column, np.linspace(0, 1, self.bins + 1)[:-1])) for column in x.T]
        binned = np.stack(
            [np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T, strict=True)], axis=1
        )
        score = np.full(len(x), self.start)
        for _ in range(self.rounds):
            p = _sigmoid(score)
            tree = self._grow(binned, edges, p - y, p * (1 - p))
            self.trees.append(tree)
            score += self.rate * tree.predict(x)
        return self

    def _grow(self, binned, edges, slope, curve) -> Tree:
        tree = Tree()

        def add() -> int:
            for values, empty in ((tree.feature, -1), (tree.threshold, 0.0), (tree.left, 0), (tree.value, 0.0)):
                values.append(empty)
            return len(tree.feature) - 1

        level = [(add(), np.arange(len(slope)))]
        for depth in range(self.depth + 1):
            below = []
            for node, rows in level:
                g, h = slope[rows].sum(), curve[rows].sum()
                tree.value[node] = float(-g / (h + self.penalty))
                best = None if depth == self.depth else self._split(binned, edges, slope, curve, rows, g, h)
                if best is None:
                    continue
                feature, edge = best
                goes_right = binned[rows, feature] > edge
                left, right = add(), add()
                tree.feature[node], tree.left[node] = feature, left
                tree.threshold[node] = float(edges[feature][edge])
                below += [(left, rows[~goes_right]), (right, rows[goes_right])]
            level = below
        return tree

    def _split(self, binned, edges, slope, curve, rows, g, h):
        best, found = 1e-6, None
        whole = g * g / (h + self.penalty)
        for feature, own in enumerate(edges):
            size = len(own) + 1
            left_g = np.cumsum(np.bincount(binned[rows, feature], slope[rows], size))[:-1]
            left_h = np.cumsum(np.bincount(binned[rows, feature], curve[rows], size))[:-1]
            right_g, right_h = g - left_g, h - left_h
            gain = left_g**2 / (left_h + self.penalty) + right_g**2 / (right_h + self.penalty) - whole
            gain[(left_h < self.least) | (right_h < self.least)] = 0
            at = int(np.argmax(gain))
            if gain[at] > best:
                best, found = gain[at], (feature, at)
        return found

    def raw(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.start)
        for tree in self.trees:
            score += self.rate * tree.predict(x)
        return score

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> Booster:
        """Fits a line through the raw scores of rows not fitted on, so that `probability`
        is one."""
        raw, a, b = self.raw(x), 1.0, 0.0
        # Smoothed targets keep the line finite where the classes separate.
        n1, n0 = y.sum(), len(y) - y.sum()
        target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        for _ in range(50):
            p = _sigmoid(a * raw + b)
            d, w = p - target, p * (1 - p) + 1e-9
            gradient = np.array([(d * raw).sum(), d.sum()])
            hessian = np.array([[(w * raw * raw).sum(), (w * raw).sum()], [(w * raw).sum(), w.sum()]])
            step = np.linalg.solve(hessian + 1e-6 * np.eye(2), gradient)
            a, b = a - step[0], b - step[1]
        self.slope, self.shift = float(a), float(b)
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.raw(x) + self.shift)

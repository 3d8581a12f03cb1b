"""A small gradient-boosted tree learner for bounded training samples, and what is read from its trees."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Tree:
    """Nodes by number: feature (-1 at a leaf), threshold (left if value < threshold), children, value."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self) -> int:
        for column, start in ((self.feature, -1), (self.threshold, 0.0), (self.left, -1), (self.right, -1), (self.value, 0.0)):
            column.append(start)
        return len(self.feature) - 1

    def predict(self, x: np.ndarray) -> np.ndarray:
        feature, threshold = np.array(self.feature), np.array(self.threshold)
        left, right, value = np.array(self.left), np.array(self.right), np.array(self.value)
        node = np.zeros(len(x), dtype=int)
        while (inner := np.flatnonzero(feature[node] >= 0)).size:
            at = node[inner]
            node[inner] = np.where(x[inner, feature[at]] < threshold[at], left[at], right[at])
        return value[node]

    def paths(self) -> list[tuple[tuple[int, bool, float], ...]]:
        """The way to every node but the root, as (feature, is below, threshold) conditions."""
        found, open_ = [], [(0, ())]
        while open_:
            node, way = open_.pop()
            if way:
                found.append(way)
            if self.feature[node] >= 0:
                f, t = self.feature[node], self.threshold[node]
                open_ += [(self.left[node], (*way, (f, True, t))), (self.right[node], (*way, (f, False, t)))]
        return found


@dataclass
class Boosted:
    trees: list[Tree]
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += tree.predict(x)
        return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3, leaf: int = 10, ridge: float = 1.0) -> Boosted:
    """Boost trees on logistic loss; splits are looked for at up to 31 quantiles of each feature."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, 33)[1:-1])) for f in range(x.shape[1])]
    bins = np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)], axis=1)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    model = Boosted([], float(np.log(share / (1 - share))))
    margin = np.full(len(x), model.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        tree = _grow(bins, edges, y - p, p * (1 - p), depth, leaf, ridge, rate)
        if len(tree.feature) == 1:
            break
        model.trees.append(tree)
        margin += tree.predict(x)
    return model


def _grow(bins, edges, gradient, curvature, depth, leaf, ridge, rate) -> Tree:
    tree = Tree()
    open_ = [(tree.add(), np.arange(len(bins)), 0)]
    while open_:
        node, rows, level = open_.pop()
        g, h = gradient[rows].sum(), curvature[rows].sum()
        tree.value[node] = rate * g / (h + ridge)
        best = (1e-6, -1, 0)
        for f, cuts in enumerate(edges if level < depth else ()):
            size = len(cuts) + 1
            b = bins[rows, f]
            left_n = np.cumsum(np.bincount(b, minlength=size))[:-1]
            left_g = np.cumsum(np.bincount(b, gradient[rows], size))[:-1]
            left_h = np.cumsum(np.bincount(b, curvature[rows], size))[:-1]
            gain = left_g**2 / (left_h + ridge) + (g - left_g) ** 2 / (h - left_h + ridge) - g**2 / (h + ridge)
            gain[(left_n < leaf) | (len(rows) - left_n < leaf)] = -1
            if len(gain) and gain.max() > best[0]:
                best = (float(gain.max()), f, int(gain.argmax()))
        if best[1] >= 0:
            _, f, cut = best
            below = bins[rows, f] <= cut
            tree.feature[node], tree.threshold[node] = f, float(edges[f][cut])
            tree.left[node], tree.right[node] = tree.add(), tree.add()
            open_ += [(tree.left[node], rows[below], level + 1), (tree.right[node], rows[~below], level + 1)]
    return tree


def platt(margin: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, steps: int = 50) -> tuple[float, float]:
    """Slope and offset that make 1/(1+exp(-(slope*margin+offset))) a probability (Newton steps, slightly shrunk)."""
    weight = np.ones(len(y)) if weight is None else weight * len(y) / weight.sum()
    design, w = np.stack([margin, np.ones_like(margin)], axis=1), np.array([1.0, 0.0])
    goal = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hess = design.T @ (design * (weight * p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, design.T @ (weight * (goal - p)) - 1e-3 * (w - [1.0, 0.0]))
        w = w + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])

"""Gradient-boosted trees with logistic loss and isotonic calibration, fitted on the driver.

Fitting takes a bounded sample of labelled feature rows; scoring runs in tasks, over arrays or as Spark expressions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass
class Tree:
    """A full binary tree in heap order: node i has children 2i+1 and 2i+2; the last level holds leaves."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        while node[:1].size and node[0] < len(self.feature):
            node = 2 * node + 1 + (x[np.arange(len(x)), self.feature[node]] > self.cut[node])
        return self.leaf[node - len(self.feature)]

    def column(self, features: list[Column], node: int = 0) -> Column:
        inner = len(self.feature)
        if node >= inner:
            return F.lit(float(self.leaf[node - inner]))
        left, right = self.column(features, 2 * node + 1), self.column(features, 2 * node + 2)
        if np.isinf(self.cut[node]):
            return left
        return F.when(features[self.feature[node]] > float(self.cut[node]), right).otherwise(left)


@dataclass
class Boosted:
    """Trees, and the calibration from their sum to a probability; ``base`` alone if nothing could be learned."""

    base: float
    trees: list[Tree] = field(default_factory=list)
    margins: np.ndarray = field(default_factory=lambda: np.zeros(1))
    chances: np.ndarray | None = None

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        for tree in self.trees:
            out += tree.predict(x)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.chances is None:
            return np.full(len(x), self.base)
        return np.interp(self.margin(x), self.margins, self.chances)

    def margin_column(self, features: list[Column]) -> Column:
        total = F.lit(0.0)
        for tree in self.trees:
            total = total + tree.column(features)
        return total

    def chance_column(self, margin: Column) -> Column:
        """The calibrated chance of a margin, by the same straight lines as ``score``."""
        if self.chances is None:
            return F.lit(float(self.base))
        out = F.when(margin <= float(self.margins[0]), float(self.chances[0]))
        for i in range(1, len(self.margins)):
            a, b, p, q = (float(v) for v in (*self.margins[i - 1 : i + 1], *self.chances[i - 1 : i + 1]))
            out = out.when(margin <= b, F.lit(p) + (margin - a) * ((q - p) / (b - a) if b > a else 0.0))
        return out.otherwise(float(self.chances[-1]))


def isotonic(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The rising step function closest to the labels, each by its weight, as the ends and the mean of each step."""
    weights = np.ones(len(labels)) if weights is None else weights
    order = np.argsort(margins, kind="stable")
    steps: list[list[float]] = []  # mean, weight, lowest, highest margin
    for m, y, w in zip(margins[order], labels[order], weights[order], strict=True):
        if steps and steps[-1][3] == m:
            s = steps[-1]
            s[0], s[1] = (s[0] * s[1] + y * w) / (s[1] + w), s[1] + w
        else:
            steps.append([float(y), float(w), m, m])
        while len(steps) > 1 and steps[-2][0] >= steps[-1][0]:
            mean, weight, _, high = steps.pop()
            s = steps[-1]
            s[0], s[1], s[3] = (s[0] * s[1] + mean * weight) / (s[1] + weight), s[1] + weight, high
    # Each step flat from its lowest to its highest margin.
    x = np.array([v for s in steps for v in (s[2], s[3])])
    return x, np.array([v for s in steps for v in (s[0], s[0])])


def fit(x: np.ndarray, y: np.ndarray, calibrate: np.ndarray, *, trees: int = 40, depth: int = 3, rate: float = 0.3,
        bins: int = 32, ridge: float = 1.0, totals: tuple[int, int] | None = None) -> Boosted:
    """Trees from the rows where ``calibrate`` is false, calibration from the others.

    ``totals`` are the numbers of rows of label 0 and 1 that the given ones stand for: each class counts by its total in
    the calibration. With rows of one class only, or none, the result is constant: the share of label 1, or 0.
    """
    base = float(y.mean()) if len(y) else 0.0
    if totals and sum(totals):
        base = totals[1] / sum(totals)
    hold = calibrate.astype(bool)
    if any(len(np.unique(y[part])) < 2 for part in (hold, ~hold)):
        return Boosted(base)
    model, n = Boosted(base), int((~hold).sum())
    x_fit, y_fit, total = x[~hold], y[~hold], np.zeros(n)
    cuts = [np.unique(np.quantile(x_fit[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x_fit[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    inner = 2**depth - 1
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-total))
        slope, bend = y_fit - chance, np.maximum(chance * (1 - chance), 1e-6)
        node, feature, cut = np.zeros(n, np.int64), np.zeros(inner, np.int64), np.full(inner, np.inf)
        for at in range(inner):
            rows = np.nonzero(node == at)[0]
            best = 1e-9
            g, h = slope[rows].sum(), bend[rows].sum()
            bound = None
            for j, c in enumerate(cuts):
                if not len(c) or len(rows) < 2:
                    continue
                left_g = np.bincount(binned[rows, j], slope[rows], len(c) + 1).cumsum()[:-1]
                left_h = np.bincount(binned[rows, j], bend[rows], len(c) + 1).cumsum()[:-1]
                gain = left_g**2 / (left_h + ridge) + (g - left_g) ** 2 / (h - left_h + ridge) - g * g / (h + ridge)
                k = int(gain.argmax())
                if gain[k] > best:
                    best, bound = float(gain[k]), (j, k)
            if bound:
                feature[at], cut[at] = bound[0], cuts[bound[0]][bound[1]]
                node[rows] = 2 * at + 1 + (binned[rows, bound[0]] > bound[1])
            else:
                node[rows] = 2 * at + 1
        leaves = node - inner
        leaf = rate * np.bincount(leaves, slope, inner + 1) / (np.bincount(leaves, bend, inner + 1) + ridge)
        model.trees.append(Tree(feature, cut, leaf))
        total += leaf[leaves]
    known = y[hold].astype(int)
    weights = np.array(totals)[known] / np.bincount(known, minlength=2)[known] if totals else None
    model.margins, model.chances = isotonic(model.margin(x[hold]), y[hold].astype(float), weights)
    return model

"""Boosted regression trees on a small training sample, in numpy.

Trees are grown on quantile bins with second-order gains. Features may be marked as
monotonic: +1 (a larger value never lowers the result) or -1.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Tree:
    """Node arrays; a leaf has feature -1. Rows with value <= threshold go left."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for column, x in ((self.feature, -1), (self.threshold, 0.0), (self.left, 0), (self.right, 0), (self.value, value)):
            column.append(x)
        return len(self.value) - 1


@dataclass
class Forest:
    """All trees in flat arrays; each tree's nodes are numbered from its root on."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of the trees' leaves for each row, all trees a level at a time."""
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = self.feature[node]
            down = x[rows, np.maximum(at, 0)] <= self.threshold[node]
            node = np.where(at < 0, node, np.where(down, self.left[node], self.right[node]))
        return self.base + self.value[node].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(x))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def flatten(trees: list[Tree], depth: int, base: float) -> Forest:
    roots = np.cumsum([0, *[len(t.value) for t in trees]])[:-1]
    join = lambda name, kind: np.concatenate([np.asarray(getattr(t, name), dtype=kind) for t in trees] or [np.zeros(0, kind)])
    shift = np.repeat(roots, [len(t.value) for t in trees]) if trees else np.zeros(0, np.int64)
    return Forest(
        join("feature", np.int64), join("threshold", float), join("left", np.int64) + shift,
        join("right", np.int64) + shift, join("value", float), roots.astype(np.int64), depth, base,
    )


def edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0) for f in range(x.shape[1])]


def grow(binned, cuts, grad, hess, rows, depth, monotone, ridge=1.0, least=20.0) -> Tree:
    """One tree for gradients and second derivatives; ``rows`` are the training rows used."""
    tree = Tree()
    step = lambda g, h: -g / (h + ridge)
    gain = lambda g, h: g * g / (h + ridge)

    def split(rows, low, high, level) -> int:
        g, h = grad[rows].sum(), hess[rows].sum()
        node = tree.add(float(np.clip(step(g, h), low, high)))
        if level == depth:
            return node
        best = (1e-6, -1, -1)
        for f, edge in enumerate(cuts):
            if not len(edge):
                continue
            part = binned[rows, f]
            gs = np.cumsum(np.bincount(part, grad[rows], len(edge) + 1))[:-1]
            hs = np.cumsum(np.bincount(part, hess[rows], len(edge) + 1))[:-1]
            ns = np.cumsum(np.bincount(part, minlength=len(edge) + 1))[:-1]
            won = gain(gs, hs) + gain(g - gs, h - hs) - gain(g, h)
            bad = (ns < least) | (len(rows) - ns < least)
            if monotone[f]:
                bad |= (step(g - gs, h - hs) - step(gs, hs)) * monotone[f] < 0
            won = np.where(bad, -np.inf, won)
            k = int(np.argmax(won))
            if won[k] > best[0]:
                best = (float(won[k]), f, k)
        _, f, k = best
        if f < 0:
            return node
        down = binned[rows, f] <= k
        lefts, rights = rows[down], rows[~down]
        bounds = ((low, high), (low, high))
        if monotone[f]:
            middle = np.clip((step(grad[lefts].sum(), hess[lefts].sum()) + step(grad[rights].sum(), hess[rights].sum())) / 2, low, high)
            bounds = ((low, middle), (middle, high)) if monotone[f] > 0 else ((middle, high), (low, middle))
        tree.feature[node], tree.threshold[node] = f, float(cuts[f][k])
        tree.left[node] = split(lefts, *bounds[0], level + 1)
        tree.right[node] = split(rights, *bounds[1], level + 1)
        return node

    split(rows, -np.inf, np.inf, 0)
    return tree


def boost(x, y, monotone, trees=60, depth=3, rate=0.2, bins=64, share=1.0, seed=0, least=20.0) -> tuple[list[Tree], float]:
    """Trees for the log-odds of ``y`` (leaf values hold the rate), and the base log-odds.

    With one class or no rows there are no trees and the base is that class's.
    """
    mean = (float(y.sum()) + 0.5) / (len(y) + 1.0)
    base = float(np.log(mean / (1 - mean)))
    out: list[Tree] = []
    if len(np.unique(y)) < 2:
        return out, base
    cuts = edges(x, bins)
    binned = np.stack([np.searchsorted(cut, x[:, f], side="left") for f, cut in enumerate(cuts)], axis=1)
    draw, margin = np.random.default_rng(seed), np.full(len(y), base)
    for _ in range(trees):
        p = sigmoid(margin)
        rows = np.arange(len(y)) if share >= 1 else np.sort(draw.permutation(len(y))[: max(1, int(share * len(y)))])
        tree = grow(binned, cuts, p - y, p * (1 - p), rows, depth, monotone, least=least)
        tree.value = [rate * v for v in tree.value]
        margin = margin + flatten([tree], depth, 0.0).margin(x)
        out.append(tree)
    return out, base

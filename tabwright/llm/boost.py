"""Gradient-boosted trees by sums over blocks of rows: histogram splits, logistic loss, small depth."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import RDD

from tabwright.llm.linear import fit_logistic, sigmoid


@dataclass
class Boosted:
    """Complete binary trees as arrays: feature and threshold of the inner nodes, leaf values."""

    depth: int = 3
    features: list[np.ndarray] = field(default_factory=list)
    cuts: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)
    start: float = 0.0
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - len(feature)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Calibrated on rows that the trees have not seen."""
        return self.calibrated(self.margin(x))

    def calibrated(self, margin: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * margin + self.offset)


Blocks = Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]]
#: Sums over blocks of rows of what a function gives for some of them.
Total = Callable[[Callable[[Blocks], np.ndarray]], np.ndarray]
#: Sums are of whole multiples of these, so they are the same in any order.
_UNIT, _FINE = 2.0 ** -30, 2.0 ** -24


def total_of(blocks: RDD) -> Total:
    """Sums over a table of blocks, by its partitions."""
    return lambda work: blocks.mapPartitions(lambda some: [work(some)]).treeReduce(np.add)


def binned(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """The bin of each value: how many edges of its feature are below it."""
    return np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)]).astype(np.uint8)


def fit_boosted(x: np.ndarray, y: np.ndarray, *, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0) -> Boosted:
    """Trees from rows in memory."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    block = (binned(x, edges), y, np.ones(len(x)))
    return fit_binned(lambda work: work([block]), edges, trees=trees, depth=depth, rate=rate, bins=bins, ridge=ridge)


def fit_binned(total: Total, edges: Sequence[np.ndarray], *, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0) -> Boosted:
    """Trees from blocks of bins, classes (0 or 1) and weights, of which only sums are needed: one for each level of each tree.
    ``edges``: at most ``bins`` - 1 of each feature, ascending."""
    width, inner = len(edges), 2 ** depth - 1
    weight, hits = total(lambda blocks: sum((np.rint(np.array([w.sum(), (w * y).sum()]) / _UNIT) for _, y, w in blocks), np.zeros(2)))
    share = float(np.clip(hits / weight, 1e-3, 1 - 1e-3))
    model = Boosted(depth, start=float(np.log(share / (1 - share))))
    over_bins = Boosted(depth, start=model.start)  # the same trees, with bins for cuts
    for _ in range(trees):
        feature, bin_, cut = np.zeros(inner, np.int64), np.full(inner, bins), np.full(inner, np.inf)
        leaf = np.zeros(inner + 1)
        for level in range(depth):
            first = 2 ** level - 1
            sums = total(_level_sums(over_bins, feature, bin_, level, width, bins)) * _UNIT
            for i, (g, h) in enumerate(sums.reshape(first + 1, 2, width, bins)):
                at = first + i
                if found := _split(g, h, ridge, edges):
                    feature[at], bin_[at] = found
                    cut[at] = edges[found[0]][found[1]]
                if level == depth - 1:
                    left = [v[feature[at], : bin_[at] + 1].sum() for v in (g, h)]
                    whole = [v[feature[at]].sum() for v in (g, h)]
                    leaf[2 * i: 2 * i + 2] = [-rate * a / (b + ridge) for a, b in (left, (whole[0] - left[0], whole[1] - left[1]))]
        for into, by in ((model, cut), (over_bins, bin_)):
            into.features.append(feature)
            into.cuts.append(by)
            into.leaves.append(leaf)
    return model


def _level_sums(model: Boosted, feature: np.ndarray, bin_: np.ndarray, level: int, width: int, bins: int) -> Callable[[Blocks], np.ndarray]:
    """Gradients and second derivatives for each node of a level of the next tree, feature and bin."""
    def work(blocks: Blocks) -> np.ndarray:
        nodes = 2 ** level
        out = np.zeros((nodes, 2, width * bins))
        for x, y, w in blocks:
            p = sigmoid(model.margin(x))
            g, h = np.rint(w * (p - y) / _UNIT), np.rint(w * np.maximum(p * (1 - p), 1e-6) / _UNIT)
            rows, node = np.arange(len(x)), np.zeros(len(x), np.int64)
            for _ in range(level):
                node = 2 * node + 1 + (x[rows, feature[node]] > bin_[node])
            flat = x + np.arange(width) * bins
            for i in range(nodes):
                mine = np.flatnonzero(node == nodes - 1 + i)
                keys = flat[mine].ravel()
                for k, v in enumerate((g, h)):
                    out[i, k] += np.bincount(keys, np.repeat(v[mine], width), width * bins)
        return out

    return work


def _split(g: np.ndarray, h: np.ndarray, ridge: float, edges: Sequence[np.ndarray]) -> tuple[int, int] | None:
    """The feature and the place of the edge of the greatest gain, if there is one. The sums are of each feature and bin."""
    left_g, left_h = np.cumsum(g, axis=1), np.cumsum(h, axis=1)
    all_g, all_h = left_g[:, -1:], left_h[:, -1:]
    gain = left_g ** 2 / (left_h + ridge) + (all_g - left_g) ** 2 / (all_h - left_h + ridge) - all_g ** 2 / (all_h + ridge)
    for j, e in enumerate(edges):
        gain[j, len(e):] = 0
    best = int(gain.argmax())
    j, b = divmod(best, gain.shape[1])
    return (j, b) if gain[j, b] > 1e-6 else None


def calibrate(model: Boosted, x: np.ndarray, y: np.ndarray) -> None:
    """Platt scaling on held-out rows."""
    if len(set(y)) == 2:
        model.slope, model.offset = map(float, fit_logistic(model.margin(x)[:, None], y, penalty=0.1))


def calibrate_by_sums(model: Boosted, total: Total, penalty: float = 0.1, rounds: int = 25) -> None:
    """Platt scaling on blocks of margins, classes and weights, by Newton's method on sums over them."""
    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, list[float]]:
        def work(blocks: Blocks) -> np.ndarray:
            out = np.zeros(8)
            for m, y, weight in blocks:
                z = w[0] * m + w[1]
                p = sigmoid(z)
                d, h = p - y, np.maximum(p * (1 - p), 1e-6)
                terms = np.array([np.logaddexp(0, z) - y * z, d * m, d, h * m * m, h * m, h, y, 1 - y])
                out += np.rint(weight * terms / _FINE).sum(1)
            return out

        loss, dm, d, hmm, hm, h, *classes = total(work) * _FINE
        ridge = np.array([penalty, 1e-6])
        return loss + (ridge * w * w).sum() / 2, np.array([dm, d]) + ridge * w, np.array([[hmm, hm], [hm, h]]) + np.diag(ridge), classes

    w = np.zeros(2)
    value, gradient, hessian, classes = at(w)
    if min(classes) <= 0:
        return
    for _ in range(rounds):
        step = np.linalg.solve(hessian, gradient)
        while (after := at(w - step))[0] > value and np.abs(step).max() > 1e-6:
            step = step / 2  # a full step can overshoot
        if after[0] > value:
            break
        w, (value, gradient, hessian, _) = w - step, after
        if np.abs(step).max() < 1e-6:
            break
    model.slope, model.offset = map(float, w)

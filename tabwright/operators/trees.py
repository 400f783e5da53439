"""Exact classification trees and forests of any depth.

Every threshold between two neighbouring values of a feature is a candidate. Nodes of more than ``piece`` draws are split
in rounds over the whole table: rows are counted by (node, feature, value) and class, running sums of the counts
give the classes on both sides of each candidate, and the best gain per node is one aggregate. A node of at most
``piece`` draws is finished in one step, with all nodes below it, in one task; its rows move once.

A row's draws in a tree come from the md5 of its key and the seed, the features a node looks at from its
place in the tree: the result is the same for any partitioning and any ``piece``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwright.functions.hashing import hash60
from tabwright.session import settle

_NODES = ("tree int, node long, left long, right long, feature int, threshold double, depth int, gain double, "
          "n double, counts array<double>")
#: Nodes of a model that are broadcast at once when it scores, about 30 bytes each.
NODES_AT_ONCE = 8_000_000
#: Rows of a value bucket, where values are many.
_BUCKET_ROWS = 500_000
#: Values of all features that are held as a dictionary; a table with more is stored as numbers.
_DICTIONARY = 1_000_000
#: Rows of a part of a stored table.
_PART_ROWS = 500_000
#: (row, feature) places that are looked at together.
_CELLS = 4_000_000
#: Places of counts that a task holds.
_HELD = 12_000_000
#: Rows of stored blocks that are gone through together.
_BLOCK_ROWS = 65_536


@dataclass(frozen=True)
class TreeParams:
    """``per_split``: features looked at per node, all for None; if none of them has two values there, further ones are.
    ``bins``: in nodes above ``piece``, only so many quantiles of each feature are candidates; None: every threshold.
    ``key``: a unique column that bagging draws from; without one equal rows are drawn together."""

    trees: int = 1
    impurity: str = "gini"
    max_depth: int | None = None
    min_split: int = 2
    min_leaf: int = 1
    per_split: int | str | None = None
    bagging: bool = False
    bins: int | None = None
    piece: int = 200_000
    seed: int = 42
    key: str | None = None

    def looked_at(self, n_features: int) -> int:
        if self.per_split is None:
            return n_features
        return max(1, int(n_features ** 0.5)) if self.per_split == "sqrt" else min(n_features, self.per_split)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix of each number."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def child_places(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The names of the left and right children of nodes so named."""
    with np.errstate(over="ignore"):
        return mixed(place * np.uint64(2) + np.uint64(1)), mixed(place * np.uint64(2) + np.uint64(2))


def root_place(seed: int, tree: int) -> np.uint64:
    with np.errstate(over="ignore"):
        return mixed(np.array([seed % (1 << 64)], np.uint64) * np.uint64(0x2545F4914F6CDD1D) + np.uint64(tree))[0]


def feature_order(place: np.ndarray, n_features: int) -> np.ndarray:
    """For each node the order in which it looks at features."""
    with np.errstate(over="ignore"):
        draws = mixed(place[:, None] ^ mixed(np.arange(1, n_features + 1, dtype=np.uint64)))
    return np.argsort(draws, axis=1, kind="stable")


def draws(hashed: np.ndarray, trees: int) -> np.ndarray:
    """How often each row is drawn in each tree: Poisson with mean 1."""
    shares = np.cumsum(np.exp(-1.0) / np.cumprod(np.append(1, np.arange(1, 12))))
    with np.errstate(over="ignore"):
        u = (mixed(hashed.astype(np.uint64)[:, None] ^ mixed(np.arange(trees, dtype=np.uint64) + np.uint64(1 << 32))) >> np.uint64(11)) / float(1 << 53)
    return np.searchsorted(shares, u, side="right").astype(np.uint8)


def impurity_of(counts: np.ndarray, kind: str) -> np.ndarray:
    """Gini or entropy (in bits) of class counts along the last axis."""
    p = counts / np.maximum(counts.sum(-1, keepdims=True), 1e-300)
    if kind == "gini":
        return 1.0 - (p * p).sum(-1)
    return -(p * np.log2(np.where(p > 0, p, 1.0))).sum(-1)


def between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The middle of two neighbouring values, the lower one where rounding gives the upper one."""
    middle = a / 2 + b / 2
    return np.where(middle < b, middle, a)


def grow(codes: np.ndarray, values: Sequence[np.ndarray], y: np.ndarray, w: np.ndarray, classes: int, params: TreeParams, place: np.uint64, depth: int) -> dict[str, np.ndarray]:
    """All nodes from one node on, whose rows these are (places in the sorted ``values`` of each feature, classes, draws from 1 on):
    local ids from 0, children's ids, feature (-1: leaf), threshold, depth, gain, draws and class counts. All nodes of a level are
    split together, by counts per (node, feature, value). Rows are held in order of their nodes, so that a node's counts lie together."""
    n_features = codes.shape[1]
    look, kind = params.looked_at(n_features), params.impurity
    flat, first_value = np.concatenate(values), np.cumsum([0, *map(len, values)])
    sizes = np.diff(first_value)
    cell_of, drawn = np.ascontiguousarray(codes).ravel(), w.astype(float)
    rows, at, ids, places = np.arange(len(codes)), np.zeros(len(codes), np.int64), np.zeros(1, np.int64), np.array([place], np.uint64)
    n_ids, done = 1, []
    while len(ids):
        a = len(ids)
        counts = np.bincount(at * classes + y[rows], drawn[rows], a * classes).reshape(a, classes)
        total, own = counts.sum(1), impurity_of(counts, kind)
        open_ = (total >= params.min_split) & (counts.max(1) < total) & (params.max_depth is None or depth < params.max_depth)
        best, feature, threshold, low = np.full(a, -np.inf), np.full(a, -1), np.zeros(a), np.zeros(a, np.int64)
        live = open_[at]
        rows, at = rows[live], at[live]
        order = np.zeros((a, n_features), np.int64)
        order[open_] = feature_order(places[open_], n_features)

        def consider(nodes: np.ndarray, looked: np.ndarray, some: np.ndarray, held: np.ndarray) -> None:
            """Hold the best candidate of the nodes against the looked features, in ascending order, a row each. ``some``: the rows of
            the nodes, in order, of which each node holds so many."""
            width = looked.shape[1]
            pair, code, sums = _counted(cell_of, n_features, some, held, looked, sizes, y[some], drawn[some], classes)
            running = np.zeros((classes, len(pair) + 1))
            sums.cumsum(1, out=running[:, 1:])
            same = pair[1:] == pair[:-1]
            begins, cut = np.flatnonzero(np.append(True, ~same)), np.flatnonzero(same)
            of_pair = pair[cut]  # a node has a value of each feature, so no pair is without one
            node = of_pair // width
            left = running[:, 1:].take(cut, 1) - running.take(begins, 1).take(of_pair, 1)
            right = counts[nodes].T.take(node, 1) - left
            n_left, n_right = left.sum(0), right.sum(0)
            if params.min_leaf > 1:
                ok = (n_left >= params.min_leaf) & (n_right >= params.min_leaf)
                cut, of_pair, node, left, right, n_left, n_right = cut[ok], of_pair[ok], node[ok], left[:, ok], right[:, ok], n_left[ok], n_right[ok]
            if not len(cut):
                return
            gain = np.round(own[nodes][node] - (n_left * _impurity_by_class(left, n_left, kind) + n_right * _impurity_by_class(right, n_right, kind)) / total[nodes][node], 12)
            firsts = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
            top = np.maximum.reduceat(gain, firsts)
            hit = np.flatnonzero(gain == np.repeat(top, np.diff(np.append(firsts, len(gain)))))
            hit = hit[np.append(True, node[hit][1:] != node[hit][:-1])]  # the lowest feature, its lowest threshold
            hit = hit[gain[hit] > best[nodes[node[hit]]]]  # later features are higher ones
            of, chosen = nodes[node[hit]], looked.ravel()[of_pair[hit]]
            best[of], feature[of], low[of] = gain[hit], chosen, code[cut[hit]]
            threshold[of] = between(flat[first_value[chosen] + code[cut[hit]]], flat[first_value[chosen] + code[cut[hit] + 1]])

        nodes = np.flatnonzero(open_)
        held = np.bincount(at, minlength=a)
        if len(nodes):
            first = np.sort(order[nodes, :look], axis=1)
            width = max(1, _CELLS // max(1, len(rows)))
            for k in range(0, look, width):
                consider(nodes, first[:, k: k + width], rows, held[nodes])
        for k in range(look, n_features):
            left_over = open_ & (feature < 0)
            nodes = np.flatnonzero(left_over)
            if not len(nodes):
                break
            consider(nodes, order[nodes, k: k + 1], rows[left_over[at]], held[nodes])
        split = feature >= 0
        left_id, right_id = np.full(a, -1), np.full(a, -1)
        left_id[split] = n_ids + 2 * np.arange(split.sum())
        right_id[split] = left_id[split] + 1
        done.append((ids, left_id, right_id, feature, threshold, np.full(a, depth), np.where(split, best, 0.0), total, counts))
        if not split[open_].all():
            keep = split[at]
            rows, at = rows[keep], at[keep]
        goes_left = cell_of.take(rows * n_features + feature.take(at)) <= low.take(at)
        number = np.cumsum(split) - 1
        lefts = np.cumsum(goes_left)  # up to and with each row
        size = held[split]
        ends = np.cumsum(size)
        so_far = np.append(0, lefts[ends - 1]) if len(ends) else np.zeros(1, np.int64)  # before each node
        here = number.take(at)
        # left rows go behind the left rows of their node so far, right rows behind all of its left rows and its right rows so far
        to = np.where(goes_left, lefts - 1 + np.append(0, ends)[:-1].take(here) - so_far[:-1].take(here), np.arange(len(rows)) + so_far[1:].take(here) - lefts) if len(rows) else rows
        moved, sides = np.empty_like(rows), np.empty_like(at)
        moved[to], sides[to] = rows, 2 * here + ~goes_left
        rows, at = moved, sides
        left_place, right_place = child_places(places[split])
        places = np.column_stack([left_place, right_place]).ravel()
        ids = np.column_stack([left_id[split], right_id[split]]).ravel()
        n_ids += len(ids)
        depth += 1
    return dict(zip(("node", "left", "right", "feature", "threshold", "depth", "gain", "n", "counts"), map(np.concatenate, zip(*done))))


def _impurity_by_class(counts: np.ndarray, total: np.ndarray, kind: str) -> np.ndarray:
    """As :func:`impurity_of`, of counts with a row for each class."""
    p = counts / np.maximum(total, 1e-300)
    if kind == "gini":
        return 1.0 - (p * p).sum(0)
    return -(p * np.log2(np.where(p > 0, p, 1.0))).sum(0)


def _counted(cell_of: np.ndarray, n_features: int, rows: np.ndarray, held: np.ndarray, looked: np.ndarray, sizes: np.ndarray, y: np.ndarray, w: np.ndarray, classes: int):
    """Of each present (node, looked feature, value), in order: the pair of node and feature, the value's place, draws with a row for each
    class. ``cell_of``: the places of all values, row by row; ``held``: how many of the rows, which are in order of nodes, are of each node."""
    wide = sizes[looked.ravel()]
    ends = np.cumsum(wide)
    cells = int(ends[-1])
    begins = (ends - wide).reshape(looked.shape)
    place = np.empty((looked.shape[1], len(rows)), np.int64)
    first = rows * n_features
    for j, out in enumerate(place):
        np.add(cell_of.take(first + np.repeat(looked[:, j], held)), np.repeat(begins[:, j], held), out=out)
    if cells * classes <= 4 * place.size + 1_000:
        place += y * cells
        sums = np.bincount(place.ravel(), np.tile(w, len(place)), cells * classes).reshape(classes, cells)
        present = np.flatnonzero(sums.any(0))
        return np.repeat(np.arange(len(wide)), wide).take(present), present - np.repeat(ends - wide, wide).take(present), sums.take(present, 1)
    # few of the values are in the nodes
    place *= classes
    place += y
    place <<= 8
    place |= w.astype(np.int64)  # a row is drawn less than 256 times
    key = place.ravel()
    key.sort()
    place = key >> 8
    cell = place // classes
    begins = np.append(True, cell[1:] != cell[:-1])
    present = cell[begins]
    sums = np.bincount((place - cell * classes) * len(present) + np.cumsum(begins) - 1, key & 255, len(present) * classes).reshape(classes, len(present))
    pair = np.searchsorted(ends, present, side="right")
    return pair, present - (ends - wide)[pair], sums


@dataclass
class _Top:
    """The nodes above the pieces, on the driver: as many as there are pieces."""

    place: list[list[np.uint64]]
    depth: list[list[int]]
    counts: list[list[np.ndarray]]
    left: list[list[int]]
    right: list[list[int]]
    feature: list[list[int]]
    threshold: list[list[float]]
    gain: list[list[float]]

    @classmethod
    def of(cls, seed: int, counts: np.ndarray) -> _Top:
        trees = range(len(counts))
        return cls([[root_place(seed, t)] for t in trees], [[0] for _ in trees], [[counts[t]] for t in trees], [[-1] for _ in trees],
                   [[-1] for _ in trees], [[-1] for _ in trees], [[0.0] for _ in trees], [[0.0] for _ in trees])

    def split(self, t: int, node: int, feature: int, threshold: float, gain: float, left: np.ndarray) -> list[int]:
        first = len(self.place[t])
        sides = [p[0] for p in child_places(np.array([self.place[t][node]], np.uint64))]
        self.left[t][node], self.right[t][node], self.feature[t][node] = first, first + 1, feature
        self.threshold[t][node], self.gain[t][node] = threshold, gain
        for place, counts in zip(sides, (left, self.counts[t][node] - left)):
            self.place[t].append(place)
            self.depth[t].append(self.depth[t][node] + 1)
            self.counts[t].append(counts)
            for part, empty in ((self.left, -1), (self.right, -1), (self.feature, -1), (self.threshold, 0.0), (self.gain, 0.0)):
                part[t].append(empty)
        return [first, first + 1]

    def routes(self) -> list[tuple[np.ndarray, ...]]:
        return [tuple(np.array(part[t]) for part in (self.feature, self.threshold, self.left, self.right)) for t in range(len(self.place))]


def _routed(x: np.ndarray, route: tuple[np.ndarray, ...]) -> np.ndarray:
    """The node each row ends in."""
    feature, threshold, left, right = route
    at, moving = np.zeros(len(x), np.int64), np.arange(len(x))
    while True:
        moving = moving[feature[at[moving]] >= 0]
        if not len(moving):
            return at
        here = at[moving]
        at[moving] = np.where(x[moving, feature[here]] <= threshold[here], left[here], right[here])


@dataclass(frozen=True)
class _Form:
    """How blocks are stored: numbers of type ``kind``, which are places in the sorted ``values`` of each feature or, without these,
    the numbers themselves."""

    width: int
    kind: str
    values: list[np.ndarray] | None

    def coded(self, x: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Places and sorted values of the chosen features of a block."""
        if self.values is not None:
            return x, [self.values[f] for f in columns]
        found = [np.unique(x[:, f], return_inverse=True) for f in range(x.shape[1])]
        return np.column_stack([c for _, c in found]).astype(np.int64), [v for v, _ in found]


def _blocks(batch: pa.RecordBatch, columns: np.ndarray, form: _Form, left_out: int | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The chosen features as stored, classes and draws (a row for each tree) of each block, without the rows of the part that is left out."""
    for n, x, y, w, part in zip(*(batch.column(i).to_pylist() for i in range(5))):
        x, y, w = np.frombuffer(x, form.kind).reshape(n, -1), np.frombuffer(y, np.int32).astype(np.int64), np.frombuffer(w, np.uint8).reshape(-1, n)
        if left_out is not None:
            live = np.frombuffer(part, np.int32) != left_out
            x, y, w = x[live], y[live], w[:, live]
        yield x if len(columns) == form.width else x[:, columns], y, w


def _together(blocks: Iterable[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks joined to ones of about ``_BLOCK_ROWS`` rows, so that a step is on many rows."""
    held: list[tuple[np.ndarray, ...]] = []
    for block in blocks:
        held.append(block)
        if sum(len(b[0]) for b in held) >= _BLOCK_ROWS:
            yield _joined(held)
            held = []
    if held:
        yield _joined(held)


def _joined(blocks: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    x, y, w = zip(*blocks)
    return np.concatenate(x), np.concatenate(y), np.concatenate(w, axis=1)


def _needed(route: tuple[np.ndarray, ...], wanted: np.ndarray) -> np.ndarray:
    """Which nodes lead to a wanted one. Children come after their parents."""
    feature, _, left, right = route
    out = wanted.copy()
    for node in np.flatnonzero(feature >= 0)[::-1]:
        out[node] |= out[left[node]] | out[right[node]]
    return out


def _rows_of_nodes(columns: np.ndarray, route: tuple[np.ndarray, ...], needed: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The rows, in their order, that end in each needed leaf; ``columns``: a row of places for each feature."""
    feature, last, left, right = route
    open_ = [(0, rows)] if needed[0] else []
    while open_:
        node, rows = open_.pop()
        if not len(rows):
            continue
        if feature[node] < 0:
            yield node, rows
            continue
        goes_left = columns[feature[node]].take(rows) <= last[node]
        open_ += [(child, rows.take(np.flatnonzero(side))) for child, side in ((left[node], goes_left), (right[node], ~goes_left)) if needed[child]]


def _numbers(batch: pa.RecordBatch, n_features: int) -> np.ndarray | None:
    """The features of a batch, a row each; None if they are not finite or not of one length."""
    values = batch.column(0).flatten()
    x = values.to_numpy(zero_copy_only=False).astype(np.float64)
    if len(x) != n_features * batch.num_rows or values.null_count or not np.isfinite(x).all():
        return None
    return x.reshape(batch.num_rows, n_features)


def _dictionary(rows: DataFrame, n_features: int) -> list[np.ndarray] | None:
    """The sorted values of each feature; None if they are too many."""
    def distinct(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] | None = [np.zeros(0)] * n_features
        for batch in batches:
            x = _numbers(batch, n_features) if batch.num_rows and found is not None else None
            if x is not None:
                found = [np.union1d(v, x[:, f]) for f, v in enumerate(found)]
                if sum(map(len, found)) > _DICTIONARY:
                    found = None
        f = np.array([-1]) if found is None else np.repeat(np.arange(n_features), [len(v) for v in found])
        yield pa.RecordBatch.from_arrays([pa.array(f, pa.int32()), pa.array(np.zeros(1) if found is None else np.concatenate([np.zeros(0), *found]))], names=["f", "v"])

    found = rows.select("x").mapInArrow(distinct, "f int, v double").distinct().limit(_DICTIONARY + 1).toPandas()
    if len(found) > _DICTIONARY or (found["f"] < 0).any():
        return None
    return [np.sort(found["v"][found["f"] == f].to_numpy(float)) for f in range(n_features)]


def _packed(df: DataFrame, features: Column, label: Column, n_rows: int, n_features: int, classes: int, params: TreeParams, part: Column | None) -> tuple[DataFrame, _Form]:
    """Rows in blocks of a batch: features, class, draws and part, stored. They are dealt out evenly first, as every fit reads
    the blocks with as many tasks, and a table from one file would be one task's work."""
    key = F.col(params.key) if params.key else F.to_json(F.struct(features, label))
    rows = df.select(features.alias("x"), label.cast("double").alias("y"), (hash60(key, params.seed) if params.bagging else F.lit(0).cast("long")).alias("h"),
                     (F.lit(0) if part is None else part).cast("int").alias("p"))
    values = _dictionary(rows, n_features)
    most = max(map(len, values), default=0) if values is not None else 0
    form = _Form(n_features, "f8" if values is None else "u1" if most <= 1 << 8 else "u2" if most <= 1 << 16 else "i4", values)
    shared = df.sparkSession.sparkContext.broadcast(form)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _numbers(batch, n_features)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            if x is None:
                raise ValueError("features must be finite and of one length")
            if not (np.isfinite(y).all() and (y == np.floor(y)).all() and (y >= 0).all() and (y < classes).all()):
                raise ValueError(f"labels must be whole numbers from 0 to {classes - 1}")
            if form.values is not None:
                x = np.column_stack([np.searchsorted(v, x[:, f]) for f, v in enumerate(form.values)] or [np.zeros((len(y), 0))]).astype(form.kind)
            w = draws(batch.column(2).to_numpy(), params.trees) if params.bagging else np.ones((len(y), params.trees), np.uint8)
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(y)], pa.int32()), *(pa.array([b.tobytes()], pa.binary()) for b in (x, y.astype(np.int32), w.T, batch.column(3).to_numpy().astype(np.int32)))],
                names=["n", "x", "y", "w", "p"])

    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-n_rows // _PART_ROWS))
    return settle(rows.repartition(parts).mapInArrow(pack, "n int, x binary, y binary, w binary, p binary")), form


@dataclass(frozen=True)
class TreeTable:
    """A stored table in the form that fits read, to be used for any number of fits with the same draws."""

    packed: DataFrame
    form: _Form
    classes: int
    params: TreeParams

    def fit(self, columns: Sequence[int] | None = None, left_out: int | None = None) -> TreeModel:
        """Fit on all features, or on those at the given places; without the rows of the part ``left_out``."""
        chosen = np.arange(self.form.width) if columns is None else np.array(columns, int)
        return _fit_packed(self.packed, self.form, chosen, self.classes, self.params, left_out)


def fit_trees(df: DataFrame, params: TreeParams = TreeParams(), **names) -> TreeModel:
    """Fit on a vector or array column and a label, as :func:`tree_table` takes them."""
    return tree_table(df, params, **names).fit()


def tree_table(df: DataFrame, params: TreeParams = TreeParams(), *, features: str = "features", label: str = "label", part: str | None = None,
               max_classes: int = 100) -> TreeTable:
    """Features are a vector or array column, labels whole numbers from 0; ``part``: a column of whole numbers, of which fits can leave
    one out. ValueError for nulls and infinities in either, for vectors of several lengths, for more than ``max_classes`` classes,
    and for a table without rows."""
    array = F.col(features) if df.schema[features].dataType.typeName() == "array" else vector_to_array(F.col(features))
    facts = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.col(label).cast("double")).alias("top"), F.max(F.size(array)).alias("width"),
                   F.min(F.col(label).cast("double")).alias("least"), F.count(F.col(label)).alias("known")).first()
    if not facts["n"]:
        raise ValueError("no rows to fit on")
    if facts["known"] < facts["n"] or not 0 <= facts["least"] <= facts["top"] < max_classes:
        raise ValueError(f"labels must be whole numbers from 0 to {max_classes - 1}")
    classes, width = int(facts["top"]) + 1, int(facts["width"])
    packed, form = _packed(df, array, F.col(label), facts["n"], width, classes, params, None if part is None else F.col(part))
    return TreeTable(packed, form, classes, params)


def _fit_packed(packed: DataFrame, form: _Form, columns: np.ndarray, classes: int, params: TreeParams, left_out: int | None) -> TreeModel:
    spark, trees, width = packed.sparkSession, params.trees, len(columns)
    shared_form = spark.sparkContext.broadcast(form)

    def class_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((trees, classes), np.int64)
        rows = 0
        for batch in batches:
            for _, y, w in _blocks(batch, columns, shared_form.value, left_out):
                rows += len(y)
                for c in range(classes):
                    sums[:, c] += w[:, y == c].sum(1, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(trees * classes + 1)), pa.array(np.append(sums.ravel(), rows))], names=["i", "n"])

    sums = {r["i"]: r["n"] for r in packed.mapInArrow(class_counts, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()}
    rows = sums.get(trees * classes, 0)
    if not rows:
        raise ValueError("no rows to fit on")
    top = _Top.of(params.seed, np.array([sums[i] for i in range(trees * classes)], float).reshape(trees, classes))
    pieces: list[tuple[int, int]] = []
    large: list[tuple[int, int]] = []

    def sort_out(t: int, node: int) -> None:
        counts, depth = top.counts[t][node], top.depth[t][node]
        if counts.sum() < params.min_split or counts.max() == counts.sum() or (params.max_depth is not None and depth >= params.max_depth):
            return  # a leaf
        (pieces if counts.sum() <= params.piece else large).append((t, node))

    for t in range(trees):
        sort_out(t, 0)

    def read(blocks: Callable[[Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], _Form], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
        """What a function gives for the blocks of each partition."""
        def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            form = shared_form.value
            yield from blocks((b for batch in batches for b in _blocks(batch, columns, form, left_out)), form)

        return packed.mapInArrow(work, schema)

    edges = _edges(read, rows, columns, form, params) if large else None
    skipped: dict[tuple[int, int], int] = {}  # features already looked at without finding two values
    while large:
        targets, large = large, []
        best = _best_splits(spark, read, top, targets, skipped, edges, columns, classes, params)
        for i, (t, node) in enumerate(targets):
            if i in best:
                feature, threshold, gain, left = best[i]
                for child in top.split(t, node, feature, threshold, gain, left):
                    sort_out(t, child)
            elif skipped.get((t, node), 0) + params.looked_at(width) < width:
                skipped[t, node] = skipped.get((t, node), 0) + (params.looked_at(width) if (t, node) not in skipped else 1)
                large.append((t, node))
    below = _grown(spark, read, top, pieces, columns, form, classes, params)
    began = set(pieces)
    above = [(t, node, top.left[t][node], top.right[t][node], top.feature[t][node], top.threshold[t][node], top.depth[t][node], top.gain[t][node],
              float(top.counts[t][node].sum()), top.counts[t][node].tolist())
             for t in range(trees) for node in range(len(top.place[t])) if (t, node) not in began]
    nodes = spark.createDataFrame(above, _NODES)
    return TreeModel(settle(nodes.unionByName(below) if pieces else nodes), width, classes, trees)


def _edges(read: Callable, rows: int, columns: np.ndarray, form: _Form, params: TreeParams) -> list[np.ndarray]:
    """Quantiles of each feature: the candidates with ``bins``, else the limits of value buckets. Values in a dictionary are counted,
    so that their quantiles are exact."""
    n, width = params.bins or min(1_000, rows // _BUCKET_ROWS), len(columns)
    if n < 2:
        return [np.zeros(0)] * width
    shares = [i / n for i in range(1, n)]

    def counted(blocks: Iterator, form: _Form) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(len(form.values[f]), np.int64) for f in columns]
        for x, _, _ in blocks:
            for f in range(width):
                sums[f] += np.bincount(x[:, f], minlength=len(sums[f]))
        found = [np.flatnonzero(v) for v in sums]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(width), list(map(len, found))), pa.int32()), pa.array(np.concatenate(found), pa.int64()),
                                          pa.array(np.concatenate([v[i] for v, i in zip(sums, found)]), pa.int64())], names=["f", "v", "n"])

    if form.values is not None:
        found = read(counted, "f int, v long, n long").groupBy("f", "v").agg(F.sum("n").alias("n")).toPandas()  # as many rows as the dictionary has
        out = []
        for f, held in enumerate(columns):
            mine = found[found["f"] == f].sort_values("v")
            ends = mine["n"].to_numpy().cumsum()
            at = np.searchsorted(ends, np.ceil(np.array(shares) * ends[-1]))
            out.append(np.unique(form.values[held][mine["v"].to_numpy()[at]]))
        return out

    def values(blocks: Iterator, form: _Form) -> Iterator[pa.RecordBatch]:
        for x, _, _ in blocks:
            yield pa.RecordBatch.from_arrays([pa.array(x[:, f]) for f in range(width)], names=[f"x{f}" for f in range(width)])

    found = read(values, ", ".join(f"x{f} double" for f in range(width))).agg(
        *(F.percentile_approx(f"x{f}", shares, 20 * n).alias(f"x{f}") for f in range(width))).first()
    return [np.unique(np.array(found[f"x{f}"], float)) for f in range(width)]


def _coded_routes(routes: dict[int, tuple[np.ndarray, ...]], values: list[np.ndarray]) -> dict[int, tuple[np.ndarray, ...]]:
    """Routes over places in the values instead of numbers."""
    out = {}
    for t, (feature, threshold, left, right) in routes.items():
        last = np.full(len(feature), -1)
        for f in np.unique(feature[feature >= 0]):
            last[feature == f] = np.searchsorted(values[f], threshold[feature == f], side="right") - 1
        out[t] = (feature, last, left, right)
    return out


def _best_splits(spark: SparkSession, read: Callable, top: _Top, targets: list[tuple[int, int]], skipped: dict, edges: list[np.ndarray], columns: np.ndarray,
                 classes: int, params: TreeParams) -> dict[int, tuple[int, float, float, np.ndarray]]:
    """Place in ``targets`` -> feature, threshold, gain and the classes of the left side. Nodes without a candidate are absent."""
    width = len(columns)
    look = params.looked_at(width)
    grouped: dict[tuple[int, bool], list[tuple[int, int, np.ndarray]]] = {}  # those of a tree that look at equally many features
    for i, (t, node) in enumerate(targets):
        order = feature_order(np.array([top.place[t][node]], np.uint64), width)[0]
        skip = skipped.get((t, node), 0)
        grouped.setdefault((t, bool(skip)), []).append((i, node, order[skip: skip + (1 if skip else look)]))
    routes = top.routes()
    asked: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
    for (t, _), some in grouped.items():
        number = np.full(len(top.place[t]), -1)
        number[[node for _, node, _ in some]] = np.arange(len(some))
        asked.setdefault(t, []).append((np.array([i for i, _, _ in some]), number, np.array([f for _, _, f in some])))
    shared = spark.sparkContext.broadcast(({t: routes[t] for t in asked}, asked, edges))
    binned = params.bins is not None

    def count(blocks: Iterator, form: _Form) -> Iterator[pa.RecordBatch]:
        ways, asked, limits = shared.value
        held: dict[tuple[int, int], np.ndarray] = {}  # counts of the partition, as many as fit
        room = _HELD
        values = None
        # what a group of nodes needs: the nodes that lead to them
        needed = {t: [_needed(ways[t], number >= 0) for _, number, _ in groups] for t, groups in asked.items()}

        def shown(ids: np.ndarray, f: np.ndarray, code: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
            bucket, value = np.zeros(len(f), np.int64), np.zeros(len(f))
            for g in np.unique(f):
                here = f == g
                value[here] = (np.append(limits[g], np.inf) if binned else values[g])[code[here]]
                if not binned:
                    bucket[here] = np.searchsorted(limits[g], value[here])
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in ((ids, pa.int32()), (f, pa.int32()), (bucket, pa.int32()), (value, pa.float64()))]
                + [pa.array(np.ascontiguousarray(sums[:, c])) for c in range(classes)], names=["target", "feature", "bucket", "value", *(f"c{c}" for c in range(classes))])

        for x, y, w in blocks if form.values is None else _together(blocks):
            if values is None or form.values is None:
                codes, values = form.coded(x, columns)
                routes = _coded_routes(ways, values)
                steps = [np.searchsorted(limits[f], values[f]) for f in range(width)] if binned else None
                sizes = np.array([len(limits[f]) + 1 if binned else len(values[f]) for f in range(width)])
            else:
                codes = x
            by_feature = np.ascontiguousarray(codes.T)
            cell = np.empty(by_feature.shape, np.int64)  # of a feature's counts: the place of the value, then the class
            for f in range(width):
                cell[f] = (steps[f].take(by_feature[f]) if binned else by_feature[f]).astype(np.int64) * classes + y
            for t, groups in asked.items():
                drawn, often = np.flatnonzero(w[t] > 0), w[t].astype(float)
                for k, (ids, number, looked) in enumerate(groups):
                    wide = sizes[looked] * classes
                    ends = np.cumsum(wide).reshape(wide.shape)
                    cells = int(ends[-1, -1])
                    if (t, k) not in held and form.values is not None and cells <= room:
                        held[t, k] = np.zeros(cells)
                        room -= cells
                    found = []
                    for node, rows in _rows_of_nodes(by_feature, routes[t], needed[t][k], drawn):
                        j, weight = number[node], often.take(rows)
                        for i, f in enumerate(looked[j].tolist()):
                            place, size = cell[f].take(rows), int(wide[j, i])
                            if (t, k) in held:
                                own = held[t, k][ends[j, i] - size: ends[j, i]]
                                if size > 4 * len(rows):
                                    np.add.at(own, place, weight)
                                else:
                                    own += np.bincount(place, weight, size)
                                continue
                            if size > 4 * len(rows):
                                present, at = np.unique(place // classes, return_inverse=True)
                                sums = np.bincount(at * classes + place % classes, weight, len(present) * classes).reshape(-1, classes)
                            else:
                                sums = np.bincount(place, weight, size).reshape(-1, classes)
                                present = np.flatnonzero(sums.any(1))
                                sums = sums[present]
                            found.append((np.full(len(present), ids[j]), np.full(len(present), f), present, sums))
                    if found:
                        yield shown(*map(np.concatenate, zip(*found)))
        for (t, k), sums in held.items():
            ids, _, looked = asked[t][k]
            wide = sizes[looked.ravel()]
            ends = np.cumsum(wide)
            sums = sums.reshape(-1, classes)
            present = np.flatnonzero(sums.any(1))
            pair = np.searchsorted(ends, present, side="right")
            yield shown(ids[pair // looked.shape[1]], looked.ravel()[pair], present - (ends - wide)[pair], sums[present])

    cs = [f"c{c}" for c in range(classes)]
    counted = read(count, "target int, feature int, bucket int, value double, " + ", ".join(f"{c} double" for c in cs)).groupBy(
        "target", "feature", "bucket", "value").agg(*(F.sum(c).alias(c) for c in cs))
    splits = candidate_splits(counted, ["target"], cs, params.impurity, thresholds_at_values=binned, min_leaf=params.min_leaf)
    rank = F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("threshold")).alias("t"), *(F.col(f"left_{c}") for c in cs))
    found = splits.groupBy("target").agg(F.max(rank).alias("b")).collect()  # one row per node above the pieces
    return {r["target"]: (-r["b"]["f"], -r["b"]["t"], r["b"]["gain"], np.array([r["b"][f"left_{c}"] for c in cs])) for r in found}


def candidate_splits(counted: DataFrame, node: list[str], classes: list[str], impurity: str, *, thresholds_at_values: bool = False,
                     min_leaf: int = 1) -> DataFrame:
    """Node columns, feature, threshold, gain and ``left_<class>`` of every candidate.

    ``counted``: node columns, feature, bucket (ranges of values, in order), value and a count per class, one row per value.
    Sums run within buckets; those of the buckets before are added, so no feature of a node is one task's work.
    """
    key = [*node, "feature"]
    ends = counted.groupBy(*key, "bucket").agg(F.min("value").alias("low"), *(F.sum(c).alias(c) for c in classes))
    row = Window.partitionBy(*key).orderBy("bucket")
    before, everything = row.rowsBetween(Window.unboundedPreceding, -1), row.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = ends.select(*key, "bucket", F.lead("low").over(row).alias("next_low"), *(F.coalesce(F.sum(c).over(before), F.lit(0.0)).alias(f"before_{c}") for c in classes),
                          *(F.sum(c).over(everything).alias(f"all_{c}") for c in classes))
    inner = Window.partitionBy(*key, "bucket").orderBy("value")
    sums = counted.withColumn("next", F.lead("value").over(inner)).withColumns(
        {f"sum_{c}": F.sum(c).over(inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)) for c in classes})
    joined = sums.join(offsets, [*key, "bucket"]).withColumn("next", F.coalesce("next", "next_low")).where("next IS NOT NULL").withColumns(
        {f"left_{c}": F.col(f"sum_{c}") + F.col(f"before_{c}") for c in classes}).withColumns({f"right_{c}": F.col(f"all_{c}") - F.col(f"left_{c}") for c in classes})

    def total(side: str) -> Column:
        return sum((F.col(f"{side}_{c}") for c in classes[1:]), F.col(f"{side}_{classes[0]}"))

    def spread(side: str) -> Column:
        shares = [F.col(f"{side}_{c}") / total(side) for c in classes]
        if impurity == "gini":
            return F.lit(1.0) - sum((p * p for p in shares[1:]), shares[0] * shares[0])
        terms = [F.when(p > 0, p * F.log2(p)).otherwise(0.0) for p in shares]
        return -sum(terms[1:], terms[0])

    gain = spread("all") - (total("left") * spread("left") + total("right") * spread("right")) / total("all")
    middle = F.col("value") / 2 + F.col("next") / 2
    threshold = F.col("value") if thresholds_at_values else F.when(middle < F.col("next"), middle).otherwise(F.col("value"))
    return joined.where((total("left") >= min_leaf) & (total("right") >= min_leaf)).select(
        *key, threshold.alias("threshold"), F.round(gain, 12).alias("gain"), *(f"left_{c}" for c in classes))


def _grown(spark: SparkSession, read: Callable, top: _Top, pieces: list[tuple[int, int]], columns: np.ndarray, form: _Form, classes: int, params: TreeParams) -> DataFrame:
    """All nodes from the roots of the pieces on."""
    by_tree: dict[int, list[tuple[int, int, int]]] = {}
    for t, node in pieces:
        by_tree.setdefault(t, []).append((node, int(top.place[t][node].astype(np.int64)), top.depth[t][node]))
    routes = top.routes()
    shared = spark.sparkContext.broadcast(({t: routes[t] for t in by_tree}, by_tree))
    shared_form = spark.sparkContext.broadcast(form)
    names = [f.split()[0] for f in _NODES.split(", ")]

    def deal(blocks: Iterator, form: _Form) -> Iterator[pa.RecordBatch]:
        ways, wanted = shared.value
        routes = None
        roots = {t: {node: (place, depth) for node, place, depth in nodes} for t, nodes in wanted.items()}
        needed = {t: _needed(ways[t], np.isin(np.arange(len(ways[t][0])), list(nodes))) for t, nodes in roots.items()}
        for x, y, w in blocks if form.values is None else _together(blocks):
            if routes is None or form.values is None:
                codes, values = form.coded(x, columns)
                routes = _coded_routes(ways, values)
            else:
                codes = x
            by_feature, y = np.ascontiguousarray(codes.T), y.astype(np.int32)
            for t, nodes in roots.items():
                out = [(t, node, *nodes[node], x.take(rows, 0).tobytes(), y.take(rows).tobytes(), w[t].take(rows).tobytes())
                       for node, rows in _rows_of_nodes(by_feature, routes[t], needed[t], np.flatnonzero(w[t] > 0))]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(
                        (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names=["tree", "node", "place", "depth", "x", "y", "w"])

    def finish(group: pa.Table) -> pa.Table:
        form = shared_form.value
        joined = [b"".join(group[c].to_pylist()) for c in ("x", "y", "w")]
        x = np.frombuffer(joined[0], form.kind).reshape(-1, len(columns))
        y, w = np.frombuffer(joined[1], np.int32).astype(np.int64), np.frombuffer(joined[2], np.uint8)
        root, place = group["node"][0].as_py(), np.int64(group["place"][0].as_py()).astype(np.uint64)
        found = grow(*form.coded(x, columns), y, w, classes, params, place, group["depth"][0].as_py())
        for c in ("node", "left", "right"):  # the piece's root keeps its id, the others get one of their own
            local = found[c]
            found[c] = np.where(local < 0, -1, np.where(local == 0, root, ((root + 1) << 32) + local))
        n = len(found["node"])
        found["tree"] = np.full(n, group["tree"][0].as_py())
        ends = pa.array(np.arange(n + 1, dtype=np.int32) * classes)
        found["counts"] = pa.ListArray.from_arrays(ends, pa.array(found["counts"].ravel()))
        kinds = {"tree": pa.int32(), "feature": pa.int32(), "depth": pa.int32()}
        return pa.table({c: found[c] if c == "counts" else pa.array(found[c], kinds.get(c)) for c in names})

    dealt = read(deal, "tree int, node long, place long, depth int, x binary, y binary, w binary")
    return dealt.groupBy("tree", "node").applyInArrow(finish, _NODES)


@dataclass
class TreeModel:
    """``nodes``: a table of tree, node (0: root), left, right, feature (-1: leaf), threshold (left side: at most), depth, gain,
    draws and class counts. A row's probabilities are the mean over trees of its leaf's shares."""

    nodes: DataFrame
    n_features: int
    n_classes: int
    n_trees: int
    features_col: str = "features"
    _importances: np.ndarray | None = field(default=None, repr=False)

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 - the name that Spark's models use
        """Each tree's gains weighted by draws, brought to sum 1, averaged over the trees with any split."""
        if self._importances is None:
            found = self.nodes.where("feature >= 0").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("n")).alias("g")).collect()
            sums = np.zeros((self.n_trees, self.n_features))
            for r in found:
                sums[r["tree"], r["feature"]] = r["g"]
            some = sums[sums.sum(1) > 0]
            shares = (some / some.sum(1, keepdims=True)).mean(0) if len(some) else np.zeros(self.n_features)
            self._importances = shares / shares.sum() if shares.sum() else shares
        return DenseVector(self._importances)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``probability`` (vector) and ``prediction`` (the likeliest class, the lowest on a tie)."""
        sizes = {r["tree"]: r["n"] for r in self.nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).collect()}
        groups: list[list[int]] = [[]]
        held = 0
        for t in range(self.n_trees):
            if sizes[t] > NODES_AT_ONCE:
                raise ValueError(f"tree {t} has {sizes[t]} nodes, more than one task holds; limit max_depth")
            if held + sizes[t] > NODES_AT_ONCE:
                groups.append([])
                held = 0
            groups[-1].append(t)
            held += sizes[t]
        array = F.col(self.features_col)
        if df.schema[self.features_col].dataType.typeName() != "array":
            array = vector_to_array(array)
        out, sums = df, None
        for i, some in enumerate(groups):
            if i:
                out = settle(out.withColumn("__sums", sums))  # one group of trees in memory at a time
            found = self._shares(some)(array)
            sums = found if not i else F.zip_with("__sums", found, lambda a, b: a + b)
        whole = out.withColumn("__sums", sums).withColumn("__mean", F.transform("__sums", lambda x: x / float(self.n_trees)))
        return whole.withColumn("probability", array_to_vector("__mean")).withColumn(
            "prediction", (F.array_position("__mean", F.array_max("__mean")) - 1).cast("double")).drop("__sums", "__mean")

    def _shares(self, trees: list[int]):
        def pack(group: pa.Table) -> pa.Table:
            group = group.combine_chunks().sort_by("node")
            column = lambda c: group[c].to_numpy()
            ids = column("node")
            counts = group["counts"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
            parts = (column("feature").astype(np.int32), column("threshold"), np.searchsorted(ids, column("left")).astype(np.int32),
                     np.searchsorted(ids, column("right")).astype(np.int32), counts / counts.sum(1, keepdims=True))
            return pa.table({"tree": group["tree"].slice(0, 1), **{f"p{i}": pa.array([p.tobytes()], pa.binary()) for i, p in enumerate(parts)}})

        chosen = self.nodes if len(trees) == self.n_trees else self.nodes.where(F.col("tree").isin(trees))
        rows = sorted(chosen.groupBy("tree").applyInArrow(pack, "tree int, p0 binary, p1 binary, p2 binary, p3 binary, p4 binary").collect())
        kinds, classes = (np.int32, np.float64, np.int32, np.int32, np.float64), self.n_classes
        shared = self.nodes.sparkSession.sparkContext.broadcast([tuple(bytes(b) for b in r[1:]) for r in rows])  # at most NODES_AT_ONCE nodes

        @F.pandas_udf("array<double>")
        def shares(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            held = [[np.frombuffer(b, k) for b, k in zip(parts, kinds)] for parts in shared.value]
            for batch in batches:
                x = np.array(batch.tolist(), float).reshape(len(batch), -1)
                sums = np.zeros((len(x), classes))
                for feature, threshold, left, right, p in held:
                    sums += p.reshape(-1, classes)[_routed(x, (feature, threshold, left, right))]
                yield pd.Series(list(sums))

        return shares

    def rules(self, depth: int) -> DataFrame:
        """tree, path (the turns from the root, L and R), feature, threshold, gain, n and counts of all nodes down to a depth."""
        shown = ("feature", "threshold", "gain", "n", "counts")
        level = self.nodes.where("node = 0").select("tree", F.lit("").alias("path"), "left", "right", *shown)
        out = level
        for _ in range(depth):
            ways = level.where("feature >= 0").select("tree", F.inline(F.array(*(
                F.struct(F.col(side).alias("node"), F.concat("path", F.lit(turn)).alias("path")) for side, turn in (("left", "L"), ("right", "R"))))))
            level = ways.join(self.nodes, ["tree", "node"]).select("tree", "path", "left", "right", *shown)
            out = out.unionByName(level)
        return out.drop("left", "right")

    def save(self, path: str) -> None:
        """Writes the nodes and, as a table of its own, the sizes."""
        self.nodes.write.parquet(f"{path}/nodes")
        spark = self.nodes.sparkSession
        spark.createDataFrame([(self.n_features, self.n_classes, self.n_trees, self.features_col)], "features int, classes int, trees int, column string").write.json(f"{path}/sizes")

    @classmethod
    def load(cls, spark, path: str) -> TreeModel:
        sizes = spark.read.schema("features int, classes int, trees int, column string").json(f"{path}/sizes").first()
        return cls(spark.read.parquet(f"{path}/nodes"), sizes["features"], sizes["classes"], sizes["trees"], sizes["column"])

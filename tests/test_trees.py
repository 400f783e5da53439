"""Exact trees against plain recursion; forests for any partitioning and any size of pieces."""

import time
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabwright.operators import trees
from tabwright.operators.trees import TreeParams, fit_trees


def rows_of(n, seed=0, values=12, width=4, classes=2):
    draw = np.random.default_rng(seed)
    x = draw.integers(0, values, (n, width)).astype(float) / 4
    y = ((x[:, 0] > 1) ^ (x[:, 1] + draw.normal(size=n) / 4 > 1.5)).astype(int) + (classes > 2) * draw.integers(0, classes - 1, n)
    return x, y


def table(spark, x, y, parts=3):
    rows = [(i, [float(v) for v in a], float(b)) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, features array<double>, label double").repartition(parts)


def impurity(counts, kind):
    p = counts / counts.sum()
    return 1 - (p * p).sum() if kind == "gini" else -sum(q * np.log2(q) for q in p if q > 0)


def plain(x, y, w, classes, params, place, depth=0, path=""):
    """{path: (feature, threshold, gain, counts)} by plain recursion."""
    counts = np.array([w[y == c].sum() for c in range(classes)], float)
    out = {path: (-1, 0.0, 0.0, tuple(counts))}
    if counts.sum() < params.min_split or counts.max() == counts.sum() or (params.max_depth is not None and depth >= params.max_depth):
        return out
    order = trees.feature_order(np.array([place], np.uint64), x.shape[1])[0]
    best = None
    for k, f in enumerate(order):
        if k >= params.looked_at(x.shape[1]) and best is not None:
            break
        values = np.unique(x[w > 0, f])
        for a, b in zip(values, values[1:]):
            inside = x[:, f] <= a
            left = np.array([w[inside & (y == c)].sum() for c in range(classes)], float)
            right = counts - left
            if min(left.sum(), right.sum()) < params.min_leaf:
                continue
            gain = round(impurity(counts, params.impurity) - (left.sum() * impurity(left, params.impurity)
                                                              + right.sum() * impurity(right, params.impurity)) / counts.sum(), 12)
            rank = (gain, -f, -(a + b) / 2)
            if best is None or rank > best:
                best = rank
    if best is None:
        return out
    gain, f, t = best[0], -best[1], -best[2]
    out[path] = (f, t, gain, tuple(counts))
    inside = x[:, f] <= t
    for side, rows, child in zip("LR", (inside, ~inside), trees.child_places(np.array([place], np.uint64))):
        out |= plain(x[rows], y[rows], w[rows], classes, params, child[0], depth + 1, path + side)
    return out


def by_path(model, tree=0):
    nodes = {r["node"]: r for r in model.nodes.where(F.col("tree") == tree).collect()}
    out, todo = {}, [(0, "")]
    while todo:
        i, path = todo.pop()
        r = nodes[i]
        out[path] = (r["feature"], r["threshold"] if r["feature"] >= 0 else 0.0, r["gain"] if r["feature"] >= 0 else 0.0, tuple(r["counts"]))
        if r["feature"] >= 0:
            todo += [(r["left"], path + "L"), (r["right"], path + "R")]
    assert len(out) == len(nodes)
    return out


def same(a, b):
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][0] == b[k][0] and a[k][1] == pytest.approx(b[k][1]) and a[k][2] == pytest.approx(b[k][2], abs=1e-11) and a[k][3] == b[k][3], k


@pytest.mark.parametrize("params", [
    TreeParams(impurity="entropy", min_split=10), TreeParams(max_depth=3, min_leaf=7), TreeParams(piece=40), TreeParams(impurity="entropy", piece=1, max_depth=4),
    TreeParams(per_split="sqrt", piece=60), TreeParams(per_split=1, piece=10_000)])
def test_against_plain_recursion(spark, params):
    for classes in (2, 3):
        x, y = rows_of(250, classes, classes=classes)
        x[:, 3] = 1.0  # a feature without two values
        model = fit_trees(table(spark, x, y), params)
        same(by_path(model), plain(x, y, np.ones(len(y)), classes, params, trees.root_place(params.seed, 0)))


def test_forest_is_one_for_all_partitions_and_pieces(spark):
    x, y = rows_of(400, 5, values=30)
    params = TreeParams(trees=6, per_split="sqrt", bagging=True, key="id")
    first = None
    for parts, piece in ((1, 10_000), (2, 100), (7, 10_000), (7, 25)):
        model = fit_trees(table(spark, x, y, parts), replace(params, piece=piece))
        found = [by_path(model, t) for t in range(6)], model.featureImportances.toArray()
        first = first or found
        for a, b in zip(found[0], first[0]):
            same(a, b)
        assert np.allclose(found[1], first[1])
    assert len({len(t) for t in first[0]}) > 1 and first[1].sum() == pytest.approx(1)


def test_bagging_draws_are_poisson():
    w = trees.draws(np.arange(20_000) * 7_919, 10)
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.03 and abs((w == 0).mean() - np.exp(-1)) < 0.01
    assert abs(np.corrcoef(w[:, 0], w[:, 1])[0, 1]) < 0.03


def test_probabilities_and_predictions(spark, tmp_path, monkeypatch):
    x, y = rows_of(300, 3)
    rows = table(spark, x, y)
    model = fit_trees(rows, TreeParams(trees=5, per_split="sqrt", bagging=True, key="id", min_split=10))
    got = {r["id"]: (r["p"], r["prediction"]) for r in model.transform(rows).select("id", vector_to_array("probability").alias("p"), "prediction").collect()}
    paths = [by_path(model, t) for t in range(5)]
    for i in range(300):
        total = np.zeros(2)
        for nodes in paths:
            path = ""
            while nodes[path][0] >= 0:
                path += "L" if x[i, nodes[path][0]] <= nodes[path][1] else "R"
            total += np.array(nodes[path][3]) / sum(nodes[path][3])
        assert np.allclose(got[i][0], total / 5) and got[i][1] == total.argmax()
    model.save(str(tmp_path / "m"))
    again = trees.TreeModel.load(spark, str(tmp_path / "m"))
    monkeypatch.setattr(trees, "NODES_AT_ONCE", 120)  # several groups of trees
    other = {r["id"]: r["p"] for r in again.transform(rows).select("id", vector_to_array("probability").alias("p")).collect()}
    assert all(np.allclose(other[i], got[i][0]) for i in range(300))


def test_forest_learns_what_one_feature_cannot(spark):
    x, y = rows_of(1_500, 8, values=40)
    model = fit_trees(table(spark, x, y), TreeParams(trees=30, per_split="sqrt", bagging=True, key="id"))
    fresh, truth = rows_of(500, 9, values=40)
    right = model.transform(table(spark, fresh, truth)).where("prediction = label").count()
    assert right > 0.93 * 500
    weights = model.featureImportances.toArray()
    assert weights[:2].min() > 2 * weights[2:].max()


def test_bins_choose_among_quantiles(spark):
    x, y = rows_of(2_000, 4, values=500)
    params = TreeParams(piece=1, max_depth=2, bins=8)
    model = fit_trees(table(spark, x, y), params)
    used = [(f, t) for f, t, _, _ in by_path(model).values() if f >= 0]
    assert used and all(t in x[:, f] for f, t in used)


def test_awkward_tables(spark):
    one = fit_trees(table(spark, np.ones((5, 2)), np.zeros(5, int)))
    assert by_path(one) == {"": (-1, 0.0, 0.0, (5.0,))}
    flat = fit_trees(table(spark, np.ones((6, 2)), np.array([0, 1] * 3)), TreeParams(piece=2))
    assert by_path(flat) == {"": (-1, 0.0, 0.0, (3.0, 3.0))}
    xor = fit_trees(table(spark, np.array([[0, 0], [0, 1], [1, 0], [1, 1]]), np.array([0, 1, 1, 0])))
    assert len(by_path(xor)) == 7  # split although the first gain is none
    with pytest.raises(ValueError, match="no rows"):
        fit_trees(table(spark, np.ones((1, 1)), [0]).where("id < 0"))
    for bad in (-1.0, 1000.0):
        with pytest.raises(ValueError, match="labels"):
            fit_trees(table(spark, np.ones((2, 1)), [0, bad]))
    with pytest.raises(Exception, match="whole numbers"):
        fit_trees(table(spark, np.ones((2, 1)), [0, 0.5])).nodes.count()
    with pytest.raises(Exception, match="finite"):
        fit_trees(table(spark, np.array([[1.0], [np.inf]]), [0, 1])).nodes.count()


def test_a_part_left_out_of_a_stored_table(spark):
    x, y = rows_of(300, 9, values=40)
    rows = table(spark, x, y).withColumn("fold", (F.col("id") % 3).cast("int"))
    for params in (TreeParams(trees=3, per_split="sqrt", bagging=True, key="id"), TreeParams(trees=2, bagging=True, key="id", bins=8, piece=60)):
        stored = trees.tree_table(rows, params, part="fold")
        for fold in (0, 2):
            want = fit_trees(rows.where(F.col("fold") != fold), params)
            for t in range(params.trees):
                same(by_path(stored.fit(left_out=fold), t), by_path(want, t))
    with pytest.raises(ValueError, match="no rows"):
        trees.tree_table(rows.where("fold = 1"), params, part="fold").fit(left_out=1)


def test_tables_of_many_values_give_the_same_trees(spark, monkeypatch):
    x, y = rows_of(300, 11, values=1_000)
    params = TreeParams(trees=2, per_split="sqrt", bagging=True, key="id", piece=90)
    found = [by_path(fit_trees(table(spark, x, y), params), t) for t in range(2)]
    monkeypatch.setattr(trees, "_DICTIONARY", 50)  # stored as numbers
    for t in range(2):
        same(by_path(fit_trees(table(spark, x, y), params), t), found[t])


def test_folds_of_trees_are_left_out_of_one_stored_table(spark, monkeypatch):
    from tabwright.operators import learn

    x, y = rows_of(200, 3)
    rows = table(spark, x, y).withColumn("fold", (F.col("id") % 4).cast("int"))
    params, calls = TreeParams(impurity="entropy", min_split=10), []
    monkeypatch.setattr(learn, "tree_table", lambda *a, **k: calls.append(1) or trees.tree_table(*a, **k), raising=False)
    found = learn.cross_validate(rows, "decision_tree", 4, settings=params).scores
    for fold, score in enumerate(found):
        judged = fit_trees(rows.where(F.col("fold") != fold), params).transform(rows.where(F.col("fold") == fold))
        assert judged.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0] == score
    assert calls == [1]


def test_growing_costs_a_few_passes_of_counting():
    """The time of a whole tree against that of counting its rows' looked features in each level, no more."""
    draw = np.random.default_rng(3)
    sizes = [8_000, 1_500, 300, 900, 1_200, 300, 1_500, 600]
    codes = np.column_stack([draw.integers(0, s, 60_000) for s in sizes]).astype(np.uint16)
    y = (draw.random(60_000) < 0.1 + 0.6 * (codes[:, 3] > 700)).astype(np.int64)
    w, params = draw.integers(1, 4, 60_000).astype(np.uint8), TreeParams(per_split="sqrt", seed=1)
    values = [np.arange(float(s)) for s in sizes]

    def took(job):
        began = time.process_time()
        out = job()
        return time.process_time() - began, out

    grown = [took(lambda: trees.grow(codes, values, y, w, 2, params, trees.root_place(1, 0), 0)) for _ in range(3)]
    found = grown[0][1]
    inner = found["feature"] >= 0
    looked = int(found["n"][inner].sum() / w.mean()) * 2  # (row, looked feature) of all levels
    place, weight = draw.integers(0, 50_000, looked), np.ones(looked)
    counting = min(took(lambda: np.bincount(place, weight, 50_000))[0] for _ in range(3))
    assert min(t for t, _ in grown) < 48 * counting, (min(t for t, _ in grown), counting)


def test_a_table_of_one_part_is_stored_in_as_many_as_there_are_cores(spark):
    held = trees.tree_table(table(spark, *rows_of(400), parts=1), TreeParams())
    assert held.packed.rdd.getNumPartitions() >= 2
    assert sum(r["n"] for r in held.packed.select("n").collect()) == 400


def test_edges_are_exact_quantiles(spark):
    draw = np.random.default_rng(3)
    x = np.column_stack([draw.integers(0, 900, 120_000) ** 2 / 7, draw.integers(0, 3, 120_000)])
    frame = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1].astype(float), "label": (x[:, 0] > 9).astype(float)}))
    table = trees.tree_table(frame.select(F.array("a", "b").alias("features"), "label"), TreeParams(bins=8))
    form = table.form

    def read(blocks, schema):
        return table.packed.mapInArrow(lambda batches: blocks((b for batch in batches for b in trees._blocks(batch, np.array([0, 1]), form, None)), form), schema)

    found = trees._edges(read, len(x), np.array([0, 1]), form, table.params)
    at = np.ceil(np.arange(1, 8) / 8 * len(x)).astype(int) - 1
    assert all((e == np.unique(np.sort(x[:, f])[at])).all() for f, e in enumerate(found))


def test_rows_of_nodes_are_those_that_end_there():
    draw = np.random.default_rng(5)
    columns = draw.integers(0, 9, (3, 500))
    feature, left, right = np.array([0, 1, -1, 2, -1, -1, -1]), np.array([1, 3, -1, 5, -1, -1, -1]), np.array([2, 4, -1, 6, -1, -1, -1])
    route = (feature, np.array([4, 3, 0, 6, 0, 0, 0]), left, right)
    at, rows = trees._routed(columns.T, route), np.flatnonzero(draw.random(500) < 0.6)
    for wanted in ([2], [4, 6], [5], [2, 4, 5, 6], []):
        needed = trees._needed(route, np.isin(np.arange(7), wanted))
        found = dict(trees._rows_of_nodes(columns, route, needed, rows))
        assert sorted(found) == wanted and all((found[n] == rows[at[rows] == n]).all() for n in wanted)

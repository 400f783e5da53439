"""Subtree sums over a forest of parent edges by centroid decomposition.

A component's centroid is its deepest node whose part of the component (itself and all below) weighs at least half
of it. Taking it out leaves the parts of its children and what lies above, none over half the weight. The totals of the
parts below and the centroid's own values are its subtree sum; they are also added to every node on the path from
the centroid up to the component's top, whose weights shrink by what was cut off. The pieces are split again,
so a node is met once per level of a logarithmic number of levels, however deep the forest is.

Components of more than ``piece`` nodes are split by joins, all at once, with a written table a round. The others,
each of bounded size, are finished inside tasks.

A node is named by a chain and its depth, as the prefix of a path is named by one of the paths that go on
from it: a node and its child on the same chain share the name's first part. ``paths`` says which
node a chain has at each depth, so the way up from a centroid is one join and nobody walks edge by edge.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.session import settle

#: Components in the making are broadcast up to this number, beyond it joined by their key.
FEW = 50_000


def finish(parent: np.ndarray, weight: np.ndarray, own: np.ndarray, added: np.ndarray) -> np.ndarray:
    """Subtree sums of whole components in memory.

    ``parent``: places, smaller than the child's, -1 for tops. ``weight``: sums of positive weights over each
    node's part of its component. ``own``: values to be summed, a column each. ``added``: sums of what was cut off below a
    node before.
    """
    n = len(parent)
    weight, out = weight.copy(), added.astype(np.int64)
    levels, top = _levels(parent)
    left = np.ones(n, bool)
    while left.any():
        at = np.flatnonzero(left)
        heavy = at[2 * weight[at] >= weight[top[at]]]  # one path from each top; depth grows with the place
        deepest = np.full(n, -1)
        np.maximum.at(deepest, top[heavy], heavy)
        centre = np.unique(deepest[top[at]])
        is_centre = np.zeros(n, bool)
        is_centre[centre] = True
        old = top.copy()
        for level in levels:  # children of centroids become tops, the others follow their parents
            level = level[left[level]]
            starts = (old[level] == level) | is_centre[parent[level]]
            top[level] = np.where(starts, level, top[parent[level]])
        total = np.zeros(own.shape, np.int64)
        rest = at[~is_centre[at]]
        np.add.at(total, top[rest], own[rest])
        below = rest[(top[rest] == rest) & (old[rest] != rest)]
        cut = own.astype(np.int64)
        np.add.at(cut, parent[below], total[below])
        out[centre] += cut[centre]
        here, of = centre, centre
        while len(here):
            inner = old[here] != here
            here, of = parent[here[inner]], of[inner]
            out[here] += cut[of]
            weight[here] -= weight[of]
        left[centre] = False
    return out


def _levels(parent: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Places by depth below their tops, and the top of each place."""
    depth, top = np.zeros(len(parent), np.int64), np.arange(len(parent))
    for i, p in enumerate(parent.tolist()):
        if p >= 0:
            depth[i], top[i] = depth[p] + 1, top[p]
    order = np.argsort(depth, kind="stable")
    return (np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if len(order) else []), top


def rollup(nodes: DataFrame, paths: Callable[[], DataFrame], values: Sequence[str], *, piece: int = 50_000) -> DataFrame:
    """chain, depth and the sums of ``values`` over each node's subtree, itself included.

    ``nodes``: a stored table of chain, depth (from 0), parent (the chain part of the parent's name, null at depth 0),
    tree (of the node at depth 0), weight (a positive weight summed over the subtree) and the values (long). ``paths``:
    asked only where a tree has more than ``piece`` nodes; chain, depth, owner (the chain part of the name of the node that
    the chain has there) and above (of the node above), for all depths that a chain's own nodes reach.
    """
    own, added = [f"own_{v}" for v in values], [f"added_{v}" for v in values]
    state = nodes.select("chain", "depth", "parent", "weight", F.col("tree").alias("c_chain"), F.lit(0).cast("long").alias("c_depth"),
                         *(F.col(v).cast("long").alias(o) for v, o in zip(values, own)), *(F.lit(0).cast("long").alias(a) for a in added))
    columns, key = state.columns, ["c_chain", "c_depth"]
    ways: DataFrame | None = None
    whole: list[DataFrame] = []
    finished: list[DataFrame] = []
    while True:
        large = settle(state.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("whole")).where(F.col("n") > piece))
        n = large.count()
        few = F.broadcast if n <= FEW else (lambda df: df)
        tagged = state.join(few(large), key, "left") if n else state.withColumn("n", F.lit(None)).withColumn("whole", F.lit(None))
        whole.append(tagged.where("n IS NULL").select(*columns))
        if not n:
            break
        if ways is None:
            ways = settle(paths().select(F.col("chain").alias("p_chain"), F.col("depth").alias("p_depth"), "owner", "above"))
        split = tagged.where("n IS NOT NULL")
        centres = settle(split.where(2 * F.col("weight") >= F.col("whole")).groupBy(*key).agg(
            F.max(F.struct("depth", "chain", "weight")).alias("x")).select(*key, F.col("x.chain").alias("x_chain"), F.col("x.depth").alias("x_depth"),
                                                                          F.col("x.weight").alias("x_weight")))
        met = split.join(few(centres), key)
        below = met.where("depth > x_depth").join(ways, (F.col("chain") == F.col("p_chain")) & (F.col("x_depth") + 1 == F.col("p_depth"))).select(
            *columns, "x_chain", "x_depth", F.when(F.col("above") == F.col("x_chain"), F.col("owner")).alias("child"))
        marked = settle(below.unionByName(met.where("depth <= x_depth").select(*columns, "x_chain", "x_depth", F.lit(None).cast("long").alias("child"))))
        is_centre = (F.col("chain") == F.col("x_chain")) & (F.col("depth") == F.col("x_depth"))
        cuts = settle(marked.where(is_centre | F.col("child").isNotNull()).groupBy(*key).agg(*(F.sum(o).alias(f"cut_{o}") for o in own)).join(centres, key))
        finished.append(marked.where(is_centre).join(few(cuts.drop("x_chain", "x_depth")), key).select(
            "chain", "depth", *((F.col(a) + F.col(f"cut_{o}")).alias(v) for v, o, a in zip(values, own, added))))
        up = few(cuts).join(ways, (F.col("x_chain") == F.col("p_chain")) & (F.col("p_depth") >= F.col("c_depth")) & (F.col("p_depth") < F.col("x_depth"))).select(
            F.col("owner").alias("chain"), F.col("p_depth").alias("depth"), "x_weight", *(f"cut_{o}" for o in own))
        moved = marked.where(~is_centre).join(up, ["chain", "depth"], "left").select(
            "chain", "depth", "parent", (F.col("weight") - F.coalesce("x_weight", F.lit(0))).alias("weight"),
            F.coalesce("child", "c_chain").alias("c_chain"), F.when(F.col("child").isNotNull(), F.col("x_depth") + 1).otherwise(F.col("c_depth")).alias("c_depth"),
            *own, *((F.col(a) + F.coalesce(f"cut_{o}", F.lit(0))).alias(a) for o, a in zip(own, added)))
        state = settle(moved.select(*columns))

    def complete(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= piece:
                rows = pd.concat(held)
                last = (rows["c_chain"] == rows["c_chain"].iloc[-1]) & (rows["c_depth"] == rows["c_depth"].iloc[-1])
                held = [rows[last]]  # its component may go on
                yield summed(rows[~last])
        if held:
            yield summed(pd.concat(held))

    def summed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("depth", kind="stable")
        names = pd.MultiIndex.from_arrays([rows["chain"], rows["depth"]])
        at = names.get_indexer(pd.MultiIndex.from_arrays([rows["parent"].fillna(0).astype("int64"), rows["depth"] - 1]))
        is_top = (rows["chain"] == rows["c_chain"]) & (rows["depth"] == rows["c_depth"])
        sums = finish(np.where(is_top, -1, at), rows["weight"].to_numpy(np.int64), rows[own].to_numpy(np.int64), rows[added].to_numpy(np.int64))
        return pd.DataFrame({"chain": rows["chain"].to_numpy(), "depth": rows["depth"].to_numpy(), **{v: sums[:, i] for i, v in enumerate(values)}})

    out = whole[0]
    for more in whole[1:]:
        out = out.unionByName(more)
    out = out.repartition(*key).sortWithinPartitions(*key).mapInPandas(complete, f"chain long, depth long, {', '.join(f'{v} long' for v in values)}")
    for more in finished:
        out = out.unionByName(more)
    return out

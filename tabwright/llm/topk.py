"""Exact top-k by inner product with a pivot-distance index.

Vectors become integers; the score is their inner product. An extra coordinate sqrt(M^2 - |x|^2)
(M: the greatest norm; 0 for queries) turns it into a distance: d(q, x)^2 = |q|^2 + M^2 - 2 q.x,
so the highest scores are the nearest rows and the triangle inequality holds.

Every row is keyed by its nearest pivot and its distance to it. Range partitioning by that key
and one pass cut each pivot's cell into annuli of at most ``block`` rows. A query's first bound is
its k-th best in its own annulus. Facts of the annuli alone (cell, ends, size) are then held against the queries: an annulus
goes only to those groups of query blocks that have a query whose bound |d(q, p) - r| allows it. There
groups meet shelves of annuli, which are expanded in order of the best score that the bound allows, and the
expansion stops for a query when that is below its k-th best.
Pivots are few and chosen from a bounded sample; they steer the order, never the result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.llm.linear import bounded_sample
from tabwright.session import settle

_BLOCK = ("dim int, cell int, low double, high double, n int, ids binary, rows binary, distances binary, block long")


@dataclass(frozen=True)
class TopK:
    """``pivots`` of at most ``sample`` rows; ``block`` rows of an annulus; ``shelf`` annuli and
    ``queries`` query blocks meet at once, fewer if there are few."""

    k: int = 5
    every: int = 50
    scale: int = 256
    pivots: int = 48
    sample: int = 2_000
    block: int = 512
    shelf: int = 128
    queries: int = 128
    seed: int = 42


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component as a double; null for a vector that takes no part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(finite, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


def _matrix(vectors, exact: bool) -> np.ndarray:
    return np.array(list(vectors), np.float64 if exact else object)


class Pivots:
    """Pivots by dimension. Cell 0 of any dimension has the pivot (0, M)."""

    def __init__(self, sample: list[list[int]], most: int, norm: float):
        self.norm = norm
        by_dim: dict[int, list[list[int]]] = {}
        for v in sorted(sample):
            by_dim.setdefault(len(v), []).append(v)
        self.points: dict[int, np.ndarray] = {}
        for dim, rows in by_dim.items():
            x = np.array(rows, np.float64).reshape(len(rows), dim)
            chosen, gap = [0], ((x - x[0]) ** 2).sum(1)
            while len(chosen) < min(most, len(x)) and gap.max() > 0:  # farthest first
                chosen.append(int(gap.argmax()))
                gap = np.minimum(gap, ((x - x[chosen[-1]]) ** 2).sum(1))
            self.points[dim] = x[chosen]

    def distances(self, x: np.ndarray, query: bool) -> np.ndarray:
        """To every pivot of the dimension, the one at (0, M) first."""
        square = (x ** 2).sum(1)
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.norm ** 2 - square, 0))
        p = self.points.get(x.shape[1], np.zeros((0, x.shape[1])))
        p_square = (p ** 2).sum(1)
        p_last = np.sqrt(np.maximum(self.norm ** 2 - p_square, 0))
        near = square[:, None] + p_square - 2 * x @ p.T + (last[:, None] - p_last) ** 2
        zero = square + (last - self.norm) ** 2
        return np.sqrt(np.maximum(np.hstack([zero[:, None], near]), 0))


def build_index(vectors: DataFrame, settings: TopK = TopK()) -> tuple[DataFrame, Pivots, bool]:
    """vec_id, v (integers) -> stored annuli, the pivots, and whether doubles hold all scores."""
    numbers = vectors.agg(
        F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)).alias("norm"), F.max(F.size("v")).alias("dim"),
        F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))).alias("top")).first()
    norm = float(np.sqrt(numbers["norm"] or 0.0))
    exact = (numbers["top"] or 0.0) ** 2 * max(1, numbers["dim"] or 1) < 2 ** 53
    sample = [list(r["v"]) for r in bounded_sample(vectors, "vec_id", settings.sample, settings.seed).select("v").limit(2 * settings.sample).collect()]
    pivots = Pivots(sample, settings.pivots, norm)
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def key(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["dim"] = [len(v) for v in batch["v"]]
            cell, distance = np.zeros(len(batch), np.int32), np.zeros(len(batch))
            for dim, group in batch.reset_index(drop=True).groupby("dim"):
                all_ = shared.value.distances(np.array(group["v"].tolist(), np.float64).reshape(len(group), dim), False)
                at = all_.argmin(1)
                cell[group.index], distance[group.index] = at, all_[np.arange(len(at)), at]
            yield batch.assign(cell=cell, distance=distance)[["vec_id", "v", "dim", "cell", "distance"]]

    keyed = vectors.mapInPandas(key, "vec_id long, v array<long>, dim int, cell int, distance double")
    ranged = keyed.repartitionByRange("dim", "cell", "distance", "vec_id").sortWithinPartitions("dim", "cell", "distance", "vec_id")
    return settle(_blocks(ranged, settings.block)), pivots, exact


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Runs of sorted rows of one cell, at most ``size`` long, as one row each."""

    def pack(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def packed(frame: pd.DataFrame) -> pd.DataFrame:
            out = []
            for (dim, cell), group in frame.groupby(["dim", "cell"], sort=False):
                for at in range(0, len(group), size):
                    part = group.iloc[at: at + size]
                    r = part["distance"].to_numpy(np.float64)
                    out.append((dim, cell, r.min(), r.max(), len(part), part["vec_id"].to_numpy(np.int64).tobytes(),
                                np.array(part["v"].tolist(), np.int64).tobytes(), r.tobytes()))
            return pd.DataFrame(out, columns=["dim", "cell", "low", "high", "n", "ids", "rows", "distances"])

        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= 8 * size:
                yield packed(pd.concat(held))
                held = []
        if held:
            yield packed(pd.concat(held))

    shape = _BLOCK.removesuffix(", block long")
    return rows.mapInPandas(pack, shape).withColumn("block", F.monotonically_increasing_id())


def _numbers(block, name: str = "rows") -> np.ndarray:
    return np.frombuffer(getattr(block, name), np.int64).reshape(block.n, block.dim)


def _scores(q: np.ndarray, x: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products; beyond the range of doubles in whole numbers, held within a long."""
    if exact:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    whole = q.astype(object).dot(x.T.astype(object)) if q.shape[1] else np.zeros((len(q), len(x)), object)
    return np.clip(whole, -(1 << 63), (1 << 63) - 1).astype(np.int64)


class Best:
    """The k best (score, id) of each query so far: higher scores, then lower ids."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), np.iinfo(np.int64).min)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)
        self.full = np.zeros((n, k), bool)

    def add(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray, valid: np.ndarray) -> None:
        s = np.hstack([self.score[at], score])
        i = np.hstack([self.ids[at], np.broadcast_to(ids, score.shape)])
        f = np.hstack([self.full[at], valid])
        if s.shape[1] > 4 * self.k:  # all that can be among the k best, ties included
            ranked = np.where(f, s, np.iinfo(np.int64).min)
            cut = -np.partition(-ranked.astype(np.float64), self.k - 1, axis=1)[:, self.k - 1]
            keep = (ranked.astype(np.float64) >= cut[:, None]) & f
            some = keep.any(0)
            s, i, f = s[:, some], i[:, some], f[:, some]
        # stable sorts from the last key to the first
        order = np.argsort(i, axis=1, kind="stable")
        s, i, f = (np.take_along_axis(x, order, 1) for x in (s, i, f))
        order = np.argsort(~s, axis=1, kind="stable")
        s, i, f = (np.take_along_axis(x, order, 1) for x in (s, i, f))
        order = np.argsort(~f, axis=1, kind="stable")[:, : self.k]
        for mine, x in ((self.score, s), (self.ids, i), (self.full, f)):
            mine[at, : order.shape[1]] = np.take_along_axis(x, order, 1)

    def floor(self) -> np.ndarray:
        """The score that a row has to reach to matter."""
        return np.where(self.full[:, -1], self.score[:, -1].astype(np.float64), -np.inf)


def _known_bounds(ask) -> np.ndarray:
    """What each query of a block has found already."""
    bound = np.full(ask.n, -np.inf)
    for x in ask.known if ask.known is not None else ():
        bound[x["place"]] = x["bound"]
    return bound


def _best_allowed(q: np.ndarray, pivots: Pivots, annuli: pd.DataFrame) -> np.ndarray:
    """The best score of each query with any row of each annulus that the triangle inequality allows."""
    floats = q.astype(np.float64)
    total = ((floats ** 2).sum(1) + pivots.norm ** 2)[:, None]
    d = pivots.distances(floats, True)[:, annuli["cell"].to_numpy(int)]
    least = np.maximum(0, np.maximum(d - annuli["high"].to_numpy(), annuli["low"].to_numpy() - d))
    return (total - least ** 2) / 2 + 1e-9 * (total + 1) + 1  # room for rounding


def allowed_pairs(index: DataFrame, asking: DataFrame, pivots: Broadcast, shelves: int, groups: int) -> DataFrame:
    """annulus, shelf, part: which annuli a group of query blocks can use, from facts of the annuli; their rows stay where they are."""
    facts = index.select(F.col("block").alias("annulus"), "dim", "cell", "low", "high", F.pmod(F.xxhash64("block"), F.lit(shelves)).cast("int").alias("shelf"),
                         F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"))
    queries = asking.select("part", "dim", "n", "rows", "known", F.explode(F.sequence(F.lit(0), F.lit(shelves - 1))).alias("shelf"))

    def plan(annuli: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        wanted: set[int] = set()
        for ask in asks.itertuples(index=False):
            mine = annuli[annuli["dim"] == ask.dim]
            if len(mine):
                use = (_best_allowed(_numbers(ask), pivots.value, mine) >= _known_bounds(ask)[:, None]).any(0)
                wanted.update(mine["annulus"][use].tolist())
        at = annuli.iloc[0] if len(annuli) else {"shelf": 0, "part": 0}
        return pd.DataFrame({"annulus": sorted(wanted), "shelf": int(at["shelf"]), "part": int(at["part"])})

    return settle(facts.groupBy("shelf", "part").cogroup(queries.groupBy("shelf", "part")).applyInPandas(plan, "annulus long, shelf int, part int"))


def search(vectors: DataFrame, settings: TopK = TopK()) -> DataFrame:
    """query_id, rank, vec_id, score for every row whose vec_id is divisible by ``every``.

    ``vectors``: vec_id, embedding. Rows without an id, and vectors that are null or hold null or
    non-finite components, take no part; a query meets the vectors of its own length. Rows of
    the query's own id are no candidates. Of equal query rows one is asked; query rows of one id
    and different vectors are asked each. Repeated candidates are as many candidates. Fewer than
    k candidates give fewer rows. Components beyond a long stop at its ends.
    """
    whole = settle(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), integers(F.col("embedding"), settings.scale).alias("v"))
                   .where("vec_id IS NOT NULL AND v IS NOT NULL"))
    index, pivots, exact = build_index(whole, settings)
    k, every = settings.k, settings.every
    asked = (whole.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "v"])
             .select("vec_id", "v", F.size("v").alias("dim"), F.lit(0).alias("cell"), F.lit(0.0).alias("distance")))
    queries = settle(_blocks(asked.sortWithinPartitions("dim", "vec_id"), settings.block // 4))
    n_blocks, n_queries = index.count(), queries.count()
    shelves = max(16, -(-n_blocks // settings.shelf))
    groups = max(2, -(-n_queries // settings.queries))

    def first_bound(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for block in batch.itertuples(index=False):
                ids, x = np.frombuffer(block.ids, np.int64), _numbers(block)
                at = np.flatnonzero(ids % every == 0)
                if len(at):
                    best = Best(len(at), k)
                    best.add(np.arange(len(at)), _scores(x[at], x, exact), ids, ids != ids[at][:, None])
                    out += [(int(ids[a]), x[a].tobytes(), f) for a, f in zip(at, best.floor()) if f > -np.inf]
            yield pd.DataFrame(out, columns=["vec_id", "v", "bound"])

    def parted(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([
                (block.block, i, int(q), x.tobytes()) for block in batch.itertuples(index=False)
                for i, (q, x) in enumerate(zip(np.frombuffer(block.ids, np.int64), _numbers(block)))
            ], columns=["block", "place", "q_id", "q_v"])

    bounds = index.select("dim", "n", "ids", "rows").mapInPandas(first_bound, "vec_id long, v binary, bound double").groupBy(
        "vec_id", "v").agg(F.max("bound").alias("bound"))
    places = queries.select("block", "dim", "n", "ids", "rows").mapInPandas(parted, "block long, place int, q_id long, q_v binary")
    known = (places.join(bounds, (F.col("q_id") == F.col("vec_id")) & (F.col("q_v") == F.col("v")))
             .groupBy("block").agg(F.collect_list(F.struct("place", "bound")).alias("known")))  # at most a block's rows
    ready = settle(queries.join(known, "block", "left"))
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)
    asking = ready.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"))
    pairs = allowed_pairs(index, asking, shared, shelves, groups)
    left = index.join(pairs.withColumnRenamed("annulus", "block"), "block").select("dim", "cell", "low", "high", "n", "ids", "rows", "shelf", "part")
    right = asking.join(pairs.select(F.col("shelf").alias("on"), F.col("part").alias("by")).distinct(), F.col("part") == F.col("by")).select(
        "dim", "n", "ids", "rows", "block", "known", "on", "by")

    def meet(annuli: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out = []
        for ask in asking.itertuples(index=False):
            ids, q = np.frombuffer(ask.ids, np.int64), _numbers(ask)
            bound = _known_bounds(ask)
            mine = annuli[annuli["dim"] == ask.dim]
            tops = list(_best_allowed(q, shared.value, mine).T)
            best = Best(len(ids), k)
            for i in sorted(range(len(tops)), key=lambda i: -tops[i].max()):
                need = np.maximum(bound, best.floor())
                at = np.flatnonzero(tops[i] >= need)
                if len(at):
                    ring = mine.iloc[i]
                    ring_ids = np.frombuffer(ring["ids"], np.int64)
                    rows = np.frombuffer(ring["rows"], np.int64).reshape(ring["n"], ring["dim"])
                    best.add(at, _scores(q[at], rows, exact), ring_ids, ring_ids != ids[at][:, None])
            a, b = np.nonzero(best.full & (best.score >= bound[:, None]))
            out.append(pd.DataFrame({"block": ask.block, "place": a, "query_id": ids[a], "vec_id": best.ids[a, b], "score": best.score[a, b]}))
        return pd.concat(out) if out else pd.DataFrame({"block": [], "place": [], "query_id": [], "vec_id": [], "score": []})

    found = left.groupBy("shelf", "part").cogroup(right.groupBy("on", "by")).applyInPandas(
        meet, "block long, place long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("block", "place").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Hard negatives by coordinate pruning in length buckets.

Vectors become integers; the score is their inner product. Rows are kept by label and length
bucket, in blocks of like leading coordinates, and every block carries a sorted list per coordinate
of its rows at unit length. An anchor that needs a score t of a block whose rows are at
most l long needs a cosine of c = t / (|q| l). Rows at that angle or nearer have, in coordinate f, a
value between cos(a + b) and cos(a - b), where a = arccos(q_f) and b = arccos(c). For the anchor's
largest coordinates these ranges are looked up in the sorted lists, the rows inside all of
them are the candidates, and their scores are verified.

Two searches use this. The first finds each anchor's positives, the best rows of its label. The second has a
band of scores per anchor and positive, and finds the best rows of other labels within each band.
Before rows move, facts of a block (lengths, ends of each coordinate) are held against the anchors, and a
block goes only to the groups of anchors that can use it. What an anchor needs starts from its
score with a bounded probe of rows, which steers the search, never the result, and rises as it finds more.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.llm.linear import bounded_sample
from tabwright.llm.topk import Best, _scores, integers
from tabwright.session import settle

_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_FOUND = "ablock long, place int, slot int, vec_id long, score long"


@dataclass(frozen=True)
class Mining:
    """``low`` and ``high``: the band in hundredths of the positive's score. ``ratio``: the shortest to the
    longest row of a length bucket. ``focus``: coordinates looked up. A meeting takes ``shelf`` row blocks of
    at most ``block`` rows and ``group`` anchor blocks of at most ``anchors``, fewer if there are few."""

    positives: int = 5
    negatives: int = 10
    scale: int = 256
    low: int = 30
    high: int = 90
    ratio: float = 0.9
    focus: int = 3
    block: int = 512
    anchors: int = 128
    shelf: int = 256
    group: int = 256
    probe: int = 4_000
    seed: int = 42


def prepared(rows: DataFrame, settings: Mining) -> DataFrame:
    """vec_id, label, v (integers), and what rows are laid out by: dimension, length bucket, leading coordinate."""
    v = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                    integers(F.col("embedding"), settings.scale).alias("v")).where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    size = F.transform("v", lambda x: F.abs(x.cast("double")))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    lead = F.array_position(F.col("__size"), F.array_max("__size")).cast("int")
    bucket = F.when(F.col("norm") > 0, F.floor(F.log("norm") / F.lit(-np.log(settings.ratio)))).otherwise(-1)
    sign = F.when(F.element_at("v", F.col("lead")) < 0, -F.col("lead")).otherwise(F.col("lead"))
    return (v.withColumn("norm", norm).withColumn("__size", size).withColumn("lead", F.coalesce(lead, F.lit(0)))
            .select("vec_id", "label", "v", F.size("v").alias("dim"), bucket.cast("long").alias("bucket"),
                    F.when(F.col("lead") > 0, sign).otherwise(0).alias("lead"), F.coalesce(F.array_max("__size"), F.lit(0.0)).alias("top")))


def _packed(numbers: np.ndarray) -> tuple[int, bytes]:
    """Whole numbers as bytes of the least width."""
    small = not numbers.size or np.abs(numbers.astype(np.float64)).max() < 1 << 15
    return (2, numbers.astype(np.int16).tobytes()) if small else (8, numbers.astype(np.int64).tobytes())


def _rows(block) -> np.ndarray:
    return np.frombuffer(block.rows, np.int16 if block.width == 2 else np.int64).reshape(block.n, block.dim).astype(np.int64)


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows at length 1 (those of length 0 stay), and the lengths."""
    norm = np.sqrt((x.astype(np.float64) ** 2).sum(1))
    return x / np.where(norm > 0, norm, 1)[:, None], norm


def _cut(rows: DataFrame, size: int, keys: list[str]) -> DataFrame:
    """Runs of rows that agree in ``keys``, at most ``size`` long, as one row each with its facts."""

    def pack(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def packed(frame: pd.DataFrame) -> pd.DataFrame:
            out = []
            for _, run in frame.groupby(keys, sort=False):
                for at in range(0, len(run), size):
                    part = run.iloc[at: at + size]
                    x = np.array(part["v"].tolist(), np.int64).reshape(len(part), int(part["dim"].iloc[0]))
                    unit, norm = _unit(x)
                    width, data = _packed(x)
                    ends = x if len(x) else np.zeros((1, x.shape[1]))
                    out.append((x.shape[1], int(part["label"].iloc[0]), len(x), part["vec_id"].to_numpy(np.int64).tobytes(), width, data,
                                unit.argsort(0, kind="stable").astype(np.int16).tobytes(), norm.min(), norm.max(),
                                np.concatenate([ends.min(0), ends.max(0)]).astype(np.float64).tobytes()))
            return pd.DataFrame(out, columns=["dim", "label", "n", "ids", "width", "rows", "lists", "short", "long", "ends"])

        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= 8 * size:
                yield packed(pd.concat(held))
                held = []
        if held:
            yield packed(pd.concat(held))

    return rows.select("vec_id", "label", "v", "dim", *(k for k in keys if k not in ("dim", "label"))).mapInPandas(
        pack, "dim int, label long, n int, ids binary, width int, rows binary, lists binary, short double, long double, ends binary")


def feasible(unit: np.ndarray, cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of each coordinate of unit vectors whose cosine with the rows of ``unit`` is at least ``cosine``."""
    a = np.arccos(np.clip(unit, -1, 1))
    b = np.arccos(np.clip(cosine, -1, 1))[:, None]
    return np.cos(np.minimum(np.pi, a + b)) - 1e-9, np.cos(np.maximum(0, a - b)) + 1e-9


def candidates(unit: np.ndarray, norm: np.ndarray, need: np.ndarray, x: np.ndarray, lists: np.ndarray, short: float, long: float,
               focus: int) -> np.ndarray:
    """Which rows of a block (second axis) an anchor (first axis) has to verify."""
    mask = np.ones((len(unit), len(x)), bool)
    if not len(x) or not short or not unit.shape[1]:
        return mask  # rows of length 0 have no angle
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(norm > 0, need / (norm * np.where(need > 0, long, short)), -1) - 1e-9
    mask[cosine > 1 + 1e-6] = False
    asked = np.flatnonzero((cosine > -1) & (cosine <= 1 + 1e-6))
    if not len(asked):
        return mask
    low, high = feasible(unit[asked], cosine[asked])
    chosen = np.argsort(-np.abs(unit[asked]), axis=1, kind="stable")[:, :focus]
    for f in np.unique(chosen):
        users = np.flatnonzero((chosen == f).any(1))
        values = x[lists[:, f], f]
        first, last = values.searchsorted(low[users, f], "left"), values.searchsorted(high[users, f], "right")
        for i, a, b in zip(asked[users], first, last):
            mask[i, lists[:a, f]] = False
            mask[i, lists[b:, f]] = False
    return mask


def _bounds(q: np.ndarray, norm: np.ndarray, ends: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of each anchor with any row of each block, with room for rounding."""
    dim = q.shape[1]
    low, high = ends[:, :dim], ends[:, dim:]
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    whole = norm[:, None] * long
    room = 1 + 1e-9 * whole
    return np.maximum(up @ low.T + down @ high.T, -whole) - room, np.minimum(up @ high.T + down @ low.T, whole) + room


def _band(ask) -> tuple[np.ndarray, np.ndarray]:
    return (np.frombuffer(b, np.int64).reshape(ask.n, -1) for b in (ask.need, ask.cap))


def _search(asks: DataFrame, index: DataFrame, k: int, same: bool, exact: bool, settings: Mining) -> DataFrame:
    """The best k rows of each band of each anchor: ablock, place, slot, vec_id, score, rank.

    ``asks``: anchor blocks with ``need`` and ``cap``, whole numbers by anchor and slot. ``same``: rows of the
    anchor's label, else of all others.
    """
    n_blocks, n_asks = index.count(), asks.count()
    shelves = max(16, -(-n_blocks // settings.shelf))
    groups = max(2, -(-n_asks // settings.group))
    placed = asks.withColumn("group", F.pmod(F.xxhash64("ablock"), F.lit(groups)).cast("int"))
    facts = index.select("block", "dim", "label", "long", "ends", F.pmod(F.xxhash64("block"), F.lit(shelves)).cast("int").alias("shelf"),
                         F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    parts = placed.select("group", "dim", "label", "n", "width", "rows", "need", "cap",
                          F.explode(F.sequence(F.lit(0), F.lit(shelves - 1))).alias("shelf"))

    def plan(blocks: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        wanted: set[int] = set()
        for dim, here in blocks.groupby("dim"):
            ends = np.array([np.frombuffer(e, np.float64) for e in here["ends"]]).reshape(len(here), 2 * dim)
            for ask in asking[asking["dim"] == dim].itertuples(index=False):
                q = _rows(ask).astype(np.float64)
                least, most = _bounds(q, np.sqrt((q ** 2).sum(1)), ends, here["long"].to_numpy())
                need, cap = _band(ask)
                use = ((most >= need.min(1)[:, None]) & (least <= cap.max(1)[:, None])).any(0)
                wanted.update(here["block"][use & ((here["label"] == ask.label) == same)].tolist())
        at = blocks[["shelf", "group"]].iloc[0] if len(blocks) else {"shelf": 0, "group": 0}
        return pd.DataFrame({"block": sorted(wanted), "shelf": int(at["shelf"]), "group": int(at["group"])})

    pairs = settle(facts.groupBy("shelf", "group").cogroup(parts.groupBy("shelf", "group")).applyInPandas(
        plan, "block long, shelf int, group int"))
    rows = index.join(pairs, "block")
    asked = placed.join(pairs.select(F.col("group").alias("of"), F.col("shelf").alias("on")).distinct(), F.col("group") == F.col("of"))

    def meet(blocks: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out = []
        for dim, here in blocks.groupby("dim"):
            here = list(here.itertuples(index=False))
            ends = np.array([np.frombuffer(b.ends, np.float64) for b in here]).reshape(len(here), 2 * dim)
            long, label = np.array([b.long for b in here]), np.array([b.label for b in here])
            for ask in asking[asking["dim"] == dim].itertuples(index=False):
                ids, q = np.frombuffer(ask.ids, np.int64), _rows(ask)
                unit, norm = _unit(q)
                least, most = _bounds(q.astype(np.float64), norm, ends, long)
                need, cap = _band(ask)
                best = [Best(len(ids), k) for _ in range(need.shape[1])]
                lowest, highest = need.min(1).astype(np.float64), cap.max(1)
                for j in np.argsort(-most.max(0), kind="stable"):
                    if (label[j] == ask.label) != same:
                        continue
                    at = np.flatnonzero((most[:, j] >= lowest) & (least[:, j] <= highest))
                    if not len(at):
                        continue
                    block = here[j]
                    x = _rows(block)
                    lists = np.frombuffer(block.lists, np.int16).reshape(block.n, dim)
                    mask = candidates(unit[at], norm[at], lowest[at], _unit(x)[0], lists, block.short, block.long, settings.focus)
                    row_ids = np.frombuffer(block.ids, np.int64)
                    mask &= row_ids != ids[at][:, None]
                    some = np.flatnonzero(mask.any(0))
                    if not len(some):
                        continue
                    score, mask, row_ids = _scores(q[at], x[some], exact), mask[:, some], row_ids[some]
                    for s, found in enumerate(best):
                        inside = mask & (score >= need[at, s][:, None]) & (score <= cap[at, s][:, None])
                        hit = np.flatnonzero(inside.any(1))
                        if len(hit):
                            found.add(at[hit], score[hit], row_ids, inside[hit])
                    lowest = np.min([np.maximum(need[:, s], found.floor()) for s, found in enumerate(best)], axis=0)
                for s, found in enumerate(best):
                    a, b = np.nonzero(found.full)
                    out.append(pd.DataFrame({"ablock": ask.ablock, "place": a, "slot": s, "vec_id": found.ids[a, b], "score": found.score[a, b]}))
        return pd.concat(out) if out else pd.DataFrame({c.split()[0]: [] for c in _FOUND.split(", ")})

    found = rows.groupBy("shelf", "group").cogroup(asked.groupBy("on", "of")).applyInPandas(meet, _FOUND)
    rank = F.row_number().over(Window.partitionBy("ablock", "place", "slot").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _probed(asks: DataFrame, probe: tuple, k: int, same: bool, exact: bool) -> DataFrame:
    """Raises ``need`` to the k-th best score of each band among the probe's rows, where doubles hold all scores."""
    if not exact:
        return asks
    shared = asks.sparkSession.sparkContext.broadcast(probe)

    def work(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, labels, by_dim = shared.value
        for batch in batches:
            needs = []
            for ask in batch.itertuples(index=False):
                need, cap = (b.copy() for b in _band(ask))
                at, x = by_dim.get(ask.dim, (np.zeros(0, int), None))
                ok = (labels[at] == ask.label) == same
                if ok.sum() >= k:
                    score = _scores(_rows(ask), x[ok], exact)
                    other = ids[at][ok] != np.frombuffer(ask.ids, np.int64)[:, None]
                    for s in range(need.shape[1]):
                        kept = np.where(other & (score <= cap[:, s][:, None]), score, _LEAST)
                        need[:, s] = np.maximum(need[:, s], np.partition(kept, -k, axis=1)[:, -k])
                needs.append(need.tobytes())
            yield batch.assign(need=needs)

    return asks.mapInPandas(work, asks.schema)


def hard_negatives(rows: DataFrame, is_anchor: Column, settings: Mining = Mining()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``: vec_id, embedding, label; ``is_anchor``: a condition on vec_id and label. Rows without an id or a label, and
    vectors that are null or hold null or non-finite components, take no part; vectors meet those of
    their own length. Rows of the anchor's own id are neither positives nor negatives. Of equal anchor rows
    one is asked; anchor rows of one id that differ are asked each. Repeated rows count as often as they
    stand. Ties go to the lower id. An anchor without positives, and a positive without negatives in its
    band, give no row; a negative positive score has an empty band. Components beyond a long stop at its ends.
    """
    whole = settle(prepared(rows, settings))
    numbers = whole.agg(F.max("dim").alias("dim"), F.max("top").alias("top")).first()
    exact = (numbers["top"] or 0.0) ** 2 * max(1, numbers["dim"] or 1) < 2 ** 53
    order = ["dim", "label", "bucket", "lead", "top", "vec_id"]
    index = settle(_cut(whole.repartitionByRange(*order).sortWithinPartitions(*order), settings.block, ["dim", "label", "bucket"])
                   .withColumn("block", F.monotonically_increasing_id()))
    chosen = whole.where(is_anchor).dropDuplicates(["vec_id", "label", "v"])
    asks = settle(_cut(chosen.repartitionByRange("dim", "label", "lead", "vec_id").sortWithinPartitions("dim", "label", "lead", "vec_id"),
                       settings.anchors, ["dim", "label"]).drop("lists", "ends", "short", "long").withColumn("ablock", F.monotonically_increasing_id()))
    sample = bounded_sample(whole, "vec_id", settings.probe, settings.seed).select("vec_id", "label", "dim", "v").limit(2 * settings.probe).toPandas()
    probe = (sample["vec_id"].to_numpy(np.int64), sample["label"].to_numpy(np.int64),
             {int(d): (at, np.array(sample["v"].iloc[at].tolist(), np.int64).reshape(len(at), int(d)))
              for d, at in sample.groupby("dim").indices.items()})

    wide = asks.withColumn("need", F.lit(None).cast("binary")).withColumn("cap", F.lit(None).cast("binary")).schema

    def all_scores(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(need=[np.full(n, _LEAST).tobytes() for n in batch["n"]], cap=[np.full(n, _MOST).tobytes() for n in batch["n"]])

    first = settle(_probed(asks.mapInPandas(all_scores, wide), probe, settings.positives, True, exact))
    positives = settle(_search(first, index, settings.positives, True, exact, settings).select(
        "ablock", "place", (F.col("rank") - 1).cast("int").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))

    def banded(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            needs, caps = [], []
            for n, known in zip(batch["n"], batch["known"]):
                need, cap = np.full((n, settings.positives), _MOST), np.full((n, settings.positives), _LEAST)
                for x in known if known is not None else ():
                    s = int(x["positive_score"])
                    need[x["place"], x["slot"]] = -(-settings.low * s // 100)
                    cap[x["place"], x["slot"]] = settings.high * s // 100
                needs.append(need.tobytes())
                caps.append(cap.tobytes())
            yield batch.drop(columns="known").assign(need=needs, cap=caps)

    known = positives.groupBy("ablock").agg(F.collect_list(F.struct("place", "slot", "positive_score")).alias("known"))  # of one block's anchors
    second = settle(_probed(asks.join(known, "ablock", "left").select(*asks.columns, "known").mapInPandas(banded, wide), probe, settings.negatives, False, exact))
    negatives = _search(second, index, settings.negatives, False, exact, settings)
    ids = asks.select("ablock", "n", "ids").mapInPandas(
        lambda batches: (pd.DataFrame([(b.ablock, i, int(a)) for b in batch.itertuples(index=False) for i, a in enumerate(np.frombuffer(b.ids, np.int64))],
                                      columns=["ablock", "place", "anchor_id"]) for batch in batches), "ablock long, place int, anchor_id long")
    return negatives.join(positives, ["ablock", "place", "slot"]).join(ids, ["ablock", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def negatives_report(embeddings: DataFrame, settings: Mining = Mining()) -> DataFrame:
    """The operator on anchors whose id is divisible by 100. Every seventh row first gets the next label, as rows
    of one id do with all their copies."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(embeddings.select("vec_id", "embedding", moved.alias("label")), F.col("vec_id") % 100 == 0, settings)

"""Mixing sources to target weights by fitting each source's budget as a subset sum.

1. Sizes are summed by (source, exact size): the length table, one row per source and length.
2. Targets share ``share`` times all words by weight; a source stops at ``most`` times its own
   size and its excess is shared again by weight (water filling). The driver sees the sum of the
   open sources only.
3. Whole copies of a source come first. What is left of its target is a subset-sum problem over
   its length counts: very long documents are chosen by a programme over their reachable sums, an even share
   is taken of every other length, then single documents while they fit, and the last words are fitted
   exactly by a bounded-knapsack dynamic programme.
4. Documents are chosen by the order of a seeded hash within their (source, length). The cut is
   found on hash buckets, so only the documents of the one bucket that holds it are ranked.

No task holds the rows of a source: a source's group is its length table, whose size is bounded by
its number of distinct lengths.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.hashing import hash60, unit_interval
from tabwright.llm.words import fresh
from tabwright.session import settle

#: ``[^\x20\x09-\x0D]+``, the words that make a size.
SIZE_PATTERN = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """``weights`` repeat over the sources in code-point order, null last. ``share``: words to take
    per word there is. ``most``: most copies of a source. ``window``: words that the dynamic
    programme fits. ``sums``: reachable sums of long documents that are kept at least. ``bucket``: documents of one
    length that are ranked together."""

    weights: tuple[float, ...] = (3.0, 1.0, 2.0)
    share: float = 1.5
    most: int = 2
    window: int = 32_768
    sums: int = 20_000
    bucket: int = 2_048
    seed: int = 42


def size_of(text: Column) -> Column:
    """Number of words between spaces; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(SIZE_PATTERN)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, settings: Mix = Mix()) -> DataFrame:
    """source, total -> source, total, target (double).

    Sources are ranked by a range partitioning and the partitions' row counts, so a table of
    many sources passes through no single task.
    """
    key = F.coalesce(F.col("source"), F.lit("")).cast("binary")
    placed = settle(
        sources.repartitionByRange(F.col("source").isNull(), key)
        .withColumn("part", F.spark_partition_id())
    )
    order = Window.partitionBy("part").orderBy(F.col("source").isNull(), key)
    sizes = sorted((r["part"], r["count"]) for r in placed.groupBy("part").count().collect())
    before, seen = {}, 0
    for part, n in sizes:
        before[part], seen = seen, seen + n
    if not seen:
        return sources.withColumn("target", F.lit(0.0))
    offset = F.element_at(F.create_map(*(F.lit(x) for pair in before.items() for x in pair)), F.col("part"))
    index = F.row_number().over(order) - 1 + offset
    weight = F.element_at(F.array(*map(F.lit, settings.weights)), (F.pmod(index, F.lit(len(settings.weights))) + 1).cast("int"))
    weighed = settle(placed.select("source", "total", weight.alias("weight"),
                                   (F.col("total") * settings.most).cast("double").alias("cap")))
    # caps only ever fill up, so the level rises to a fixed point; each round is one small sum
    budget = float(weighed.agg(F.sum("total")).first()[0] or 0) * settings.share
    level = 0.0
    while True:
        full = F.col("cap") <= F.col("weight") * F.lit(level)
        row = weighed.agg(F.sum(F.when(full, F.col("cap"))).alias("used"),
                          F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if not row["open"]:
            break
        rising = (budget - (row["used"] or 0.0)) / row["open"]
        if rising <= level:
            break
        level = rising
    return weighed.select("source", "total", F.least("cap", F.col("weight") * F.lit(level)).alias("target"))


def fit_lengths(length: np.ndarray, count: np.ndarray, budget: int, window: int, most_sums: int = 20_000) -> np.ndarray:
    """How many documents of each length to take so that their words come to ``budget`` exactly or
    as near to it as the lengths allow. Lengths are positive and distinct.

    The programme fits the last ``window`` words. Lengths over half of that are chosen before, by a programme over
    the set of their reachable sums, for what the others can fill up."""
    taken = np.zeros(len(length), np.int64)
    total = int((length * count).sum())
    if budget >= total:
        return count.copy()
    if budget <= 0:
        return taken
    wide = length > window // 2
    others = int((length * count)[~wide].sum())
    if wide.any():
        taken[wide] = _long(length[wide], count[wide], budget, others, most_sums)
    left = budget - int((length * taken).sum())
    if left <= 0:
        return taken
    # an even share of all others that leaves room for the programme
    share = min(max(0, left - window // 2), others)
    for i in np.flatnonzero(~wide).tolist() if others else []:
        taken[i] = int(count[i]) * share // others
    left = budget - int((length * taken).sum())
    # the longest of them first while more is left than the programme fits
    for room in (window // 2, 0):
        for i in np.flatnonzero(~wide)[np.argsort(-length[~wide], kind="stable")].tolist():
            if left <= window:
                break
            more = min(int(count[i] - taken[i]), (left - room) // int(length[i]))
            if more > 0:
                taken[i] += more
                left -= more * int(length[i])
    return taken + _knapsack(np.where(wide, 2 * window + 1, length), count - taken, min(left, window))


#: Documents of one length, and lengths, that the sums of long documents are made of; what is beyond goes in proportion.
_OPEN, _LENGTHS = 8, 64


def _long(length: np.ndarray, count: np.ndarray, budget: int, others: int, most_sums: int) -> np.ndarray:
    """Long documents whose words leave of ``budget`` what ``others`` words can fill, or come nearest to that; among
    such sums the one nearest to the long documents' share. All documents above their proportion less
    a few are open. Sums are kept exactly while there are at most ``most_sums``; of more, the least of each of so many
    equal ranges, so that the sum found misses the best by little more than a range a step."""
    total = int((length * count).sum()) + others
    even, carried = np.zeros(len(length), np.int64), 0
    for i in range(len(length) - 1, -1, -1):  # in proportion; what rounding leaves goes to the next shorter length
        ideal = int(count[i]) * int(length[i]) * budget // total + carried
        even[i] = min(ideal // int(length[i]), int(count[i]))
        carried = ideal - int(even[i] * length[i])
    base = np.maximum(0, even - _OPEN // 2)
    free = np.minimum(count - base, _OPEN)
    if len(length) > _LENGTHS:  # a spread of lengths stays open, the others keep their proportion
        shut = np.ones(len(length), bool)
        shut[np.linspace(0, len(length) - 1, _LENGTHS).astype(int)] = False
        base[shut] = even[shut]
        free[shut] = 0
    fixed = int((length * base).sum())
    top = 2 * budget
    sums, steps = np.array([fixed], np.int64), []
    for i in np.flatnonzero(free).tolist():
        left, size = int(free[i]), 1
        while left:
            size = min(size, left)
            steps.append((i, size, sums))
            more = np.union1d(sums, sums + size * int(length[i]))
            more = more[more <= max(top, fixed)]
            if len(more) > most_sums:
                more = more[np.unique((more - more[0]) * most_sums // (more[-1] - more[0] + 1), return_index=True)[1]]
            sums, left, size = more, left - size, size * 2
    miss = np.maximum(np.maximum(sums - budget, budget - others - sums), 0)
    share = (total - others) * budget // total
    at = int(sums[np.lexsort((sums, np.abs(sums - share), miss))[0]])
    taken = base
    for i, size, before in reversed(steps):
        if before[min(np.searchsorted(before, at), len(before) - 1)] != at:
            taken[i] += size
            at -= size * int(length[i])
    return taken


def _knapsack(length: np.ndarray, count: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack over reachable sums, as bit sets: the sum nearest to ``budget``, the lower of
    two. A sum beyond twice the budget is further off than none at all."""
    taken = np.zeros(len(length), np.int64)
    usable = np.flatnonzero((length <= 2 * budget) & (count > 0))
    full = (1 << (2 * budget + 1)) - 1
    sums, steps = 1, []
    for i in usable.tolist():
        left, size = min(int(count[i]), 2 * budget // int(length[i])), 1
        while left:
            size = min(size, left)
            steps.append((i, size, sums))
            sums |= (sums << (size * int(length[i]))) & full
            left -= size
            size *= 2
        if sums >> budget & 1:
            break
    at = (sums & ((1 << (budget + 1)) - 1)).bit_length() - 1
    above = sums >> budget
    over = (above & -above).bit_length() - 1
    if above and over < budget - at:
        at = budget + over
    for i, size, before in reversed(steps):
        if not before >> at & 1:
            taken[i] += size
            at -= size * int(length[i])
    return taken


def mix(docs: DataFrame, *, text: str = "text", source: str = "source", id_column: str = "doc_id",
        settings: Mix = Mix()) -> tuple[DataFrame, tuple[str, str, str, str]]:
    """The documents without their text, and four more columns, whose names are returned: size,
    the source's size, the source's target and the words taken of the document.

    Null texts have size 0 and give no words. A null source is a source of its own, the last one.
    The choice among documents of one source and size follows a seeded hash of the id, so
    reruns agree; equal rows take each other's place. An empty table gives no rows.
    """
    names = fresh(docs, "size", "source_size", "target", "taken")
    rest = [c for c in docs.columns if c != text]
    sized = settle(docs.select(
        *(F.col(c).alias(f"c{i}") for i, c in enumerate(rest)), F.col(source).cast("string").alias("source"),
        size_of(F.col(text)).alias("size"), hash60(F.coalesce(F.col(id_column).cast("string"), F.lit("null")), settings.seed).alias("order")))
    lengths = settle(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    sources = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("total"))
    targets = settle(source_targets(sources, settings))
    window = settings.window

    def plan(group: pd.DataFrame) -> pd.DataFrame:
        total, target = int(group["total"].iloc[0]), float(group["target"].iloc[0])
        copies = int(target // total) if total else 0
        length, count = group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64)
        more, some = np.zeros(len(length), np.int64), length > 0
        if some.any():
            order = np.argsort(length[some], kind="stable")
            fitted = np.zeros(int(some.sum()), np.int64)
            fitted[order] = fit_lengths(length[some][order], count[some][order], round(target) - copies * total, window, settings.sums)
            more[some] = fitted
        return group.assign(copies=copies, extra=more)[["source", "size", "n", "total", "target", "copies", "extra"]]

    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    planned = settle(
        lengths.join(targets, same(lengths, targets)).drop(targets["source"])
        .groupBy("source").applyInPandas(
            plan, "source string, size long, n long, total long, target double, copies long, extra long")
    )
    buckets = F.ceil(F.col("n") / settings.bucket)
    known = sized.join(planned.withColumnsRenamed({"source": "p_source", "size": "p_size"}),
                       F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size"))).drop(
        "p_source", "p_size").withColumn("bucket", F.floor(unit_interval(F.col("order")) * buckets))
    # where a length is taken in part: the bucket that the cut falls in, and what it gives
    part = (F.col("extra") > 0) & (F.col("extra") < F.col("n"))
    counted = known.where(part).groupBy("source", "size", "bucket", "extra").agg(F.count(F.lit(1)).alias("in_bucket"))
    running = F.sum("in_bucket").over(Window.partitionBy("source", "size").orderBy("bucket"))
    cuts = settle(
        counted.withColumn("upto", running)
        .where((F.col("upto") >= F.col("extra")) & (F.col("upto") - F.col("in_bucket") < F.col("extra")))
        .select(F.col("source").alias("k_source"), F.col("size").alias("k_size"), F.col("bucket").alias("cut"),
                (F.col("extra") - F.col("upto") + F.col("in_bucket")).alias("of_cut"))
    )
    cut = known.join(cuts, F.col("source").eqNullSafe(F.col("k_source")) & (F.col("size") == F.col("k_size")), "left").drop(
        "k_source", "k_size")
    shown = [F.col(f"c{i}").alias(c) for i, c in enumerate(rest)]

    def result(rows: DataFrame, chosen: Column) -> DataFrame:
        taken = F.col("size") * (F.col("copies") + F.when(chosen, 1).otherwise(0))
        return rows.select(*shown, F.col("size").alias(names[0]), F.col("total").alias(names[1]),
                           F.col("target").alias(names[2]), taken.alias(names[3]))

    at_cut = F.coalesce(F.col("bucket") == F.col("cut"), F.lit(False))
    rank = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("order"))
    plain = result(cut.where(~at_cut), F.when(F.col("cut").isNull(), F.col("extra") > 0).otherwise(F.col("bucket") < F.col("cut")))
    ranked = result(cut.where(at_cut).withColumn("rank", rank), F.col("rank") <= F.col("of_cut"))
    return plain.unionByName(ranked), names


def mix_report(docs: DataFrame, settings: Mix = Mix()) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken."""
    mixed, names = mix(docs.select("doc_id", "source", "text"), settings=settings)
    return mixed.select("doc_id", *(F.col(n).alias(a) for n, a in zip(names, ("size", "source_size", "target", "taken"))))


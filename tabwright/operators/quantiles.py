"""Exact quantiles of any number of columns.

Exact percentiles of a frequency table need every distinct value in one place, which is
right for columns with few values and wrong for a long column of doubles. So columns with
few distinct values are counted by value, and for the others an open interval around each wanted rank is
narrowed by approximate quantiles and exact counts until few values are left inside.
Each round is one aggregate over all open intervals; only its one row is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ACCURACY = 2_000
_FEW_VALUES = 100_000
_FETCH_LIMIT = 20_000


@dataclass
class _Rank:
    """A wanted rank: its value lies strictly between ``low`` and ``high``."""

    column: str
    rank: int
    inside: int
    distinct: int
    below: int = 0
    low: float | None = None
    high: float | None = None
    value: float | None = None

    def test(self) -> Column:
        x = F.col(self.column)
        test = x.isNotNull()
        if self.low is not None:
            test = test & (x > F.lit(self.low))
        if self.high is not None:
            test = test & (x < F.lit(self.high))
        return test

    def share(self, step: float) -> float:
        return min(1.0, max(0.0, (self.rank - self.below) / max(1, self.inside - 1) + step))


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    shares: Sequence[float],
    few_values: int = _FEW_VALUES,
    fetch_limit: int = _FETCH_LIMIT,
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of the non-null, non-NaN values per column."""
    if not columns:
        return {}
    numbers = df.select(
        *(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(f"c{i}")
          for i, c in enumerate(columns))
    )
    names = [f"c{i}" for i in range(len(columns))]
    facts = numbers.agg(
        *(F.struct(F.count(c).alias("n"), F.approx_count_distinct(c).alias("d")).alias(c)
          for c in names)
    ).first()

    result: dict[str, list[float | None]] = {c: [None] * len(shares) for c in names}
    few = [c for c in names if facts[c]["n"] and facts[c]["d"] <= few_values]
    if few:
        # each distinct value is one row by then, about few_values per column
        counted = numbers.unpivot([], few, "c", "v").filter(F.col("v").isNotNull()).groupBy("c", "v").count()
        found = counted.groupBy("c").agg(F.percentile("v", list(shares), F.col("count")).alias("q"))
        for row in found.collect():
            result[row["c"]] = list(row["q"])

    many = [c for c in names if facts[c]["n"] and facts[c]["d"] > few_values]
    ranks: dict[tuple[str, int], _Rank] = {}
    for c in many:
        n = facts[c]["n"]
        for p in shares:
            for rank in (math.floor((n - 1) * p), math.ceil((n - 1) * p)):
                ranks[c, rank] = _Rank(c, rank, n, facts[c]["d"])
    _resolve(numbers, list(ranks.values()), fetch_limit)
    for c in many:
        n = facts[c]["n"]
        for i, p in enumerate(shares):
            position = (n - 1) * p
            a = ranks[c, math.floor(position)].value
            b = ranks[c, math.ceil(position)].value
            part = position - math.floor(position)
            # weighted like Spark's percentile, so that infinities give the same on either path
            result[c][i] = a if a == b or part == 0 else (1 - part) * a + part * b
    return {column: result[name] for column, name in zip(columns, names)}


def exact_medians(df: DataFrame, columns: Sequence[str], **options) -> dict[str, float | None]:
    """Median per column, the mean of the two middle values for an even count."""
    return {c: q[0] for c, q in exact_quantiles(df, columns, [0.5], **options).items()}


def _resolve(numbers: DataFrame, ranks: list[_Rank], fetch_limit: int) -> None:
    while wide := [r for r in ranks if r.value is None and r.distinct > fetch_limit]:
        _narrow(numbers, wide)

    rest = [r for r in ranks if r.value is None]
    if not rest:
        return
    # about fetch_limit distinct values per rank at most, however many rows hold them
    held = F.array_compact(F.array(
        *(F.when(r.test(), F.struct(F.lit(i).alias("i"), F.col(r.column).alias("v")))
          for i, r in enumerate(rest))
    ))
    inside = numbers.filter(reduce(lambda a, b: a | b, (r.test() for r in rest)))
    counted = inside.select(F.explode(held).alias("x")).groupBy("x.i", "x.v").count()
    values: dict[int, list] = {i: [] for i in range(len(rest))}
    for row in counted.collect():
        values[row["i"]].append((row["v"], row["count"]))
    for i, r in enumerate(rest):
        index = r.rank - r.below
        for value, count in sorted(values[i]):
            if index < count:
                r.value = value
                break
            index -= count


def _narrow(numbers: DataFrame, ranks: list[_Rank]) -> None:
    """Shrink each interval to a few times ``1 / accuracy`` of its rows."""
    margin = 2.0 / _ACCURACY
    # ranks of a column that still share an interval share one sketch
    shared: dict[tuple, list[_Rank]] = {}
    for r in ranks:
        shared.setdefault((r.column, r.low, r.high), []).append(r)
    sketched = numbers.agg(
        *(F.percentile_approx(
            F.when(group[0].test(), F.col(group[0].column)),
            [r.share(step) for r in group for step in (-margin, margin)], _ACCURACY,
        ).alias(f"g{i}") for i, group in enumerate(shared.values()))
    ).first()
    guesses: dict[int, tuple[float, float]] = {}
    for i, group in enumerate(shared.values()):
        for j, r in enumerate(group):
            guesses[id(r)] = (sketched[f"g{i}"][2 * j], sketched[f"g{i}"][2 * j + 1])
    measures = []
    for i, r in enumerate(ranks):
        x = F.col(r.column)
        low, high = guesses[id(r)]
        between = r.test() & (x > low) & (x < high)
        measures.append(F.struct(
            F.count_if(x < low).alias("below"),
            F.count_if(x == low).alias("at_low"),
            F.count_if(between).alias("inside"),
            F.count_if(x == high).alias("at_high"),
            F.approx_count_distinct(F.when(between, x)).alias("distinct"),
        ).alias(f"m{i}"))
    measured = numbers.agg(*measures).first()
    for i, r in enumerate(ranks):
        low, high = guesses[id(r)]
        m = measured[f"m{i}"]
        first_inside = m["below"] + m["at_low"]
        if r.rank < m["below"]:
            r.high, r.inside = low, m["below"] - r.below
        elif r.rank < first_inside:
            r.value = low
        elif r.rank < first_inside + m["inside"]:
            r.low, r.high, r.below = low, high, first_inside
            r.inside, r.distinct = m["inside"], m["distinct"]
        elif low < high and r.rank < first_inside + m["inside"] + m["at_high"]:
            r.value = high
        else:
            passed = first_inside if low == high else first_inside + m["inside"] + m["at_high"]
            r.low, r.inside, r.below = high, r.inside - (passed - r.below), passed

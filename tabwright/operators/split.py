"""Exact-size, seeded splits and folds (H1, H2, H3).

A row's place in the shuffled order is its (hash, key). A split is then a handful of
cut points in that order, so it is fitted rather than computed row by row: a histogram
of hash prefixes finds the prefix that holds each cut, only that prefix is refined, and
assigning rows is a comparison with the cut points in the scan's own stage. No row
is shuffled or ranked, whatever the size of a class.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.hashing import HASH_BITS, hash60
from tabwright.params import SplitParams

MAX_STRATA = 1000
_FETCH_LIMIT = 4096


@dataclass(frozen=True)
class HashSplit:
    """Fitted cut points; ``assign`` is a narrow projection."""

    key: str
    seed: int
    strata: str | None
    names: tuple
    cuts: dict

    def assign(self, df: DataFrame, into: str = "split") -> DataFrame:
        """Add the part each row belongs to."""
        hashed = hash60(F.col(self.key), self.seed)
        n_cuts = len(self.names) - 1
        if self.strata is None:
            points = self.cuts[None]
            key_type = df.schema[self.key].dataType
            literals = [
                None if p is None else (F.lit(p[0]), F.lit(p[1]).cast(key_type)) for p in points
            ]
            return df.withColumn(into, self._part(hashed, literals))

        # one row per stratum, as many as the fit allowed
        fields = [T.StructField("__stratum", df.schema[self.strata].dataType)]
        for i in range(n_cuts):
            fields.append(T.StructField(f"__hash{i}", T.LongType()))
            fields.append(T.StructField(f"__key{i}", df.schema[self.key].dataType))
        rows = [
            (value, *(x for p in points for x in (p or (None, None))))
            for value, points in self.cuts.items()
        ]
        table = df.sparkSession.createDataFrame(rows, T.StructType(fields))
        joined = df.join(
            F.broadcast(table), df[self.strata].eqNullSafe(table["__stratum"]), "left"
        )
        points = [(F.col(f"__hash{i}"), F.col(f"__key{i}")) for i in range(n_cuts)]
        part = self._part(hashed, points)
        return joined.select(*(df[c] for c in df.columns), part.alias(into))

    def _part(self, hashed: Column, points) -> Column:
        key = F.col(self.key)
        passed = [
            F.coalesce((hashed > h) | ((hashed == h) & (key >= k)), F.lit(False)).cast("int")
            for h, k in (p for p in points if p is not None)
        ]
        index = reduce(lambda a, b: a + b, passed, F.lit(0))
        if list(self.names) == list(range(len(self.names))):
            return index
        return F.element_at(F.array(*(F.lit(n) for n in self.names)), index + F.lit(1))


def three_way_split(
    df: DataFrame,
    key: str,
    test_share: float = 0.2,
    validation_share: float = 0.1,
    seed: int = 42,
) -> HashSplit:
    """Train / validation / test with rounded-up test, then validation, sizes (H1)."""

    def sizes(counts):
        n = counts[None]
        n_test = math.ceil(test_share * n)
        n_validation = math.ceil(validation_share / (1 - test_share) * (n - n_test))
        return {None: [n_test, n_validation]}

    return fit_split(df, key, ("test", "validation", "train"), sizes, seed)


def split_table(df: DataFrame, params: SplitParams = SplitParams()) -> DataFrame:
    """H1 with its parameters; adds the column ``split``."""
    fitted = three_way_split(
        df, params.key, params.test_share, params.validation_share, params.seed
    )
    return fitted.assign(df)


def stratified_split(
    df: DataFrame, key: str, strata: str, test_share: float = 0.2, seed: int = 100, max_strata: int = MAX_STRATA
) -> HashSplit:
    """Train / test with each class in proportion (H2).

    Train sizes per class are the proportional share rounded down, the rows still
    missing going to the classes with the largest remainder (lowest class on a tie).
    """

    def sizes(counts):
        n = sum(counts.values())
        n_train = n - math.ceil(test_share * n)
        train = proportional_sizes(counts, n_train)
        return {c: [counts[c] - train[c]] for c in counts}

    return fit_split(df, key, ("test", "train"), sizes, seed, strata, max_strata=max_strata)


def stratified_folds(
    df: DataFrame, key: str, strata: str, folds: int = 10, seed: int = 100, max_strata: int = MAX_STRATA
) -> HashSplit:
    """Fold numbers 0..folds-1, balanced within each class and overall (H3).

    Classes are laid end to end in order and dealt to the folds in turn; that gives
    each class its count per fold, and a fold takes a run of the shuffled order.
    """

    def sizes(counts):
        result, start = {}, 0
        for value in _ordered(counts):
            stop = start + counts[value]
            dealt = [len(range(start + (i - start) % folds, stop, folds)) for i in range(folds)]
            result[value] = dealt[:-1]
            start = stop
        return result

    return fit_split(df, key, tuple(range(folds)), sizes, seed, strata, max_strata=max_strata)


def hash_sample(
    df: DataFrame, key: str, size: int, seed: int, strata: str | None = None
) -> HashSplit:
    """Exactly ``size`` rows per class named 1, the others 0."""
    return fit_split(
        df, key, (1, 0), lambda counts: {c: [min(size, n)] for c, n in counts.items()}, seed, strata
    )


def proportional_sizes(counts: dict, draws: int) -> dict:
    """Share of ``draws`` per class by largest remainder."""
    total = sum(counts.values())
    exact = {c: n / total * draws for c, n in counts.items()}
    result = {c: math.floor(x) for c, x in exact.items()}
    order = sorted(_ordered(counts), key=lambda c: -(exact[c] - result[c]))
    for c in order[: draws - sum(result.values())]:
        result[c] += 1
    return result


def fit_split(
    df: DataFrame,
    key: str,
    names: Sequence,
    sizes: Callable[[dict], dict],
    seed: int,
    strata: str | None = None,
    bits: int = 14,
    max_strata: int = MAX_STRATA,
) -> HashSplit:
    """Find the cut points that give every stratum its part sizes.

    ``sizes`` maps the row counts per stratum to the sizes of all parts but the last.
    The key must be unique; a cut between rows of one key is an error, as is a stratum column with
    more than ``max_strata`` values, whose counts the driver holds. Costs two scans of the key and stratum columns, and one more
    for each factor of ``2**bits`` by which a stratum exceeds that many prefixes.
    """
    stratum = F.lit(None).cast("string") if strata is None else F.col(strata)
    rows = df.select(
        stratum.alias("s"), hash60(F.col(key), seed).alias("h"), F.col(key).alias("k")
    )
    if strata is not None:
        levels = rows.select("s").distinct().limit(max_strata + 1).count()
        if levels > max_strata:
            raise ValueError(f"{strata} has more than {max_strata} classes")
        bits = max(6, bits - levels.bit_length())

    shift = HASH_BITS - bits
    histogram = _histogram(rows, shift)
    counts = {s: sum(buckets.values()) for s, buckets in histogram.items()}
    if not counts:
        return HashSplit(key, seed, strata, tuple(names), {None: []} if strata is None else {})

    # position of each cut: (stratum, index of cut) -> rows still to pass inside its prefix
    open_cuts, cuts = {}, {}
    for s, parts in sizes(counts).items():
        cuts[s] = [None] * (len(names) - 1)
        passed = 0
        for i, size in enumerate(parts):
            passed += size
            if passed < counts[s]:
                open_cuts[s, i] = _descend(histogram[s], passed)

    while open_cuts and max(c[2] for c in open_cuts.values()) > _FETCH_LIMIT:
        if shift == 0:
            raise ValueError(f"split key {key} is not unique")
        inside = _inside(rows, open_cuts, shift)
        step = min(bits, shift)
        histogram = _histogram(inside, shift - step)
        for (s, i), (prefix, rest, _) in open_cuts.items():
            within = {b: n for b, n in histogram[s].items() if b >> step == prefix}
            open_cuts[s, i] = _descend(within, rest)
        shift -= step

    if open_cuts:
        found: dict = {}
        for row in _inside(rows, open_cuts, shift).collect():
            found.setdefault((row["s"], row["h"] >> shift), []).append((row["h"], row["k"]))
        for (s, i), (prefix, rest, _) in open_cuts.items():
            places = sorted(found[s, prefix])
            if rest and places[rest - 1] == places[rest]:  # equal rows would all fall on one side
                raise ValueError(f"split key {key} is not unique")
            cuts[s][i] = places[rest]
    return HashSplit(key, seed, strata, tuple(names), cuts)


def _histogram(rows: DataFrame, shift: int) -> dict:
    """Row counts per stratum and hash prefix; strata x 2**bits rows at most."""
    counted = rows.groupBy("s", F.shiftright("h", shift).alias("b")).count()
    result: dict = {}
    for row in counted.collect():
        result.setdefault(row["s"], {})[row["b"]] = row["count"]
    return result


def _descend(buckets: dict, index: int) -> tuple[int, int, int]:
    """Prefix holding the row at ``index``, the index inside it, and its row count."""
    for prefix in sorted(buckets):
        if index < buckets[prefix]:
            return prefix, index, buckets[prefix]
        index -= buckets[prefix]
    raise ValueError("cut lies beyond the last row")


def _inside(rows: DataFrame, open_cuts: dict, shift: int) -> DataFrame:
    wanted: dict = {}
    for (s, _), (prefix, _, _) in open_cuts.items():
        wanted.setdefault(s, set()).add(prefix)
    tests = [
        F.col("s").eqNullSafe(F.lit(s)) & F.shiftright("h", shift).isin(sorted(prefixes))
        for s, prefixes in wanted.items()
    ]
    return rows.filter(reduce(lambda a, b: a | b, tests))


def _ordered(values) -> list:
    """Class values in their own order, null last."""
    return sorted(values, key=lambda v: (v is None, v))


def part(df: DataFrame, name, column: str = "split") -> DataFrame:
    """One part of an assigned table."""
    return df.filter(F.col(column) == F.lit(name)).drop(column)


__all__ = [
    "HashSplit", "fit_split", "hash_sample", "part", "proportional_sizes", "split_table",
    "stratified_folds", "stratified_split", "three_way_split",
]

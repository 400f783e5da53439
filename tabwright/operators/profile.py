"""Profiles and counts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators.clean import numeric_columns, quoted, string_columns
from tabwright.operators.quantiles import exact_quantiles

_KERNEL_ROWS = 2_048  # values that meet the grid at once


def column_profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """One row per column: type, rows, nulls, distinct non-null values.

    Exact distinct counts group (column, value) pairs, so a frequent value is one row
    after the map side. ``exact=False`` keeps sketches instead and shuffles one row per task.
    """
    types = F.create_map(*(x for f in df.schema for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))))
    if exact:
        counted = value_counts_by_column(df, df.columns, keep_null=True).groupBy("column").agg(
            F.sum("n").alias("rows"),
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
            F.count("value").alias("distinct"),
        )
    else:
        wide = df.agg(
            *(F.struct(
                F.count(F.lit(1)).alias("rows"),
                F.count_if(quoted(c).isNull()).alias("nulls"),
                F.approx_count_distinct(quoted(c)).alias("distinct"),
            ).alias(c) for c in df.columns)
        )
        counted = wide.unpivot([], [quoted(c) for c in df.columns], "column", "s").select(
            "column", "s.rows", "s.nulls", "s.distinct"
        )
    return counted.select(
        "column", F.element_at(types, F.col("column")).alias("type"), "rows", "nulls", "distinct"
    )


def value_counts_by_column(
    df: DataFrame, columns: Sequence[str], keep_null: bool = False
) -> DataFrame:
    """Counts of each value of each column, as ``(column, value, n)`` with text values."""
    texts = df.select(*(quoted(c).cast("string").alias(c) for c in columns))
    long = texts.unpivot([], [quoted(c) for c in columns], "column", "value")
    if not keep_null:
        long = long.filter(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def describe(df: DataFrame) -> DataFrame:
    """Summary of all columns, one row each (E2); nested columns as their JSON-like text.

    Text, dates, timestamps, booleans: count, unique, top, freq (lowest value on a tie). Numeric: count, mean, sample
    deviation, min, exact linear quartiles, max.
    """
    numerics = numeric_columns(df)
    texts = [c for c in df.columns if c not in numerics]
    df = df.withColumns({c: quoted(c).cast("string") for c in texts if df.schema[c].dataType.typeName() != "string"})
    empty = {"unique": "long", "top": "string", "freq": "long", "mean": "double", "std": "double",
             "min": "double", "q25": "double", "q50": "double", "q75": "double", "max": "double"}

    def shaped(part: DataFrame) -> DataFrame:
        return part.select("column", "count", *(
            F.col(c) if c in part.columns else F.lit(None).cast(t).alias(c) for c, t in empty.items()
        ))

    parts = []
    if texts:
        counts = value_counts_by_column(df, texts, keep_null=True)
        present = F.col("value").isNotNull()
        parts.append(shaped(counts.groupBy("column").agg(
            F.sum(F.when(present, F.col("n")).otherwise(0)).alias("count"),
            F.count("value").alias("unique"),
            F.min(F.when(present, F.struct(-F.col("n"), "value"))).alias("__top"),
        ).select(
            "column", "count", "unique", F.col("__top.value").alias("top"),
            (-F.col("__top.col1")).alias("freq"),
        )))
    if numerics:
        quartiles = exact_quantiles(df, numerics, [0.25, 0.5, 0.75])
        wide = df.agg(*(
            _numeric_summary(c).alias(c) for c in numerics
        ))
        long = wide.unpivot([], [quoted(c) for c in numerics], "column", "s")
        picked = [
            reduce(
                lambda chain, c: chain.when(F.col("column") == c, F.lit(quartiles[c][i]).cast("double")),
                numerics, F.when(F.lit(False), F.lit(None).cast("double")),
            ).alias(name)
            for i, name in enumerate(("q25", "q50", "q75"))
        ]
        parts.append(shaped(long.select("column", "s.*", *picked)))
    return reduce(DataFrame.unionByName, parts)


def _numeric_summary(name: str):
    x = F.nanvl(quoted(name).cast("double"), F.lit(None).cast("double"))
    return F.struct(
        F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"), F.max(x).alias("max"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts per non-null value, most frequent first."""
    present = df.filter(quoted(column).isNotNull())
    counted = present.groupBy(quoted(column).alias(column)).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), quoted(column))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Share of each non-null value."""
    present = df.filter(quoted(column).isNotNull())
    counted = present.groupBy(quoted(column).alias(column)).agg(F.count(F.lit(1)).alias("n"))
    total = present.agg(F.count(F.lit(1)).cast("double").alias("total"))
    # one-row total: a scalar subquery, not a join
    return counted.select(
        quoted(column), "n", F.try_divide(F.col("n"), total.scalar()).alias("share")
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Columns that hold nulls, with their number (E5, C11)."""
    return _counts_above_zero(df, df.columns, lambda c: quoted(c).isNull())


def sentinel_counts(df: DataFrame, sentinel: str = "?") -> DataFrame:
    """Text columns that hold the sentinel, with its number."""
    return _counts_above_zero(df, string_columns(df), lambda c: quoted(c) == sentinel)


def _counts_above_zero(df: DataFrame, columns: Sequence[str], test) -> DataFrame:
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, n bigint")
    wide = df.agg(*(F.count_if(test(c)).alias(c) for c in columns))
    return wide.unpivot([], [quoted(c) for c in columns], "column", "n").filter(F.col("n") > 0)


def class_balance(df: DataFrame, label: str, parts: str | None = None) -> DataFrame:
    """Rows, positives and positive percentage, per part if given."""
    keys = [quoted(parts)] if parts else []
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(quoted(label)).cast("long").alias("positives"),
        (F.avg(quoted(label)) * 100).alias("positive_pct"),
    )


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins over the column's range, last bin closed, empty bins kept (E8). NaN counts
    as null."""
    x = F.nanvl(quoted(column).cast("double"), F.lit(None).cast("double"))
    edges = F.min(x).alias("low"), F.max(x).alias("high")
    low, high = df.agg(*edges).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, low double, high double, n bigint")
    if low == high:
        low, high = low - 0.5, high + 0.5
    step = (high - low) / bins
    bounds = [i * step + low for i in range(bins)] + [high]
    index = reduce(
        lambda a, b: a + b, ((x >= F.lit(e)).cast("int") for e in bounds[1:-1]), F.lit(0)
    )
    counted = df.filter(x.isNotNull()).agg(
        *(F.count_if(index == i).alias(str(i)) for i in range(bins))
    )
    long = counted.unpivot([], counted.columns, "bin", "n")
    position = F.col("bin").cast("int")
    lows, highs = (F.array(*(F.lit(e) for e in es)) for es in (bounds[:-1], bounds[1:]))
    return long.select(
        position.alias("bin"), F.get(lows, position).alias("low"),
        F.get(highs, position).alias("high"), "n",
    )


def density_curve(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth on an even grid over the range.

    Every partition sums its values' kernels over the whole grid, so what is shuffled is one row
    per grid point and partition. NaN counts as null.
    """
    x = F.nanvl(quoted(column).cast("double"), F.lit(None).cast("double"))
    facts = df.agg(
        F.count(x).alias("n"), F.min(x).alias("low"), F.max(x).alias("high"),
        F.stddev_samp(x).alias("std"),
    ).first()
    n, std = facts["n"], facts["std"]
    if not n or not std:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    width = std * n ** -0.2
    low, step = facts["low"], (facts["high"] - facts["low"]) / (points - 1)

    def kernels(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grid = np.arange(points) * step + low
        sums = np.zeros(points)
        for batch in batches:
            values, weights = np.unique(batch["v"].to_numpy(), return_counts=True)
            for at in range(0, len(values), _KERNEL_ROWS):
                z = (grid[:, None] - values[at: at + _KERNEL_ROWS]) / width
                sums += np.exp(-z * z / 2.0) @ weights[at: at + _KERNEL_ROWS]
        yield pd.DataFrame({"point": np.arange(points, dtype=np.int32), "part": sums})

    scale = n * width * 2.5066282746310002  # sqrt(2 pi)
    partial = df.select(x.alias("v")).filter(F.col("v").isNotNull()).mapInPandas(kernels, "point int, part double")
    summed = partial.groupBy("point").agg((F.sum("part") / F.lit(scale)).alias("density"))
    return summed.select("point", (F.col("point") * F.lit(step) + F.lit(low)).alias("x"), "density")


def type_counts(df: DataFrame) -> DataFrame:
    """Number of columns per type."""
    kinds: dict[str, int] = {}
    for f in df.schema:
        kinds[f.dataType.simpleString()] = kinds.get(f.dataType.simpleString(), 0) + 1
    return df.sparkSession.createDataFrame(sorted(kinds.items()), "type string, columns int")


def shape(df: DataFrame) -> DataFrame:
    """Rows and columns as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("long"))


def mean_and_deviation(df: DataFrame, column: str) -> DataFrame:
    """Mean and population deviation of a column of scores."""
    return df.agg(F.avg(column).alias("mean"), F.stddev_pop(column).alias("std"))



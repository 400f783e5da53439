"""Column and row cleaning (C1-C9, F8-F11 over whole tables)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions import fill_missing, not_in, sentinel_to_null, to_number
from tabwright.operators.quantiles import exact_medians
from tabwright.params import SENTINELS


def quoted(name: str):
    """Column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def string_columns(df: DataFrame) -> list[str]:
    """Names of the text columns."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the columns with a numeric type."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def columns_like(df: DataFrame, pattern: str) -> list[str]:
    """Names that contain the text, in any case."""
    return [c for c in df.columns if pattern.lower() in c.lower()]


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns; names that are absent are ignored."""
    return df.drop(*names)


def keep_declared(df: DataFrame, *groups: Sequence[str]) -> DataFrame:
    """Only the declared columns, in declared order."""
    return df.select(*(quoted(c) for group in groups for c in group))


def null_sentinels(df: DataFrame, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """Sentinel texts become null in every text column."""
    texts = set(string_columns(df))
    return df.select(
        *(sentinel_to_null(quoted(c), sentinels).alias(c) if c in texts else quoted(c)
          for c in df.columns)
    )


def exclude_values(df: DataFrame, column: str, excluded: Sequence) -> DataFrame:
    """Rows whose value is not excluded; rows with a null value stay (C4)."""
    return df.filter(not_in(quoted(column), excluded))


def fill_level(df: DataFrame, columns: Sequence[str], level: str) -> DataFrame:
    """Null replaced by a level in the named columns."""
    names = set(columns)
    return df.select(
        *(fill_missing(quoted(c), level).alias(c) if c in names else quoted(c) for c in df.columns)
    )


def numbers_with_median_fill(
    df: DataFrame, exclude: Sequence[str] = (), columns: Sequence[str] | None = None
) -> DataFrame:
    """Text coerced to numbers and nulls filled with the column median.

    Columns in ``exclude``, and those that are neither text nor numeric, pass through.
    A column without any number stays null. All medians come from shared passes.
    """
    skipped = set(exclude)
    wanted = [c for c in (columns if columns is not None else df.columns) if c not in skipped]
    texts, numerics = set(string_columns(df)), set(numeric_columns(df))
    coerced = df.select(
        *(to_number(quoted(c)).alias(c) if c in texts and c in wanted else quoted(c)
          for c in df.columns)
    )
    targets = [c for c in wanted if c in texts or c in numerics]
    medians = exact_medians(coerced, targets)
    filled = {
        c: F.coalesce(F.nanvl(quoted(c).cast("double"), F.lit(None).cast("double")), F.lit(m))
        for c, m in medians.items() if m is not None
    }
    return coerced.select(*(filled.get(c, quoted(c)).alias(c) for c in coerced.columns))

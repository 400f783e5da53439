"""Null handling and coercion."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabwright.params import MISSING_LEVEL, SENTINELS

_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"
_LARGEST = 1.7976931348623157e308


def not_in(value: Column, excluded: Iterable) -> Column:
    """True unless the value is one of the excluded; a null value is kept (C4)."""
    return ~F.coalesce(value.isin(*excluded), F.lit(False))


def sentinel_to_null(value: Column, sentinels: Iterable[str] = SENTINELS) -> Column:
    """Null where the whole text is a sentinel, else the text."""
    return F.when(not_in(value, sentinels), value)


def to_number(text: Column) -> Column:
    """Text as a double, null where it is not a number (F8).

    The pattern is checked first because a Java parse also accepts a type suffix
    such as ``1d``. The text ``nan`` counts as missing.
    """
    text = text.cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text)).try_cast("double")


def fill_missing(value: Column, level: str = MISSING_LEVEL) -> Column:
    """Null replaced by a level of its own."""
    return F.coalesce(value.cast("string"), F.lit(level))


def finite_or_zero(value: Column) -> Column:
    """NaN and null become 0, infinities the largest finite double."""
    number = F.coalesce(F.nanvl(value.cast("double"), F.lit(0.0)), F.lit(0.0))
    return F.greatest(F.least(number, F.lit(_LARGEST)), F.lit(-_LARGEST))


def map_values(value: Column, mapping: Mapping) -> Column:
    """Value looked up in a small fixed mapping, null where absent."""
    result = None
    for source, image in mapping.items():
        result = (
            F.when(value == F.lit(source), F.lit(image))
            if result is None
            else result.when(value == F.lit(source), F.lit(image))
        )
    if result is None:
        raise ValueError("mapping is empty")
    return result


def row_sum(columns: Iterable[Column]) -> Column:
    """Sum across one row that skips nulls; 0 for no columns or all null."""
    return reduce(lambda a, b: a + b, (F.coalesce(c, F.lit(0)) for c in columns), F.lit(0))

"""Seeded hashes of a key: the source of every random choice in the package.

A choice that depends only on (key, seed) is the same for any partitioning, after a
lost executor, and in another engine that knows md5.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60


def hash60(key: Column, *salt) -> Column:
    """First 60 bits of ``md5("key:salt:...")`` as a non-negative long."""
    text = F.concat_ws(":", key.cast("string"), *(_text(s) for s in salt))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def unit_interval(hashed: Column) -> Column:
    """A hash as a number in [0, 1)."""
    return (hashed.bitwiseAND(F.lit((1 << 52) - 1))).cast("double") / F.lit(float(1 << 52))


def _text(part) -> Column:
    return part.cast("string") if isinstance(part, Column) else F.lit(str(part))

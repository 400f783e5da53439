"""Words of UTF-8 texts, found by vectorised passes over the bytes.

Both word classes below say nothing about single characters beyond ASCII, so a byte decides:
every byte of a longer character is 0x80 or above.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``: digits, a-z and everything beyond ASCII.
ALPHANUMERIC = np.ones(256, bool)
ALPHANUMERIC[0x00:0x30] = ALPHANUMERIC[0x3A:0x61] = ALPHANUMERIC[0x7B:0x80] = False
#: The same with capital letters, for texts that are not lower-cased.
ALPHANUMERIC_CASED = ALPHANUMERIC.copy()
ALPHANUMERIC_CASED[0x41:0x5B] = True


def bounds(data: bytes, kind: np.ndarray = ALPHANUMERIC) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end byte of every word."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = kind[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def words_of(data: bytes, kind: np.ndarray = ALPHANUMERIC) -> list[bytes]:
    starts, ends = bounds(data, kind)
    return [data[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


def byte_texts(column: pa.Array) -> list[bytes | None]:
    """A text column as bytes objects."""
    return column.cast(pa.binary()).to_pylist()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not use yet, made from ``names``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def in_slices(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches to at most ``rows`` rows, so results of one batch stay small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)

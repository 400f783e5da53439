"""Records of CSV files with line breaks inside quoted cells, read in as many tasks as Spark splits the files into.

Whether a line begins inside a quoted cell is the parity of the quotes before it. A first pass counts the quotes of every
block; running parities over a file's blocks, one row each, say which blocks begin inside a cell. The second
pass joins lines to records block by block: records that lie in one block leave at once, and only the pieces of those that
go on into another block, at most two a block, are shuffled to be put together.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What a piece is of: a whole record, or the first lines, lines in the middle, or the last lines of one.
WHOLE, FIRST, MIDDLE, LAST = range(4)


def records(spark: SparkSession, path: str) -> DataFrame:
    """``record`` (text without its line end) and ``is_head`` (the first of a file), blank records left out.

    Lines end in \\n or \\r\\n; line ends inside cells stay as they are. Quotes may only enclose cells or, doubled, stand inside
    enclosed ones. ValueError at a file that ends inside a cell.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    blocks = lines.groupBy("file", "block").agg((F.sum(quotes.cast("long")) % 2).alias("odd"))
    order = Window.partitionBy("file").orderBy("block")  # a row per block
    running = blocks.select("file", "block", F.sum("odd").over(order).alias("after"), F.sum("odd").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
                            F.lead("block").over(order).alias("next"))
    marked = running.where("before % 2 = 1 OR (next IS NULL AND after % 2 = 1)").select(
        "file", F.xxhash64("file", "block").alias("key"), (F.col("before") % 2 == 1).alias("inside"), (F.col("next").isNull() & (F.col("after") % 2 == 1)).alias("open"))
    # eight bytes for each block that begins inside a cell, whatever the block holds
    rows = marked.collect()
    if unclosed := sorted({r["file"] for r in rows if r["open"]}):
        raise ValueError(f"a quoted cell is not closed: {unclosed[0]}")
    inside = spark.sparkContext.broadcast(np.sort(np.array([r["key"] for r in rows if r["inside"]], np.int64)))
    pieces = lines.select("value", "file", "block", (quotes % 2 == 1).alias("odd"), F.xxhash64("file", "block").alias("key")).mapInArrow(
        lambda batches: _joined(batches, inside.value), "text string, kind int, file string, block long, is_head boolean")
    whole = pieces.where(F.col("kind") == WHOLE).select("text", "is_head")
    in_file = Window.partitionBy("file").orderBy("block", F.col("kind") == FIRST)  # at most two a block
    parts = pieces.where(F.col("kind") != WHOLE).withColumn("nth", F.count_if(F.col("kind") == FIRST).over(in_file))
    joined = parts.groupBy("file", "nth").agg(F.sort_array(F.collect_list(F.struct("block", "text"))).alias("parts"), F.bool_or("is_head").alias("is_head")).select(
        F.array_join("parts.text", "\n").alias("text"), "is_head")
    found = whole.unionByName(joined).select(F.regexp_replace("text", "\r$", "").alias("record"), "is_head")
    return found.where(F.trim("record") != "")


def _joined(batches: Iterable[pa.RecordBatch], inside: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Lines in the order of a file's blocks -> records and pieces of records."""
    schema = pa.schema([("text", pa.string()), ("kind", pa.int32()), ("file", pa.string()), ("block", pa.int64()), ("is_head", pa.bool_())])
    now: tuple[str, int] | None = None  # block being read
    held: list[str] = []
    begun = started = head = False  # inside a record; the record began in this block; it is its file's first

    def piece(kind: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(("\n".join(held), kind, *now, head), schema)], schema=schema)

    for batch in batches:
        value, file, block, odd, key = (batch.column(i) for i in range(5))
        starts = [0, *(np.flatnonzero(np.diff(key.to_numpy())) + 1).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            if a == b:
                continue
            here = (file[a].as_py(), block[a].as_py())
            if here != now:
                if begun:
                    yield piece(FIRST if started else MIDDLE)
                k = key[a].as_py()
                at = int(np.searchsorted(inside, k))
                now, held, begun, started, head = here, [], at < len(inside) and inside[at] == k, False, False
                first = here[1] == 0
            else:
                first = False
            flips = odd[a:b].to_numpy(zero_copy_only=False)
            before = (np.cumsum(flips) - flips + begun) % 2 == 1
            alone = ~before & ~flips
            texts = value.slice(a, b - a)
            some = np.flatnonzero(~alone)
            if alone.any():
                is_head = np.zeros(b - a, bool)
                is_head[0] = first
                mask = pa.array(alone)
                n = int(alone.sum())
                yield pa.RecordBatch.from_arrays([pc.filter(texts, mask), pa.array(np.full(n, WHOLE, np.int32)), pa.array([now[0]] * n, pa.string()),
                                                  pa.array(np.full(n, now[1])), pa.array(is_head[alone])], schema=schema)
            for i, text in zip(some.tolist(), pc.take(texts, pa.array(some)).to_pylist()):
                if not begun:
                    held, begun, started, head = [], True, True, first and i == 0
                held.append(text)
                if flips[i] and before[i]:
                    yield piece(WHOLE if started else LAST)
                    held, begun, started, head = [], False, False, False
    if begun:
        yield piece(FIRST if started else MIDDLE)

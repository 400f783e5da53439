"""Running totals over a whole ordered table without a single-task window.

The order column is cut into buckets at approximate quantiles. Each bucket is summed
and cumulated on its own, and gets the total of the buckets before it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_BUCKETS = 10_000
BUCKET_ROWS = 1_000_000


def bucket_edges(df: DataFrame, order: str, buckets: int | None = None) -> list[float]:
    """Inner bucket edges: quantiles of the order column.

    Give the table that is to be cumulated, one row per distinct value, so that frequent values
    do not crowd the edges. Without ``buckets`` there is one per shuffle partition, and more, found
    by a second aggregate, where these would hold over ``BUCKET_ROWS`` rows each.
    """
    chosen = min(buckets or _default_buckets(df), MAX_BUCKETS)
    rows, edges = _quantiles(df, order, chosen)
    needed = min(math.ceil(rows / BUCKET_ROWS), MAX_BUCKETS)
    if buckets is None and needed > chosen:
        _, edges = _quantiles(df, order, needed)
    return edges


def _quantiles(df: DataFrame, order: str, buckets: int) -> tuple[int, list[float]]:
    """Rows, and the edges between ``buckets`` buckets."""
    if buckets < 2:
        return 0, []
    shares = [i / buckets for i in range(1, buckets)]
    row = df.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(order, shares, 10 * buckets).alias("e")).first()
    return row["n"], sorted({float(e) for e in row["e"] or [] if math.isfinite(e)})


def running_totals(
    table: DataFrame, order: str, sums: Sequence[str], edges: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Add ``cum_<s>`` per sum, over descending ``order``, ``all_<s>`` and ``next_<s>``.

    ``order`` must be a non-null double without duplicates: group first, so a value
    shared by many rows is one row here. ``all_<s>`` is the grand total, ``next_<s>``
    the value on the following row. With ``by`` each group of these columns is cumulated on its own. The table is used twice; Spark reuses the exchange that produced it.
    """
    tagged = _tagged(table, order, edges)

    # one row per bucket, at most MAX_BUCKETS for each group: the window below is small, and so is the broadcast of a single group
    totals = tagged.groupBy(*by, "__bucket").agg(
        *(F.sum(s).alias(f"__total_{s}") for s in sums),
        *(F.max_by(s, order).alias(f"__head_{s}") for s in sums),
    )
    down = Window.partitionBy(*by).orderBy(F.desc("__bucket"))
    before = down.rowsBetween(Window.unboundedPreceding, -1)
    everything = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        *by, "__bucket",
        *(F.coalesce(F.sum(f"__total_{s}").over(before), F.lit(0)).alias(f"__before_{s}") for s in sums),
        *(F.sum(f"__total_{s}").over(everything).alias(f"__all_{s}") for s in sums),
        *(F.lead(f"__head_{s}").over(down).alias(f"__next_{s}") for s in sums),
    )

    local = Window.partitionBy(*by, "__bucket").orderBy(F.desc(order))
    running = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    following: list[Column] = [
        F.coalesce(F.lead(s).over(local), F.col(f"__next_{s}")).alias(f"next_{s}") for s in sums
    ]
    # a left join, as an inner one adds a filter to one use of the table and so prevents reuse
    return tagged.join(offsets if by else F.broadcast(offsets), [*by, "__bucket"], "left").select(
        *table.columns,
        *((F.sum(s).over(running) + F.col(f"__before_{s}")).alias(f"cum_{s}") for s in sums),
        *(F.col(f"__all_{s}").alias(f"all_{s}") for s in sums),
        *following,
    )


def _tagged(table: DataFrame, order: str, edges: Sequence[float]) -> DataFrame:
    if not edges:
        return table.withColumn("__bucket", F.lit(0))
    splits = [-math.inf, *edges, math.inf]
    buckets = Bucketizer(splits=splits, inputCol=order, outputCol="__bucket", handleInvalid="error")
    return buckets.transform(table).withColumn("__bucket", F.col("__bucket").cast("int"))


def _default_buckets(df: DataFrame) -> int:
    return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))

"""Split and fold queries (B1, H rows)."""

from __future__ import annotations

from tabwright.catalog.registry import query
from tabwright.operators.split import split_table, stratified_folds, stratified_split, three_way_split
from tabwright.params import SplitParams
from tabwright.session import shared_folder
from tabwright.sources.sinks import write_splits
from tabwright.sources.tables import parquet

_HASH = "('0x' || substr(md5(o_orderkey || ':{seed}'), 1, 15))::BIGINT"

THREE_WAY = f"""
WITH s AS (SELECT o_orderkey, row_number() OVER (ORDER BY {_HASH.format(seed=42)}, o_orderkey) AS r, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CASE WHEN r <= ceil(0.2 * n) THEN 'test'
  WHEN r <= ceil(0.2 * n) + ceil(0.125 * (n - ceil(0.2 * n))) THEN 'validation' ELSE 'train' END AS split FROM s
"""


@query("h1_three_way_split", THREE_WAY)
def _(spark, folder):
    orders = parquet(spark, folder, "orders")
    return three_way_split(orders, "o_orderkey").assign(orders).select("o_orderkey", "split")


@query("b1_written_splits", THREE_WAY)
def _(spark, folder):
    path = shared_folder(spark)
    orders = parquet(spark, folder, "orders").select("o_orderkey")
    write_splits(split_table(orders, SplitParams(key="o_orderkey")), path)
    return spark.read.schema("o_orderkey bigint, split string").parquet(path)


@query("h2_stratified_split", f"""
WITH s AS (SELECT o_orderkey, o_orderstatus,
    row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_HASH.format(seed=100)}, o_orderkey) AS r FROM orders),
c AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1),
d AS (SELECT *, sum(n) OVER () AS total FROM c),
x AS (SELECT *, n / CAST(total AS DOUBLE) * (total - ceil(0.2 * total)) AS exact FROM d),
f AS (SELECT *, floor(exact) AS base, row_number() OVER (ORDER BY exact - floor(exact) DESC, o_orderstatus) AS place,
    (total - ceil(0.2 * total)) - sum(floor(exact)) OVER () AS short FROM x),
t AS (SELECT o_orderstatus, n - (base + CASE WHEN place <= short THEN 1 ELSE 0 END) AS n_test FROM f)
SELECT o_orderkey, s.o_orderstatus, CASE WHEN r <= n_test THEN 'test' ELSE 'train' END AS split
FROM s JOIN t ON s.o_orderstatus = t.o_orderstatus
""")
def _(spark, folder):
    orders = parquet(spark, folder, "orders")
    fitted = stratified_split(orders, "o_orderkey", "o_orderstatus")
    return fitted.assign(orders).select("o_orderkey", "o_orderstatus", "split")


@query("h3_stratified_folds", f"""
WITH s AS (SELECT o_orderkey, o_orderstatus,
    row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_HASH.format(seed=100)}, o_orderkey) - 1 AS r FROM orders),
c AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1),
e AS (SELECT o_orderstatus, n, sum(n) OVER (ORDER BY o_orderstatus) - n AS start FROM c),
a AS (SELECT o_orderstatus, i AS fold, (SELECT count(*) FROM range(n) t(p) WHERE (start + p) % 10 = i) AS dealt
  FROM e, (SELECT unnest(range(10)) AS i)),
b AS (SELECT o_orderstatus, fold, sum(dealt) OVER (PARTITION BY o_orderstatus ORDER BY fold) AS stop,
    sum(dealt) OVER (PARTITION BY o_orderstatus ORDER BY fold) - dealt AS start FROM a)
SELECT o_orderkey, s.o_orderstatus, CAST(fold AS INTEGER) AS fold
FROM s JOIN b ON s.o_orderstatus = b.o_orderstatus AND r >= start AND r < stop
""")
def _(spark, folder):
    orders = parquet(spark, folder, "orders")
    folds = stratified_folds(orders, "o_orderkey", "o_orderstatus")
    return folds.assign(orders, "fold").select("o_orderkey", "o_orderstatus", "fold")

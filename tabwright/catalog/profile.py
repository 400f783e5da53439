"""Profile queries (E rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.catalog.clean import cleaned
from tabwright.catalog.encounters import encounters, with_encounters
from tabwright.catalog.registry import query
from tabwright.functions import hash60
from tabwright.operators.profile import (
    class_balance,
    column_profile,
    density_curve,
    describe,
    histogram,
    mean_and_deviation,
    null_counts,
    sentinel_counts,
    shape,
    type_counts,
    value_counts,
    value_shares,
)
from tabwright.operators.quantiles import exact_medians, exact_quantiles
from tabwright.operators.split import split_table
from tabwright.params import SplitParams
from tabwright.sources.tables import parquet

_ORDERS = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}


@query("e1_column_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS type, CAST(count(*) AS BIGINT) AS \"rows\", "
    f"CAST(count(*) - count({c}) AS BIGINT) AS nulls, CAST(count(DISTINCT {c}) AS BIGINT) AS \"distinct\" "
    f"FROM (SELECT * REPLACE (nullif(o_orderstatus, 'P') AS o_orderstatus) FROM orders)"
    for c, t in _ORDERS.items()
))
def _(spark, folder):
    orders = parquet(spark, folder, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    return column_profile(orders)


@query("e1_column_profile_approx")
def _(spark, folder):
    return column_profile(parquet(spark, folder, "orders"), exact=False)


def _describe_sql(numeric, text, table):
    parts = []
    for c in numeric:
        quartiles = ", ".join(
            f"round(quantile_cont({c}, {p}), 6) AS {n}" for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
        )
        parts.append(
            f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS count, CAST(NULL AS BIGINT) AS \"unique\", "
            f"CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, round(avg({c}), 6) AS mean, "
            f"round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, {quartiles}, "
            f"CAST(max({c}) AS DOUBLE) AS max FROM {table}"
        )
    for c in text:
        top = f"(SELECT CAST({c} AS VARCHAR) FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
        freq = f"(SELECT CAST(count(*) AS BIGINT) FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1)"
        nulls = ", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in ("mean", "std", "min", "q25", "q50", "q75", "max"))
        parts.append(
            f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS count, "
            f"CAST(count(DISTINCT {c}) AS BIGINT) AS \"unique\", {top} AS top, {freq} AS freq, {nulls} FROM {table}"
        )
    return " UNION ALL ".join(parts)


_LINE_NUMERIC = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
)
_LINE_OTHER = ("l_returnflag", "l_linestatus", "l_shipdate")


@query("e2_describe", _describe_sql(_LINE_NUMERIC, _LINE_OTHER, "lineitem"))
def _(spark, folder):
    table = describe(parquet(spark, folder, "lineitem"))
    return table.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})


@query("e3_value_counts", with_encounters("""
SELECT readmitted, CAST(count(*) AS BIGINT) AS n FROM encounters WHERE readmitted IS NOT NULL GROUP BY 1
"""))
def _(spark, folder):
    return value_counts(encounters(spark, folder), "readmitted")


@query("e4_value_shares", """
SELECT event_type, CAST(count(*) AS BIGINT) AS n, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 8) AS share
FROM (SELECT nullif(event_type, 'error') AS event_type FROM events) WHERE event_type IS NOT NULL GROUP BY event_type
""")
def _(spark, folder):
    events = parquet(spark, folder, "events").withColumn("event_type", F.nullif("event_type", F.lit("error")))
    return value_shares(events, "event_type").withColumn("share", F.round("share", 8))


_COLUMNS = (
    "encounter_id", "patient_nbr", "race", "gender", "age", "age_bracket", "admission_type_id",
    "discharge_disposition_id", "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
    "number_outpatient", "number_emergency", "number_inpatient", "number_diagnoses",
    "diag_1", "diag_2", "diag_3", "readmitted",
)


@query("e5_null_counts", with_encounters("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS n FROM encounters" for c in _COLUMNS
) + ") WHERE n > 0"))
def _(spark, folder):
    return null_counts(encounters(spark, folder))


@query("e6_sentinel_counts", with_encounters("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count_if({c} = '?') AS BIGINT) AS n FROM encounters"
    for c in ("race", "gender", "diag_1", "diag_2", "diag_3", "readmitted")
) + ") WHERE n > 0"))
def _(spark, folder):
    return sentinel_counts(encounters(spark, folder))


@query("e7_class_balance", """
WITH s AS (
  SELECT quality, row_number() OVER (ORDER BY ('0x' || substr(md5(doc_id || ':42'), 1, 15))::BIGINT, doc_id) AS r,
    count(*) OVER () AS n FROM labels
)
SELECT CASE WHEN r <= ceil(0.2 * n) THEN 'test' WHEN r <= ceil(0.2 * n) + ceil(0.125 * (n - ceil(0.2 * n))) THEN 'validation'
  ELSE 'train' END AS split, CAST(count(*) AS BIGINT) AS n, CAST(sum(quality) AS BIGINT) AS positives,
  round(avg(quality) * 100, 6) AS positive_pct
FROM s GROUP BY 1
""")
def _(spark, folder):
    assigned = split_table(parquet(spark, folder, "labels"), SplitParams(key="doc_id"))
    return class_balance(assigned, "quality", "split").withColumn("positive_pct", F.round("positive_pct", 6))


@query("e8_histogram", """
WITH r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, (max(o_totalprice) - min(o_totalprice)) / 10 AS step FROM orders),
e AS (SELECT CAST(i AS INTEGER) AS bin, i * step + lo AS low, CASE WHEN i = 9 THEN hi ELSE (i + 1) * step + lo END AS high
  FROM r, (SELECT unnest(range(10)) AS i))
SELECT bin, round(low, 6) AS low, round(high, 6) AS high,
  CAST((SELECT count(*) FROM orders WHERE o_totalprice >= low AND (o_totalprice < high OR bin = 9)) AS BIGINT) AS n FROM e
""")
def _(spark, folder):
    table = histogram(parquet(spark, folder, "orders"), "o_totalprice")
    return table.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


@query("e9_density_curve", """
WITH f AS (SELECT count(*) AS n, min(p_size) AS lo, max(p_size) AS hi, stddev_samp(p_size) * pow(count(*), -0.2) AS w FROM part),
g AS (SELECT CAST(i AS INTEGER) AS point, i * ((hi - lo) / 199.0) + lo AS x FROM f, (SELECT unnest(range(200)) AS i))
SELECT point, round(CAST(x AS DOUBLE), 6) AS x,
  round((SELECT sum(exp(-pow((x - p_size) / w, 2) / 2)) FROM part) / (n * w * sqrt(2 * pi())), 8) AS density FROM g, f
""")
def _(spark, folder):
    table = density_curve(parquet(spark, folder, "part"), "p_size")
    return table.withColumns({"x": F.round("x", 6), "density": F.round("density", 8)})


@query("e9_density_of_prices", """
WITH f AS (SELECT count(*) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi,
  stddev_samp(o_totalprice) * pow(count(*), -0.2) AS w FROM orders),
g AS (SELECT CAST(i AS INTEGER) AS point, i * ((hi - lo) / 199.0) + lo AS x, w, n FROM f, (SELECT unnest(range(200)) AS i))
SELECT point, round(max(x), 4) AS x, round(sum(exp(-pow((x - o_totalprice) / w, 2) / 2)) / max(n * w * sqrt(2 * pi())) * 1e6, 6) AS density
FROM g, orders GROUP BY point
""")
def _(spark, folder):
    table = density_curve(parquet(spark, folder, "orders"), "o_totalprice")
    return table.withColumns({"x": F.round("x", 4), "density": F.round(F.col("density") * 1e6, 6)})


@query("e11_type_counts", """
SELECT CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
    WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS type,
  CAST(count(*) AS INTEGER) AS columns
FROM duckdb_columns() WHERE table_name = 'lineitem' GROUP BY 1
""")
def _(spark, folder):
    return type_counts(parquet(spark, folder, "lineitem"))


@query("e12_medians", """
SELECT 'l_quantity' AS "column", round(median(l_quantity), 6) AS median FROM lineitem
UNION ALL SELECT 'l_extendedprice', round(median(l_extendedprice), 6) FROM lineitem
UNION ALL SELECT 'l_partkey', round(median(l_partkey), 6) FROM lineitem
""")
def _(spark, folder):
    medians = exact_medians(
        parquet(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice", "l_partkey"]
    )
    return spark.createDataFrame([(c, round(m, 6)) for c, m in medians.items()], "column string, median double")


@query("e12_quantiles_many_values", """
SELECT p, round(q, 6) AS value FROM (
  SELECT 0.01 AS p, quantile_cont(l_extendedprice, 0.01) AS q FROM lineitem
  UNION ALL SELECT 0.5, quantile_cont(l_extendedprice, 0.5) FROM lineitem
  UNION ALL SELECT 0.99, quantile_cont(l_extendedprice, 0.99) FROM lineitem)
""".replace("SELECT p,", "SELECT CAST(p AS DOUBLE) AS p,"))
def _(spark, folder):
    shares = [0.01, 0.5, 0.99]
    lines = parquet(spark, folder, "lineitem")
    found = exact_quantiles(lines, ["l_extendedprice"], shares, few_values=1000, fetch_limit=500)["l_extendedprice"]
    return spark.createDataFrame([(p, round(q, 6)) for p, q in zip(shares, found)], "p double, value double")


@query("e13_mean_and_deviation", """
SELECT round(avg(m), 8) AS mean, round(stddev_pop(m), 8) AS std
FROM (SELECT avg(quality) AS m FROM labels GROUP BY ('0x' || substr(md5(doc_id || ':1'), 1, 15))::BIGINT % 10)
""")
def _(spark, folder):
    fold = hash60(F.col("doc_id"), 1) % 10
    scores = parquet(spark, folder, "labels").groupBy(fold.alias("fold")).agg(F.avg("quality").alias("m"))
    return mean_and_deviation(scores, "m").select(F.round("mean", 8).alias("mean"), F.round("std", 8).alias("std"))


@query("e14_shape", with_encounters("""
SELECT CAST(count(*) AS BIGINT) AS "rows", CAST(20 AS BIGINT) AS columns FROM encounters
WHERE discharge_disposition_id NOT IN (11, 13, 14, 19, 20, 21)
"""))
def _(spark, folder):
    return shape(cleaned(spark, folder))

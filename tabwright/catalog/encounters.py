"""An encounter table derived from orders, customers and line items.

The driver has no encounter table, so one is derived row by row from its tables: one
encounter per order, with nulls where an order has no line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.sources.tables import parquet

SQL = """
lines AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS quantity,
    count_if(l_returnflag = 'R') AS returned, count_if(l_linestatus = 'O') AS open_lines,
    min(l_partkey) AS low_part, max(l_partkey) AS high_part, max(l_suppkey) AS supplier
  FROM lineitem GROUP BY l_orderkey
),
encounters AS (
  SELECT o_orderkey AS encounter_id, o_custkey AS patient_nbr,
    CASE WHEN c_nationkey = 7 THEN '?' ELSE c_mktsegment END AS race,
    CASE o_orderstatus WHEN 'F' THEN 'Female' WHEN 'O' THEN 'Male' ELSE 'Unknown/Invalid' END AS gender,
    CAST(floor(o_totalprice / 5000) AS BIGINT) AS age,
    '[' || CAST(CAST(floor(o_totalprice / 50000) AS BIGINT) * 10 AS VARCHAR) || '-'
      || CAST(CAST(floor(o_totalprice / 50000) AS BIGINT) * 10 + 10 AS VARCHAR) || ')' AS age_bracket,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS admission_type_id,
    CAST(c_nationkey + 1 AS INTEGER) AS discharge_disposition_id,
    CAST(n_lines AS BIGINT) AS time_in_hospital,
    CAST(quantity AS BIGINT) AS num_lab_procedures,
    CAST(returned AS BIGINT) AS num_procedures,
    CAST(open_lines AS BIGINT) AS num_medications,
    CAST(c_nationkey % 5 AS BIGINT) AS number_outpatient,
    CAST(o_custkey % 7 AS BIGINT) AS number_emergency,
    CAST(supplier % 10 AS BIGINT) AS number_inpatient,
    CAST(1 + day(o_orderdate) % 9 AS BIGINT) AS number_diagnoses,
    CASE WHEN low_part % 11 = 0 THEN 'V' || CAST(low_part % 100 AS VARCHAR)
         WHEN low_part % 13 = 0 THEN '250.83'
         ELSE CAST(low_part % 1000 AS VARCHAR) END AS diag_1,
    CASE WHEN high_part % 17 = 0 THEN '250' ELSE CAST(high_part % 1000 AS VARCHAR) END AS diag_2,
    CASE WHEN returned > 1 THEN CAST((low_part + high_part) % 1000 AS VARCHAR) || '.5' ELSE '' END AS diag_3,
    CASE WHEN quantity > 150 OR o_totalprice > 470000 THEN '<30'
         WHEN o_orderpriority < '3' THEN '>30' ELSE 'NO' END AS readmitted
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN lines ON o_orderkey = l_orderkey
)
"""


def encounters(spark: SparkSession, folder: str) -> DataFrame:
    """The table ``encounters`` of the SQL above."""
    orders, customer, lineitem = (parquet(spark, folder, t) for t in ("orders", "customer", "lineitem"))
    lines = lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("quantity"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.count_if(F.col("l_linestatus") == "O").alias("open_lines"),
        F.min("l_partkey").alias("low_part"),
        F.max("l_partkey").alias("high_part"),
        F.max("l_suppkey").alias("supplier"),
    )
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        lines, orders.o_orderkey == lines.l_orderkey, "left"
    )

    def text(number):
        return number.cast("string")

    decade = F.floor(F.col("o_totalprice") / 50000) * 10
    low, high = F.col("low_part"), F.col("high_part")
    return joined.select(
        F.col("o_orderkey").alias("encounter_id"),
        F.col("o_custkey").alias("patient_nbr"),
        F.when(F.col("c_nationkey") == 7, "?").otherwise(F.col("c_mktsegment")).alias("race"),
        F.when(F.col("o_orderstatus") == "F", "Female").when(F.col("o_orderstatus") == "O", "Male")
        .otherwise("Unknown/Invalid").alias("gender"),
        F.floor(F.col("o_totalprice") / 5000).alias("age"),
        F.concat(F.lit("["), text(decade), F.lit("-"), text(decade + 10), F.lit(")")).alias("age_bracket"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("admission_type_id"),
        (F.col("c_nationkey") + 1).cast("int").alias("discharge_disposition_id"),
        F.col("n_lines").alias("time_in_hospital"),
        F.col("quantity").cast("long").alias("num_lab_procedures"),
        F.col("returned").alias("num_procedures"),
        F.col("open_lines").alias("num_medications"),
        (F.col("c_nationkey") % 5).cast("long").alias("number_outpatient"),
        (F.col("o_custkey") % 7).alias("number_emergency"),
        (F.col("supplier") % 10).alias("number_inpatient"),
        (1 + F.day("o_orderdate") % 9).cast("long").alias("number_diagnoses"),
        F.when(low % 11 == 0, F.concat(F.lit("V"), text(low % 100))).when(low % 13 == 0, "250.83")
        .otherwise(text(low % 1000)).alias("diag_1"),
        F.when(high % 17 == 0, "250").otherwise(text(high % 1000)).alias("diag_2"),
        F.when(F.col("returned") > 1, F.concat(text((low + high) % 1000), F.lit(".5"))).otherwise("").alias("diag_3"),
        F.when((F.col("quantity") > 150) | (F.col("o_totalprice") > 470000), "<30")
        .when(F.col("o_orderpriority") < "3", ">30").otherwise("NO").alias("readmitted"),
    )


def with_encounters(body: str) -> str:
    """SQL of a query over ``encounters``."""
    return f"WITH {SQL.strip()}{body}"

"""Cleaning, derived columns and data-quality queries (A, C, D, F rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.catalog.encounters import encounters, with_encounters
from tabwright.catalog.registry import query
from tabwright.functions import (
    at_least,
    bracket_midpoint,
    code_group,
    confidence,
    cut,
    fill_missing,
    finite_or_zero,
    map_values,
    positive_probability,
    row_sum,
    to_number,
)
from tabwright.operators.clean import (
    columns_like,
    drop_columns,
    exclude_values,
    keep_declared,
    null_sentinels,
    numbers_with_median_fill,
    string_columns,
)
from tabwright.operators.profile import value_counts
from tabwright.operators.quality import all_passed, check_all, require_valid, rule_report
from tabwright.params import (
    AGE_EDGES,
    AGE_LABELS,
    DEATH_DISPOSITIONS,
    DIAGNOSIS_GROUPS,
    STAY_EDGES,
    STAY_LABELS,
    TARGET_TO_BINARY,
    FeatureParams,
    WorkflowParams,
)
from tabwright.plans.exploration import encode_table
from tabwright.plans.features import derive_features, group_diagnoses
from tabwright.session import settle, shared_folder
from tabwright.sources.tables import parquet, read_csv

NUMBER_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def sql_group(column: str) -> str:
    """F1 in SQL over a text column."""
    number = f"(CASE WHEN regexp_matches({column}, '{NUMBER_RE}') THEN try_cast({column} AS DOUBLE) END)"
    whens = []
    for name, ranges in DIAGNOSIS_GROUPS:
        test = " OR ".join(f"{number} BETWEEN {a} AND {b}" for a, b in ranges)
        whens.append(f"WHEN {test} THEN '{name}'")
    return f"CASE {' '.join(whens)} ELSE 'Other' END"


def sql_cut(column: str, edges, labels) -> str:
    """F4 in SQL."""
    whens = [f"WHEN {column} > {a} AND {column} <= {b} THEN '{n}'" for a, b, n in zip(edges, edges[1:], labels)]
    return f"CASE {' '.join(whens)} END"


CLEANED = """, cleaned AS (
  SELECT * REPLACE (nullif(nullif(race, '?'), 'Unknown/Invalid') AS race,
                    nullif(nullif(gender, '?'), 'Unknown/Invalid') AS gender)
  FROM encounters WHERE discharge_disposition_id NOT IN (11, 13, 14, 19, 20, 21)
)
"""


def cleaned(spark, folder):
    """Sentinels nulled, deaths left out: the start of the exploratory flow."""
    return exclude_values(
        null_sentinels(encounters(spark, folder)), "discharge_disposition_id", DEATH_DISPOSITIONS
    )


@query("a1_csv_scan", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_totalprice,
  CASE WHEN o_orderkey % 10 = 0 THEN 'None' ELSE o_orderpriority END AS level
FROM orders
""")
def _(spark, folder):
    path = shared_folder(spark)
    orders = parquet(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "NA").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_totalprice",
        F.when(F.col("o_orderkey") % 10 == 0, "None").otherwise(F.col("o_orderpriority")).alias("level"),
    )
    orders.write.csv(path, header=True)
    return read_csv(spark, path, "o_orderkey bigint, o_orderstatus string, o_totalprice double, level string")


@query("a1_csv_line_breaks", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus || chr(10) || 'said "yes", ' || chr(10) || chr(10) || o_orderpriority
  WHEN o_orderkey % 3 = 1 THEN '""' ELSE NULL END AS note, o_totalprice
FROM orders
""")
def _(spark, folder):
    path = shared_folder(spark)
    note = F.concat("o_orderstatus", F.lit('\nsaid "yes", \n\n'), "o_orderpriority")
    orders = parquet(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, note).when(F.col("o_orderkey") % 3 == 1, '""').alias("note"), "o_totalprice")
    orders.write.csv(path, header=True, escape='"')
    return read_csv(spark, path, "o_orderkey bigint, note string, o_totalprice double")


@query("c1_drop_columns", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def _(spark, folder):
    return drop_columns(parquet(spark, folder, "customer"), ["c_name", "c_mktsegment", "absent"])


@query("c3_declared_columns", "SELECT l_quantity, l_tax, l_returnflag FROM lineitem")
def _(spark, folder):
    return keep_declared(parquet(spark, folder, "lineitem"), ["l_quantity", "l_tax"], ["l_returnflag"])


@query("c4_not_in_keeps_null", """
SELECT event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total
FROM (SELECT nullif(event_type, 'error') AS event_type, value FROM events)
WHERE coalesce(event_type NOT IN ('click', 'view'), true) GROUP BY event_type
""")
def _(spark, folder):
    events = parquet(spark, folder, "events").withColumn("event_type", F.nullif("event_type", F.lit("error")))
    kept = exclude_values(events, "event_type", ["click", "view"])
    return kept.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")
    )


@query("c5_sentinels_to_null", with_encounters(CLEANED + """
SELECT encounter_id, race, gender, discharge_disposition_id FROM cleaned
"""))
def _(spark, folder):
    return cleaned(spark, folder).select("encounter_id", "race", "gender", "discharge_disposition_id")


@query("c6_text_columns", "SELECT o_orderstatus, o_orderpriority FROM orders")
def _(spark, folder):
    orders = parquet(spark, folder, "orders")
    return orders.select(string_columns(orders))


@query("d5_rule_report", """
WITH f AS (
  SELECT count_if(o_orderkey IS NULL OR o_custkey IS NULL OR status IS NULL OR o_totalprice IS NULL
      OR o_orderdate IS NULL OR o_orderpriority IS NULL) AS nulls,
    count_if(NOT status IN ('F', 'O')) AS off_domain
  FROM (SELECT *, nullif(o_orderstatus, 'P') AS status FROM orders)
)
SELECT 'required_columns' AS "check", false AS passed, CAST(1 AS BIGINT) AS failures
UNION ALL SELECT 'missing_values', nulls = 0, CAST(nulls AS BIGINT) FROM f
UNION ALL SELECT 'integer_types', false, CAST(1 AS BIGINT)
UNION ALL SELECT 'target_domain', off_domain = 0, CAST(off_domain AS BIGINT) FROM f
""")
def _(spark, folder):
    orders = parquet(spark, folder, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    return rule_report(
        orders, ["o_orderkey", "o_custkey", "absent"], ["o_orderkey", "o_totalprice"], "o_orderstatus", ["F", "O"]
    )


@query("d5_first_broken_rule", """
WITH t AS (SELECT o_orderpriority AS part, CASE WHEN o_orderpriority < '3' THEN nullif(o_orderstatus, 'P') ELSE o_orderstatus END AS status FROM orders
  WHERE o_orderpriority < '5' OR o_orderstatus <> 'P'),
f AS (SELECT part, count_if(status IS NULL) AS nulls, count_if(NOT status IN ('F', 'O')) AS off_domain FROM t GROUP BY part)
SELECT part, CASE WHEN nulls > 0 THEN 'Data contains missing values'
  WHEN off_domain > 0 THEN 'Target variable must contain only ''F'' or ''O''' ELSE 'valid' END AS outcome FROM f
UNION ALL SELECT 'all', CASE WHEN sum(nulls) > 0 THEN 'Data contains missing values' ELSE 'valid' END FROM f
UNION ALL SELECT 'without status', 'Missing required columns: [''o_orderstatus'']'
UNION ALL SELECT 'by price', 'o_totalprice must be numeric'
""")
def _(spark, folder):
    low, partial = F.col("o_orderpriority") < "3", F.col("o_orderstatus") == "P"
    orders = settle(parquet(spark, folder, "orders").where((F.col("o_orderpriority") < "5") | ~partial).withColumn(
        "o_orderstatus", F.when(low & partial, None).otherwise(F.col("o_orderstatus"))))

    def outcome(rows, integers=("o_orderkey",)):
        try:
            require_valid(rows, ["o_orderkey", "o_orderstatus"], integers, "o_orderstatus", ["F", "O"])
        except ValueError as error:
            return str(error)
        return "valid"

    parts = sorted(r[0] for r in orders.select("o_orderpriority").distinct().collect())
    found = [(p, outcome(orders.where(F.col("o_orderpriority") == p))) for p in parts]
    found += [("all", outcome(orders)), ("without status", outcome(orders.drop("o_orderstatus"))),
              ("by price", outcome(orders.where(F.col("o_orderstatus").isNotNull()), ["o_totalprice"]))]
    return spark.createDataFrame(found, "part string, outcome string")


_SHARES = " , ".join(
    f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)" for c in (
        "race", "gender", "age", "time_in_hospital", "num_lab_procedures", "num_procedures",
        "num_medications", "number_inpatient", "diag_1", "diag_2", "diag_3",
    )
)


@query("d10_check_all", with_encounters(CLEANED + f"""
, shares AS (SELECT greatest({_SHARES}) AS worst FROM cleaned),
classes AS (SELECT min(n) * 1.0 / sum(n) AS least FROM (SELECT count(*) AS n FROM cleaned GROUP BY readmitted))
SELECT 'schema' AS "check", false AS passed, CAST(1.0 AS DOUBLE) AS detail
UNION ALL SELECT 'data_types', true, CAST(0.0 AS DOUBLE)
UNION ALL SELECT 'missing_values', worst <= 0.25, round(CAST(worst AS DOUBLE), 6) FROM shares
UNION ALL SELECT 'target_distribution', least >= 0.01, round(CAST(least AS DOUBLE), 6) FROM classes
"""))
def _(spark, folder):
    params = WorkflowParams(null_share_limit=0.25)  # age_group is not derived yet, so the schema check fails
    return check_all(cleaned(spark, folder), params).withColumn("detail", F.round("detail", 6))


_LIMITS = (0.01, 0.2, 0.21, 0.25, 0.5)


@query("d11_gate", with_encounters(CLEANED + f"""
, shares AS (SELECT greatest({_SHARES}) AS worst FROM cleaned),
classes AS (SELECT min(n) * 1.0 / sum(n) AS least FROM (SELECT count(*) AS n FROM cleaned GROUP BY readmitted)),
limits AS (SELECT unnest([{', '.join(map(str, _LIMITS))}])::DOUBLE AS null_share)
SELECT null_share, worst <= null_share AND least >= 0.01 AS passed FROM limits, shares, classes
"""))
def _(spark, folder):
    table = settle(cleaned(spark, folder))
    features = FeatureParams(numeric=("age", "num_lab_procedures"), categorical=("race", "gender"))
    return spark.createDataFrame(
        [(x, all_passed(check_all(table, WorkflowParams(features=features, null_share_limit=x)))) for x in _LIMITS], "null_share double, passed boolean")


_FILLED = ("time_in_hospital", "num_lab_procedures", "num_procedures", "number_diagnoses")


@query("c8_encoded_table", with_encounters(CLEANED + f"""
SELECT encounter_id, CAST(dense_rank() OVER (ORDER BY coalesce(race, 'Missing')) - 1 AS DOUBLE) AS race,
  CAST(dense_rank() OVER (ORDER BY coalesce(gender, 'Missing')) - 1 AS DOUBLE) AS gender,
  CAST(dense_rank() OVER (ORDER BY discharge_disposition_id) - 1 AS DOUBLE) AS discharge_disposition_id,
  {', '.join(f"coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM cleaned)) AS {c}" for c in _FILLED)},
  CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END AS label FROM cleaned
"""))
def _(spark, folder):
    table, _ = encode_table(settle(cleaned(spark, folder)), "encounter_id")
    return table.select("encounter_id", "race", "gender", "discharge_disposition_id", *_FILLED, "label")


@query("f1_code_group", with_encounters(f"""
SELECT encounter_id, {sql_group('diag_1')} AS group_1, {sql_group('diag_3')} AS group_3 FROM encounters
"""))
def _(spark, folder):
    return encounters(spark, folder).select(
        "encounter_id", code_group(F.col("diag_1")).alias("group_1"), code_group(F.col("diag_3")).alias("group_3")
    )


@query("f2_diagnosis_counts", with_encounters(CLEANED + f"""
SELECT {sql_group('diag_1')} AS diag_1_category, CAST(count(*) AS BIGINT) AS n FROM cleaned GROUP BY 1
"""))
def _(spark, folder):
    return value_counts(group_diagnoses(cleaned(spark, folder)), "diag_1_category")


@query("f3_bracket_midpoint", with_encounters("""
, b AS (SELECT encounter_id, CASE WHEN age > 95 THEN '>' || CAST(age AS VARCHAR) ELSE age_bracket END AS bracket FROM encounters)
SELECT encounter_id, CASE WHEN len(regexp_extract_all(bracket, '[0-9]+')) = 2
  THEN (CAST(regexp_extract_all(bracket, '[0-9]+')[1] AS DOUBLE) + CAST(regexp_extract_all(bracket, '[0-9]+')[2] AS DOUBLE)) / 2.0
  END AS age_midpoint FROM b
"""))
def _(spark, folder):
    bracket = F.when(F.col("age") > 95, F.concat(F.lit(">"), F.col("age").cast("string"))).otherwise(
        F.col("age_bracket")
    )
    return encounters(spark, folder).select("encounter_id", bracket_midpoint(bracket).alias("age_midpoint"))


@query("f4_age_group", f"""
SELECT {sql_cut('p_size', AGE_EDGES, AGE_LABELS)} AS age_group, CAST(count(*) AS BIGINT) AS n FROM part GROUP BY 1
""")
def _(spark, folder):
    group = cut(F.col("p_size"), AGE_EDGES, AGE_LABELS).alias("age_group")
    return parquet(spark, folder, "part").groupBy(group).agg(F.count(F.lit(1)).alias("n"))


@query("f5_stay_group", f"""
SELECT l_orderkey, l_linenumber, {sql_cut('l_quantity', STAY_EDGES, STAY_LABELS)} AS stay FROM lineitem
""")
def _(spark, folder):
    return parquet(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", cut(F.col("l_quantity"), STAY_EDGES, STAY_LABELS).alias("stay")
    )


@query("f6_row_sum_skips_null", """
SELECT l_orderkey, l_partkey, l_linenumber,
  coalesce(nullif(l_quantity, 10), 0) + coalesce(nullif(l_tax, 0), 0) AS total, 0 AS nothing FROM lineitem
""")
def _(spark, folder):
    lines = parquet(spark, folder, "lineitem")
    parts = [F.nullif("l_quantity", F.lit(10.0)), F.nullif("l_tax", F.lit(0.0))]
    return lines.select(
        "l_orderkey", "l_partkey", "l_linenumber", row_sum(parts).alias("total"), row_sum([]).alias("nothing")
    )


@query("f7_sum_by_name_pattern", """
SELECT l_orderkey, l_partkey, l_linenumber,
  round(coalesce(nullif(l_extendedprice, 0), 0) + coalesce(nullif(l_discount, 0.05), 0), 6) AS total FROM lineitem
""")
def _(spark, folder):
    lines = parquet(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.col("l_extendedprice").alias("Amount_price"),
        F.nullif("l_discount", F.lit(0.05)).alias("amount_discount"),
    )
    total = row_sum(F.col(c) for c in columns_like(lines, "AMOUNT"))
    return lines.select("l_orderkey", "l_partkey", "l_linenumber", F.round(total, 6).alias("total"))


@query("f8_text_to_number", f"""
WITH t AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN '12d' WHEN event_id % 7 = 1 THEN ' 1e3 '
  WHEN event_id % 7 = 2 THEN 'abc' WHEN event_id % 7 = 3 THEN '' ELSE CAST(value AS VARCHAR) END AS x FROM events)
SELECT event_id, CASE WHEN regexp_matches(x, '{NUMBER_RE}') THEN try_cast(trim(x) AS DOUBLE) END AS number FROM t
""")
def _(spark, folder):
    kind = F.col("event_id") % 7
    text = (
        F.when(kind == 0, "12d").when(kind == 1, " 1e3 ").when(kind == 2, "abc").when(kind == 3, "")
        .otherwise(F.col("value").cast("string"))
    )
    return parquet(spark, folder, "events").select("event_id", to_number(text).alias("number"))


@query("f9_fill_missing", """
SELECT coalesce(nullif(event_type, 'view'), 'Missing') AS event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1
""")
def _(spark, folder):
    level = fill_missing(F.nullif("event_type", F.lit("view"))).alias("event_type")
    return parquet(spark, folder, "events").groupBy(level).agg(F.count(F.lit(1)).alias("n"))


@query("f10_finite_or_zero", """
SELECT event_id, CASE WHEN event_id % 5 IN (0, 1) THEN 0.0 WHEN event_id % 5 = 2 THEN 1.7976931348623157e308
  ELSE value END AS x FROM events
""")
def _(spark, folder):
    kind = F.col("event_id") % 5
    x = (
        F.when(kind == 0, F.lit(float("nan"))).when(kind == 1, F.lit(None))
        .when(kind == 2, F.lit(float("inf"))).otherwise(F.col("value"))
    )
    return parquet(spark, folder, "events").select("event_id", finite_or_zero(x).alias("x"))


@query("f11_target_map", with_encounters("""
SELECT encounter_id, CASE readmitted WHEN '<30' THEN 1 WHEN '>30' THEN 0 WHEN 'NO' THEN 0 END AS readmitted_binary
FROM encounters
"""))
def _(spark, folder):
    return encounters(spark, folder).select(
        "encounter_id", map_values(F.col("readmitted"), TARGET_TO_BINARY).alias("readmitted_binary")
    )


@query("f12_confidence_mask", """
WITH p AS (SELECT event_id, 1.0 / (1.0 + value) AS p1 FROM events)
SELECT event_id, round(greatest(1.0 - p1, p1), 8) AS confidence, round(p1, 8) AS score,
  greatest(1.0 - p1, p1) >= 0.8 AS high_confidence FROM p
""")
def _(spark, folder):
    p1 = F.lit(1.0) / (F.lit(1.0) + F.col("value"))
    scored = parquet(spark, folder, "events").select("event_id", F.array(F.lit(1.0) - p1, p1).alias("probability"))
    sure = confidence(F.col("probability"), is_vector=False)
    return scored.select(
        "event_id", F.round(sure, 8).alias("confidence"),
        F.round(positive_probability(F.col("probability"), is_vector=False), 8).alias("score"),
        at_least(sure, 0.8).alias("high_confidence"),
    )


@query("f15_derive_features", with_encounters(f"""
SELECT encounter_id, {sql_cut('age', AGE_EDGES, AGE_LABELS)} AS age_group,
  {sql_cut('time_in_hospital', STAY_EDGES, STAY_LABELS)} AS length_of_stay_group,
  coalesce(num_medications, 0) AS num_medications, 0 AS num_diagnoses FROM encounters
"""))
def _(spark, folder):
    return derive_features(encounters(spark, folder), FeatureParams()).select(
        "encounter_id", "age_group", "length_of_stay_group", "num_medications", "num_diagnoses"
    )


@query("g13_numbers_with_median_fill", with_encounters(f"""
, t AS (SELECT encounter_id, num_lab_procedures, time_in_hospital,
    CASE WHEN regexp_matches(diag_1, '{NUMBER_RE}') THEN try_cast(diag_1 AS DOUBLE) END AS diag_1 FROM encounters),
m AS (SELECT median(num_lab_procedures) AS a, median(time_in_hospital) AS b, median(diag_1) AS c FROM t)
SELECT encounter_id, coalesce(CAST(num_lab_procedures AS DOUBLE), a) AS num_lab_procedures,
  coalesce(CAST(time_in_hospital AS DOUBLE), b) AS time_in_hospital, coalesce(diag_1, c) AS diag_1
FROM t, m
"""))
def _(spark, folder):
    table = encounters(spark, folder).select("encounter_id", "num_lab_procedures", "time_in_hospital", "diag_1")
    return numbers_with_median_fill(table, exclude=["encounter_id"])

"""Evaluation queries (J rows, B2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.catalog.registry import query
from tabwright.operators.metrics import (
    area_under,
    classification_report,
    confusion_matrix,
    curves_by_model,
    label_metrics,
    precision_recall_curve,
    roc_auc,
    roc_auc_by_class,
    roc_curve,
)
from tabwright.session import shared_folder
from tabwright.sources import runs
from tabwright.sources.sinks import write_metrics_csv, write_metrics_json
from tabwright.sources.tables import parquet

SCORED = """
s AS (SELECT o_orderstatus AS actual,
    CASE WHEN o_totalprice < 150000 THEN 'F' WHEN o_totalprice < 350000 THEN 'O' ELSE 'X' END AS predicted,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label, floor(o_totalprice / 1000) / 500.0 AS score FROM orders)
"""
PER_CLASS = SCORED + """
, v AS (SELECT actual AS class FROM s UNION SELECT predicted FROM s),
c AS (SELECT class, (SELECT count(*) FROM s WHERE actual = class) AS support, (SELECT count(*) FROM s WHERE predicted = class) AS claimed,
    (SELECT count(*) FROM s WHERE actual = class AND predicted = class) AS hits FROM v),
r AS (SELECT class, support, hits, coalesce(hits / nullif(CAST(claimed AS DOUBLE), 0), 0) AS p, coalesce(hits / nullif(CAST(support AS DOUBLE), 0), 0) AS q,
    coalesce(2 * hits / nullif(CAST(claimed + support AS DOUBLE), 0), 0) AS f FROM c),
w AS (SELECT sum(hits) / CAST(sum(support) AS DOUBLE) AS a, sum(p * support) / sum(support) AS p, sum(q * support) / sum(support) AS q,
    sum(f * support) / sum(support) AS f, avg(p) AS mp, avg(q) AS mq, avg(f) AS mf, CAST(sum(support) AS BIGINT) AS n FROM r)
"""
POINTS = """
, g AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM s GROUP BY score),
c AS (SELECT *, sum(pos) OVER o AS tp, sum(neg) OVER o AS fp, lead(pos) OVER o AS next_pos, lead(neg) OVER o AS next_neg,
    row_number() OVER o AS place, CAST(sum(pos) OVER () AS DOUBLE) AS all_pos, CAST(sum(neg) OVER () AS DOUBLE) AS all_neg
  FROM g WINDOW o AS (ORDER BY score DESC))
"""
_KEPT = "place = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg"
_AUC = "SELECT sum(neg * (2 * tp - pos) / 2.0) / (max(all_pos) * max(all_neg)) AS auc FROM c"


def scored_orders(spark, folder):
    """Three classes with a made-up rule as the judge, and a score with many ties."""
    price = F.col("o_totalprice")
    return parquet(spark, folder, "orders").select(
        F.col("o_orderstatus").alias("actual"),
        F.when(price < 150000, "F").when(price < 350000, "O").otherwise("X").alias("predicted"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        (F.floor(price / 1000) / F.lit(500.0)).alias("score"),
    )


def rounded(df, *columns, places=8):
    return df.withColumns({c: F.round(c, places) for c in columns})


@query("j1_label_metrics", f"""
WITH {PER_CLASS}
SELECT 'accuracy' AS metric, round(a, 8) AS value FROM w UNION ALL SELECT 'precision', round(p, 8) FROM w
UNION ALL SELECT 'recall', round(q, 8) FROM w UNION ALL SELECT 'f1', round(f, 8) FROM w
""")
def _(spark, folder):
    return rounded(label_metrics(scored_orders(spark, folder), "actual", "predicted"), "value")


@query("j7_metrics_with_auc", f"""
WITH {SCORED} {POINTS}, a AS ({_AUC})
SELECT 'accuracy' AS metric, round(avg(CASE WHEN label = (CASE WHEN score >= 0.5 THEN 1 ELSE 0 END) THEN 1.0 ELSE 0.0 END), 8) AS value FROM s
UNION ALL SELECT 'roc_auc', round(auc, 8) FROM a
""")
def _(spark, folder):
    scored = scored_orders(spark, folder).withColumn("guess", (F.col("score") >= 0.5).cast("int"))
    metrics = label_metrics(scored, "label", "guess", "score", metrics=("accuracy", "roc_auc"))
    return rounded(metrics, "value")


@query("b2_metrics_file", f"""
WITH {PER_CLASS} SELECT round(a, 8) AS accuracy, round(f, 8) AS f1, round(p, 8) AS "precision", round(q, 8) AS recall FROM w
""")
def _(spark, folder):
    path = shared_folder(spark)
    names = ("accuracy", "f1", "precision", "recall")
    write_metrics_csv(label_metrics(scored_orders(spark, folder), "actual", "predicted"), path, names)
    stored = spark.read.csv(path, header=True, schema=", ".join(f"{n} double" for n in names))
    return rounded(stored, *stored.columns)


@query("b3_metrics_json", f"""
WITH {PER_CLASS} SELECT round(a, 8) AS accuracy, round(f, 8) AS f1, round(p, 8) AS "precision", round(q, 8) AS recall FROM w
""")
def _(spark, folder):
    path = shared_folder(spark)
    names = ("accuracy", "f1", "precision", "recall")
    write_metrics_json(label_metrics(scored_orders(spark, folder), "actual", "predicted"), path, names)
    stored = spark.read.json(path, schema=", ".join(f"{n} double" for n in names))
    return rounded(stored, *stored.columns)


@query("b9_run_table", f"""
WITH {PER_CLASS}
SELECT 'metric' AS kind, 'accuracy' AS key, round(a, 8) AS value FROM w UNION ALL SELECT 'metric', 'precision', round(p, 8) FROM w
UNION ALL SELECT 'metric', 'recall', round(q, 8) FROM w UNION ALL SELECT 'metric', 'f1', round(f, 8) FROM w
UNION ALL SELECT 'param', 'limit', 150000.0
""")
def _(spark, folder):
    path, run_id = shared_folder(spark), runs.new_run()
    runs.log_params(spark, path, run_id, {"limit": 150000.0})
    runs.log_metrics(label_metrics(scored_orders(spark, folder), "actual", "predicted"), path, run_id)
    logged = runs.read_runs(spark, path).filter(F.col("run_id") == run_id)
    return logged.select("kind", "key", F.round(F.col("value").cast("double"), 8).alias("value"))


@query("j5_roc_auc", f"WITH {SCORED} {POINTS} SELECT round(auc, 10) AS auc FROM ({_AUC})")
def _(spark, folder):
    return rounded(roc_auc(scored_orders(spark, folder)), "auc", places=10)


def _one_class_auc(score):
    return f"""(SELECT sum(neg * (2 * tp - pos) / 2.0) / (sum(pos) * CAST(sum(neg) AS DOUBLE)) FROM (
      SELECT pos, neg, sum(pos) OVER (ORDER BY x DESC) AS tp FROM (
        SELECT {score[1]} AS x, count_if(actual = '{score[0]}') AS pos, count_if(actual <> '{score[0]}') AS neg FROM s GROUP BY 1)))"""


_CLASS_SCORES = (("F", "score"), ("O", "1 - score"), ("P", "abs(score - 0.5)"))


@query("j7_auc_over_classes", f"""
WITH {SCORED} SELECT round(({' + '.join(map(_one_class_auc, _CLASS_SCORES))}) / 3.0, 10) AS auc
""")
def _(spark, folder):
    score = F.col("score")
    scored = scored_orders(spark, folder).withColumn("p", F.array(score, 1 - score, F.abs(score - 0.5)))
    return rounded(roc_auc_by_class(scored, "actual", "p", ["F", "O", "P"]), "auc", places=10)


@query("j8_confusion_matrix", f"""
WITH {SCORED}, v AS (SELECT actual AS class FROM s UNION SELECT predicted FROM s)
SELECT a.class AS actual, p.class AS predicted,
  CAST((SELECT count(*) FROM s WHERE s.actual = a.class AND s.predicted = p.class) AS BIGINT) AS n FROM v a, v p
""")
def _(spark, folder):
    return confusion_matrix(scored_orders(spark, folder), "actual", "predicted")


@query("j9_roc_curve", f"""
WITH {SCORED} {POINTS}
SELECT round(score, 8) AS threshold, round(fp / all_neg, 8) AS fpr, round(tp / all_pos, 8) AS tpr FROM c WHERE {_KEPT}
""")
def _(spark, folder):
    return rounded(roc_curve(scored_orders(spark, folder)), "threshold", "fpr", "tpr")


@query("j10_precision_recall_curve", f"""
WITH {SCORED} {POINTS}
SELECT round(score, 8) AS threshold, round(tp / CAST(tp + fp AS DOUBLE), 8) AS precision, round(tp / all_pos, 8) AS recall FROM c
UNION ALL SELECT 1.0, 1.0, 0.0
""")
def _(spark, folder):
    return rounded(precision_recall_curve(scored_orders(spark, folder)), "threshold", "precision", "recall")


@query("j11_trapezoid_area", f"""
WITH {SCORED} {POINTS}, p AS (SELECT fp / all_neg AS x, tp / all_pos AS y FROM c UNION ALL SELECT 0.0, 0.0),
d AS (SELECT x - lag(x) OVER o AS dx, (y + lag(y) OVER o) / 2 AS h FROM p WINDOW o AS (ORDER BY x, y))
SELECT round(sum(dx * h), 8) AS auc FROM d
""")
def _(spark, folder):
    curve = roc_curve(scored_orders(spark, folder), keep_start=True, drop_collinear=False)
    return rounded(area_under(curve, "fpr", "tpr").withColumnRenamed("area", "auc"), "auc")


@query("j12_classification_report", f"""
WITH {PER_CLASS}
SELECT class, round(p, 8) AS precision, round(q, 8) AS recall, round(f, 8) AS f1, CAST(support AS BIGINT) AS support FROM r
UNION ALL SELECT 'accuracy', round(a, 8), round(a, 8), round(a, 8), n FROM w
UNION ALL SELECT 'macro avg', round(mp, 8), round(mq, 8), round(mf, 8), n FROM w
UNION ALL SELECT 'weighted avg', round(p, 8), round(q, 8), round(f, 8), n FROM w
""")
def _(spark, folder):
    report = classification_report(scored_orders(spark, folder), "actual", "predicted")
    return rounded(report, "precision", "recall", "f1")


@query("j15_curves_by_model", f"""
WITH {SCORED} {POINTS},
s2 AS (SELECT label, 1 - score AS score FROM s),
g2 AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM s2 GROUP BY score),
c2 AS (SELECT *, sum(pos) OVER o AS tp, sum(neg) OVER o AS fp, lead(pos) OVER o AS next_pos, lead(neg) OVER o AS next_neg,
    row_number() OVER o AS place, CAST(sum(pos) OVER () AS DOUBLE) AS all_pos, CAST(sum(neg) OVER () AS DOUBLE) AS all_neg
  FROM g2 WINDOW o AS (ORDER BY score DESC))
SELECT 'high' AS model, round(fp / all_neg, 8) AS fpr, round(tp / all_pos, 8) AS tpr FROM c WHERE {_KEPT}
UNION ALL SELECT 'low', round(fp / all_neg, 8), round(tp / all_pos, 8) FROM c2 WHERE {_KEPT}
UNION ALL SELECT 'high', 0.0, 0.0 UNION ALL SELECT 'low', 0.0, 0.0
""")
def _(spark, folder):
    scored = scored_orders(spark, folder)
    flipped = scored.withColumn("score", 1 - F.col("score"))
    return rounded(curves_by_model({"high": scored, "low": flipped}).drop("threshold"), "fpr", "tpr")

"""Model queries (I, K, L rows).

Rows only where draws differ between engines; exact trees, the logistic optimum and Gaussian naive Bayes have SQL, the
last with the same saving, scoring, writing and judging. Every query trains on the whole table at the default settings.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.catalog.encounters import encounters, with_encounters
from tabwright.catalog.registry import query
from tabwright.operators.learn import (
    COMPARED,
    ModelOutcome,
    best_model,
    compare,
    cross_validate,
    fit_vectors,
    run_protocol,
    train,
    with_scores,
)
from tabwright.operators.logistic import fit_logistic
from tabwright.operators.metrics import label_metrics
from tabwright.operators.prepare import vector_names
from tabwright.operators.select import assemble, ranked_importances
from tabwright.operators.split import part, stratified_folds, stratified_split
from tabwright.operators.trees import TreeParams, fit_trees
from tabwright.params import FeatureParams, ModelParams, WorkflowParams
from tabwright.plans.exploration import ExplorationParams, clean_table, encode_table, run_exploration
from tabwright.plans.features import derive_features
from tabwright.plans.scoring import Scorer, score_files
from tabwright.plans.training import run_training
from tabwright.session import laid_out, settle, shared_folder
from tabwright.sources.models import save_model
from tabwright.sources.sinks import write_labelled_predictions
from tabwright.streaming.scoring import score_arriving_files

def raw_encounters(spark, folder) -> DataFrame:
    """Encounters with the age as a bracket text, as the exploratory flow reads it."""
    table = encounters(spark, folder)
    return table.drop("age").withColumnRenamed("age_bracket", "age")


def modelling_table(spark, folder) -> DataFrame:
    """Encounters with derived features, written once as training passes over them often."""
    return laid_out(settle(derive_features(encounters(spark, folder), FeatureParams())), "encounter_id")


def modelling_parts(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Rows to fit on, laid out, and rows to judge the fit by."""
    table = settle(derive_features(encounters(spark, folder), FeatureParams()))
    split = stratified_split(table, "encounter_id", "readmitted").assign(table)
    return laid_out(part(split, "train").drop("split"), "encounter_id"), part(split, "test").drop("split")


def vectors(spark, folder) -> DataFrame:
    """Encoded encounters as ``features`` and ``label`` with the key, written once."""
    table, features = encode_table(settle(clean_table(raw_encounters(spark, folder))), "encounter_id")
    return assemble(settle(table), features).select(
        "encounter_id", "features", F.col("label").cast("double").alias("label")
    )


def train_and_test(spark, folder) -> tuple[DataFrame, DataFrame]:
    table = vectors(spark, folder)
    split = stratified_split(table, "encounter_id", "label").assign(table)
    return part(split, "train"), part(split, "test")


def compared(name: str, key: str = "encounter_id"):
    """Settings of one of the four compared models; draws go by the key."""
    settings = COMPARED[name]
    return replace(settings, key=key) if isinstance(settings, TreeParams) else settings


def metrics_of(name: str, spark, folder) -> DataFrame:
    train_rows, test_rows = train_and_test(spark, folder)
    fitted = fit_vectors(train_rows, name, 100, compared(name))
    scored = with_scores(fitted.transform(test_rows))
    return label_metrics(scored, "label", "prediction", "score", 1.0)


@query("i1_forest_metrics")
def _(spark, folder):
    fitted_on, judged = modelling_parts(spark, folder)
    model = train(fitted_on, FeatureParams(), ModelParams())
    return label_metrics(Scorer(model).predict(judged), "readmitted", "prediction")


@query("i6_logistic_regression")
def _(spark, folder):
    return metrics_of("logistic_regression", spark, folder)


@query("i7_decision_tree")
def _(spark, folder):
    return metrics_of("decision_tree", spark, folder)


_TREE = ("age", "num_medications", "number_inpatient", "number_emergency")


def _tree_sql(depth: int, min_split: int) -> str:
    """Nodes of the exact entropy tree, level by level: the counts of all candidates, their gains, the best one of each node."""
    def entropy(pos: str, all_: str) -> str:
        terms = [f"CASE WHEN {k} > 0 THEN {k} / {all_} * log2({k} / {all_}) ELSE 0 END" for k in (f"({all_} - {pos})", pos)]
        return f"(-({terms[0]} + {terms[1]}))"

    steps = ["""
, l0 AS (SELECT encounter_id, CASE WHEN readmitted = '<30' THEN 1.0::DOUBLE ELSE 0.0 END AS y,
  ["""[1:] + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0)" for c in _TREE) + "] AS x, '' AS path FROM encounters)"]
    for d in range(depth):
        steps.append(f"""
v{d} AS (SELECT path, f, x[f + 1] AS v, count(*)::DOUBLE AS n, sum(y) AS p FROM l{d}, (SELECT unnest(range({len(_TREE)})) AS f) GROUP BY 1, 2, 3),
c{d} AS (SELECT path, f, v, lead(v) OVER w AS nx, sum(n) OVER w AS nl, sum(p) OVER w AS pl, sum(n) OVER (PARTITION BY path, f) AS n,
  sum(p) OVER (PARTITION BY path, f) AS p FROM v{d} WINDOW w AS (PARTITION BY path, f ORDER BY v)),
g{d} AS (SELECT path, f, v / 2 + nx / 2 AS t, round({entropy('p', 'n')} - (nl * {entropy('pl', 'nl')} + (n - nl) * {entropy('(p - pl)', '(n - nl)')}) / n, 12) AS gain
  FROM c{d} WHERE nx IS NOT NULL AND n >= {min_split} AND p > 0 AND p < n),
b{d} AS (SELECT * FROM g{d} QUALIFY row_number() OVER (PARTITION BY path ORDER BY gain DESC, f, t) = 1),
l{d + 1} AS (SELECT encounter_id, y, x, l.path || CASE WHEN x[f + 1] <= t THEN 'L' ELSE 'R' END AS path FROM l{d} l JOIN b{d} b ON l.path = b.path)""")
    none = "SELECT path, NULL::BIGINT AS f, NULL::DOUBLE AS t, NULL::DOUBLE AS gain FROM l0 WHERE false"
    nodes = " UNION ALL ".join(
        f"SELECT a.path, CAST(coalesce(f, -1) AS INTEGER) AS feature, round(coalesce(t, 0), 6) AS threshold, round(coalesce(gain, 0), 9) AS gain, a.n, a.positives "
        f"FROM (SELECT path, count(*)::DOUBLE AS n, sum(y) AS positives FROM l{d} GROUP BY path) a LEFT JOIN {f'b{d}' if d < depth else f'({none})'} b ON a.path = b.path"
        for d in range(depth + 1))
    return ",".join(steps) + ", nodes AS (" + nodes + ")"


def exact_tree(spark, folder, **settings):
    rows = encounters(spark, folder).select(
        F.array(*(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in _TREE)).alias("features"), (F.col("readmitted") == "<30").cast("double").alias("label"))
    return fit_trees(rows, TreeParams(impurity="entropy", min_split=10, **settings))


@query("i7_exact_tree", with_encounters(_tree_sql(4, 10) + " SELECT * FROM nodes"))
def _(spark, folder):
    # a small piece, so that upper nodes are split by counts over the table and lower ones in one step
    shown = exact_tree(spark, folder, max_depth=4, piece=2_000).rules(4)
    return shown.select("path", "feature", F.round("threshold", 6).alias("threshold"), F.round("gain", 9).alias("gain"), "n",
                        F.get("counts", F.lit(1)).alias("positives"))


@query("g15_exact_importances", with_encounters(_tree_sql(4, 10) + f"""
SELECT ['{"', '".join(_TREE)}'][f + 1] AS feature, round(coalesce(sum(gain * n), 0) / (SELECT sum(gain * n) FROM nodes), 6) AS importance
FROM (SELECT unnest(range({len(_TREE)})) AS f) LEFT JOIN nodes ON feature = f GROUP BY f
"""))
def _(spark, folder):
    found = exact_tree(spark, folder, max_depth=4).featureImportances.toArray()
    return ranked_importances(encounters(spark, folder), _TREE, found).withColumn("importance", F.round("importance", 6))


def _newton_sql(steps: int) -> str:
    """Newton steps for two columns and an intercept, all penalised, the three equations solved by determinants."""
    def det(rows: list[list[str]]) -> str:
        (a, b, c), (d, e, f), (g, h, i) = rows
        return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"

    names, out = ("a", "b", "1.0"), []
    for k in range(steps):
        p = "1 / (1 + exp(-(w0 * a + w1 * b + w2)))"
        sums = ", ".join([f"w{i} + sum(({p} - y) * {names[i]}) AS g{i}" for i in range(3)] + [
            f"{1 if i == j else 0} + sum({p} * (1 - {p}) * {names[i]} * {names[j]}) AS h{i}{j}" for i in range(3) for j in range(i, 3)])
        h = [[f"h{min(i, j)}{max(i, j)}" for j in range(3)] for i in range(3)]
        moved = ", ".join(f"w{c} - {det([[f'g{i}' if j == c else h[i][j] for j in range(3)] for i in range(3)])} / {det(h)} AS w{c}" for c in range(3))
        out.append(f"s{k} AS (SELECT w0, w1, w2, {sums} FROM t, w{k} GROUP BY w0, w1, w2), w{k + 1} AS (SELECT {moved} FROM s{k})")
    return ", w0 AS (SELECT 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2), " + ", ".join(out)


@query("i6_logistic_optimum", with_encounters(f"""
, f AS (SELECT encounter_id, CAST(age AS DOUBLE) / 100 AS a, coalesce(CAST(num_lab_procedures AS DOUBLE), 0) / 100 AS b,
    CASE WHEN readmitted = '<30' THEN 1.0 ELSE 0.0 END AS y FROM encounters),
t AS (SELECT * FROM f){_newton_sql(12)}
SELECT round(w0, 6) AS age, round(w1, 6) AS labs, round(w2, 6) AS intercept,
  round((SELECT sqrt(pow(w.w0 + sum((1 / (1 + exp(-(w.w0 * a + w.w1 * b + w.w2))) - y) * a), 2) + pow(w.w1 + sum((1 / (1 + exp(-(w.w0 * a + w.w1 * b + w.w2))) - y) * b), 2)
    + pow(w.w2 + sum(1 / (1 + exp(-(w.w0 * a + w.w1 * b + w.w2))) - y), 2)) FROM t), 4) AS gradient
FROM w12 w
"""))
def _(spark, folder):
    rows = settle(encounters(spark, folder).select(
        F.array(F.col("age").cast("double") / 100, F.coalesce(F.col("num_lab_procedures").cast("double"), F.lit(0.0)) / 100).alias("features"),
        (F.col("readmitted") == "<30").cast("double").alias("label")))
    a, b, c = (float(v) for v in fit_logistic(rows).weights[0])
    x, y = F.get("features", F.lit(0)), F.get("features", F.lit(1))
    off = F.lit(1.0) / (F.lit(1.0) + F.exp(-(a * x + b * y + c))) - F.col("label")
    return rows.agg(F.sqrt(F.pow(a + F.sum(off * x), 2) + F.pow(b + F.sum(off * y), 2) + F.pow(c + F.sum(off), 2)).alias("g")).select(
        *(F.round(F.lit(v), 6).alias(n) for n, v in (("age", a), ("labs", b), ("intercept", c))), F.round("g", 4).alias("gradient"))


@query("i8_random_forest")
def _(spark, folder):
    return metrics_of("random_forest", spark, folder)


@query("i9_naive_bayes", with_encounters("""
, t AS (SELECT encounter_id, CAST(age AS DOUBLE) AS a, CAST(coalesce(num_lab_procedures, 0) AS DOUBLE) AS b,
    CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END AS label FROM encounters),
e AS (SELECT 1e-9 * greatest(var_pop(a), var_pop(b)) AS eps, count(*) AS n FROM t),
c AS (SELECT label, ln(count(*) / CAST(max(n) AS DOUBLE)) AS prior, avg(a) AS ma, avg(b) AS mb,
    var_pop(a) + max(eps) AS va, var_pop(b) + max(eps) AS vb FROM t, e GROUP BY label),
l AS (SELECT encounter_id, c.label, prior - 0.5 * (ln(2 * pi() * va) + (a - ma) * (a - ma) / va)
    - 0.5 * (ln(2 * pi() * vb) + (b - mb) * (b - mb) / vb) AS loglik FROM t, c),
p AS (SELECT encounter_id, max(CASE WHEN label = 1 THEN loglik END) - max(CASE WHEN label = 0 THEN loglik END) AS odds FROM l GROUP BY 1)
SELECT encounter_id, CASE WHEN odds > 0 THEN 1.0 ELSE 0.0 END AS prediction, round(1 / (1 + exp(-odds)), 6) AS score FROM p
"""))
def _(spark, folder):
    table = encounters(spark, folder).select(
        "encounter_id", F.col("age").cast("double").alias("a"),
        F.coalesce(F.col("num_lab_procedures"), F.lit(0)).cast("double").alias("b"),
        (F.col("readmitted") == "<30").cast("double").alias("label"),
    )
    rows = assemble(table, ["a", "b"])
    scored = with_scores(fit_vectors(rows, "naive_bayes").transform(rows))
    return scored.select("encounter_id", "prediction", F.round("score", 6).alias("score"))


_BAYES = FeatureParams(numeric=("age", "num_lab_procedures"), categorical=())

# scaled columns a and b, their classes, and each row's class probabilities
_BAYES_SQL = """
, f AS (SELECT encounter_id, readmitted, CAST(age AS DOUBLE) AS a,
    coalesce(CAST(num_lab_procedures AS DOUBLE), (SELECT median(num_lab_procedures) FROM encounters)) AS b FROM encounters),
t AS (SELECT encounter_id, readmitted, (a - (SELECT avg(a) FROM f)) / (SELECT stddev_pop(a) FROM f) AS a,
    (b - (SELECT avg(b) FROM f)) / (SELECT stddev_pop(b) FROM f) AS b FROM f),
e AS (SELECT 1e-9 * greatest(var_pop(a), var_pop(b)) AS eps, count(*) AS n FROM t),
c AS (SELECT readmitted AS label, ln(count(*) / CAST(max(n) AS DOUBLE)) AS prior, avg(a) AS ma, avg(b) AS mb,
    var_pop(a) + max(eps) AS va, var_pop(b) + max(eps) AS vb FROM t, e GROUP BY 1),
l AS (SELECT encounter_id, t.readmitted, label, prior - 0.5 * (ln(2 * pi() * va) + (a - ma) * (a - ma) / va)
    - 0.5 * (ln(2 * pi() * vb) + (b - mb) * (b - mb) / vb) AS loglik FROM t, c),
q AS (SELECT encounter_id, readmitted, label, loglik - max(loglik) OVER (PARTITION BY encounter_id) AS loglik FROM l),
p AS (SELECT encounter_id, readmitted, label, exp(loglik) / sum(exp(loglik)) OVER (PARTITION BY encounter_id) AS p FROM q),
s AS (SELECT encounter_id, any_value(readmitted) AS readmitted, arg_max(label, p) AS prediction, max(p) AS confidence,
    sum(p) FILTER (label = '<30') AS p0, sum(p) FILTER (label = '>30') AS p1, sum(p) FILTER (label = 'NO') AS p2
  FROM p GROUP BY encounter_id)
"""


def saved_bayes(spark, table: DataFrame) -> str:
    """Folder of a naive Bayes model with its preparation, fitted on the table."""
    path = f"{shared_folder(spark)}/model"
    save_model(train(table, _BAYES, ModelParams(name="naive_bayes", settings={})), path)
    return path


@query("i5_class_probabilities", with_encounters(_BAYES_SQL + """
SELECT encounter_id, round(p0, 6) AS p0, round(p1, 6) AS p1, round(p2, 6) AS p2 FROM s
"""))
def _(spark, folder):
    table = encounters(spark, folder)
    scored = Scorer.load(saved_bayes(spark, table), _BAYES).predict_proba(table)
    parts = vector_to_array("probability")
    return scored.select("encounter_id", *(F.round(F.get(parts, F.lit(i)), 6).alias(f"p{i}") for i in range(3)))


@query("i14_confidence_of_saved_model", with_encounters(_BAYES_SQL + """
SELECT encounter_id, prediction, round(p1, 6) AS score, round(confidence, 6) AS confidence,
  confidence >= 0.8 AS high_confidence FROM s
"""))
def _(spark, folder):
    table = encounters(spark, folder)
    scored = Scorer.load(saved_bayes(spark, table), _BAYES).predict_with_confidence(table, 0.8)
    return scored.select("encounter_id", "prediction", F.round("score", 6).alias("score"),
                         F.round("confidence", 6).alias("confidence"), "high_confidence")


@query("b4_prediction_files", with_encounters(_BAYES_SQL + """
SELECT prediction, round(p1, 6) AS probability, round(confidence, 6) AS confidence FROM s
"""))
def _(spark, folder):
    table = encounters(spark, folder)
    path = saved_bayes(spark, table)
    score_files(path, table, f"{path}-predictions", _BAYES)
    stored = spark.read.csv(
        f"{path}-predictions", header=True, schema="prediction string, probability double, confidence double"
    )
    return stored.withColumns({c: F.round(c, 6) for c in ("probability", "confidence")})


@query("b5_labelled_prediction_files", with_encounters(_BAYES_SQL + """
SELECT readmitted AS true_label, prediction AS predicted_label, round(confidence, 6) AS confidence_score FROM s
"""))
def _(spark, folder):
    table = encounters(spark, folder)
    path = saved_bayes(spark, table)
    scored = Scorer.load(path, _BAYES).predict_with_confidence(table)
    write_labelled_predictions(scored, _BAYES.target, f"{path}-labelled")
    stored = spark.read.csv(
        f"{path}-labelled", header=True, schema="true_label string, predicted_label string, confidence_score double"
    )
    return stored.withColumn("confidence_score", F.round("confidence_score", 6))


@query("l3_streamed_predictions", with_encounters(_BAYES_SQL + """
SELECT encounter_id, prediction, round(p1, 6) AS score, round(confidence, 6) AS confidence FROM s
"""))
def _(spark, folder):
    table = encounters(spark, folder)
    path = saved_bayes(spark, table)
    table.write.parquet(f"{path}-arriving")
    score_arriving_files(
        spark, Scorer.load(path, _BAYES), f"{path}-arriving", table.schema, f"{path}-scored", f"{path}-progress"
    ).awaitTermination()
    return spark.read.parquet(f"{path}-scored").select(
        "encounter_id", "prediction", F.round("score", 6).alias("score"), F.round("confidence", 6).alias("confidence"))


def _folds_sql(rows: str, folds: int = 10) -> str:
    """``(encounter_id, label, fold)`` of a table with ``encounter_id`` and ``label``."""
    return f"""
SELECT s.encounter_id, s.label, fold FROM (
  SELECT encounter_id, label, row_number() OVER (PARTITION BY label
    ORDER BY ('0x' || substr(md5(encounter_id || ':100'), 1, 15))::BIGINT, encounter_id) - 1 AS r FROM {rows}) s
JOIN (
  SELECT label, fold, sum(dealt) OVER (PARTITION BY label ORDER BY fold) AS stop,
    sum(dealt) OVER (PARTITION BY label ORDER BY fold) - dealt AS start
  FROM (SELECT label, i AS fold, (SELECT count(*) FROM range(n) t(p) WHERE (start + p) % {folds} = i) AS dealt
    FROM (SELECT label, count(*) AS n, sum(count(*)) OVER (ORDER BY label) - count(*) AS start FROM {rows} GROUP BY label),
      (SELECT unnest(range({folds})) AS i))) b
ON s.label = b.label AND r >= start AND r < stop"""


def _accuracy_sql(fit: str, judged: str, columns: str = "ab") -> str:
    """``(round, accuracy)`` of naive Bayes; both tables hold ``round``, ``label`` and the columns."""
    spread = ", ".join(f"var_pop({c})" for c in columns)
    facts = ", ".join(f"avg({c}) AS m{c}, var_pop({c}) + max(eps) AS v{c}" for c in columns)
    loglik = " ".join(f"- 0.5 * (ln(2 * pi() * v{c}) + ({c} - m{c}) * ({c} - m{c}) / v{c})" for c in columns)
    return f"""
SELECT round, avg(CASE WHEN label = guess THEN 1.0 ELSE 0.0 END) AS accuracy FROM (
  SELECT j.round, encounter_id, j.label, arg_max(c.label, prior {loglik}) AS guess FROM {judged} j JOIN (
    SELECT o.round, label, ln(count(*) / CAST(max(n) AS DOUBLE)) AS prior, {facts} FROM {fit} o
    JOIN (SELECT round, 1e-9 * greatest({spread}) AS eps, count(*) AS n FROM {fit} GROUP BY 1) e ON o.round = e.round
    GROUP BY 1, 2) c ON j.round = c.round GROUP BY 1, 2, 3) GROUP BY round"""


_TWO_COLUMNS = """
, t AS (SELECT encounter_id, CAST(age AS DOUBLE) AS a, CAST(coalesce(num_lab_procedures, 0) AS DOUBLE) AS b,
    CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END AS label FROM encounters)"""


def _rounds_sql(rows: str) -> str:
    return f""",
k AS (SELECT x.*, fold AS round FROM {rows} x JOIN ({_folds_sql(rows)}) d ON x.encounter_id = d.encounter_id),
o AS (SELECT k.* REPLACE (i AS round) FROM k, (SELECT unnest(range(10)) AS i) WHERE round <> i)"""


def two_columns(spark, folder) -> DataFrame:
    """Encounters with two numeric columns and a label, stored."""
    return settle(encounters(spark, folder).select(
        "encounter_id", F.col("age").cast("double").alias("a"),
        F.coalesce(F.col("num_lab_procedures"), F.lit(0)).cast("double").alias("b"),
        (F.col("readmitted") == "<30").cast("double").alias("label"),
    ))


@query("i10_bayes_folds", with_encounters(_TWO_COLUMNS + _rounds_sql("t") + f""",
m AS ({_accuracy_sql("o", "k")})
SELECT CAST(round AS VARCHAR) AS fold, round(accuracy, 8) AS accuracy FROM m
UNION ALL SELECT 'mean', round(avg(accuracy), 8) FROM m UNION ALL SELECT 'std', round(stddev_pop(accuracy), 8) FROM m
"""))
def _(spark, folder):
    rows = assemble(two_columns(spark, folder), ["a", "b"])
    folded = settle(stratified_folds(rows, "encounter_id", "label", 10).assign(rows, "fold"))
    scores = cross_validate(folded, "naive_bayes", 10)
    shown = [(str(i), s) for i, s in enumerate(scores.scores)] + [("mean", scores.mean), ("std", scores.std)]
    return spark.createDataFrame([(n, round(v, 8)) for n, v in shown], "fold string, accuracy double")


_BAYES_COMPARED = {"of_both": "ab", "of_age": "a", "of_labs": "b"}

_COMPARISON_SQL = _TWO_COLUMNS + """,
z AS (SELECT t.*, row_number() OVER (PARTITION BY label
    ORDER BY ('0x' || substr(md5(encounter_id || ':100'), 1, 15))::BIGINT, encounter_id) AS r FROM t),
y AS (SELECT label, count(*) AS n, sum(count(*)) OVER () AS total FROM t GROUP BY label),
x AS (SELECT *, n / CAST(total AS DOUBLE) * (total - ceil(0.2 * total)) AS exact FROM y),
w AS (SELECT label, n - floor(exact) - CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, label)
    <= (total - ceil(0.2 * total)) - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS n_test FROM x),
tr AS (SELECT encounter_id, a, b, z.label, 0 AS round FROM z JOIN w ON z.label = w.label WHERE r > n_test),
te AS (SELECT encounter_id, a, b, z.label, 0 AS round FROM z JOIN w ON z.label = w.label WHERE r <= n_test),
u AS (SELECT encounter_id, a, b, label FROM tr)""" + _rounds_sql("u") + ", found AS (" + " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS position, '{name}' AS model, "
    f"(SELECT round(avg(accuracy), 8) FROM ({_accuracy_sql('o', 'k', columns)})) AS cv_accuracy, "
    f"(SELECT round(accuracy, 8) FROM ({_accuracy_sql('tr', 'te', columns)})) AS test_accuracy"
    for i, (name, columns) in enumerate(_BAYES_COMPARED.items())
) + ")"


def bayes_comparison(spark, folder) -> DataFrame:
    """The whole protocol for one classifier on three sets of columns."""
    table = two_columns(spark, folder)
    split = stratified_split(table, "encounter_id", "label").assign(table)
    train_rows, test_rows = part(split, "train").drop("split"), part(split, "test").drop("split")
    folded = settle(stratified_folds(train_rows, "encounter_id", "label", 10).assign(train_rows, "fold"))
    outcomes = [
        replace(run_protocol(assemble(folded, columns), assemble(test_rows, columns), "naive_bayes", 10), name=name)
        for name, columns in _BAYES_COMPARED.items()
    ]
    return compare(outcomes, table)


@query("k5_bayes_comparison", with_encounters(_COMPARISON_SQL + " SELECT * FROM found"))
def _(spark, folder):
    return bayes_comparison(spark, folder).withColumns({c: F.round(c, 8) for c in ("cv_accuracy", "test_accuracy")})


@query("j14_best_of_bayes", with_encounters(
    _COMPARISON_SQL + " SELECT model, test_accuracy FROM found ORDER BY test_accuracy DESC, position LIMIT 1"))
def _(spark, folder):
    return best_model(bayes_comparison(spark, folder)).withColumn("test_accuracy", F.round("test_accuracy", 8))


@query("i10_cross_validation")
def _(spark, folder):
    rows = vectors(spark, folder)
    folded = stratified_folds(rows, "encounter_id", "label", 10).assign(rows, "fold").persist()
    scores = cross_validate(folded, "naive_bayes", 10)
    folded.unpersist()
    table = [(str(i), s) for i, s in enumerate(scores.scores)] + [("mean", scores.mean), ("std", scores.std)]
    return spark.createDataFrame(table, "fold string, accuracy double")


def _outcomes(spark, folder, names) -> list[ModelOutcome]:
    train_rows, test_rows = train_and_test(spark, folder)
    folded = stratified_folds(train_rows, "encounter_id", "label", 10).assign(train_rows, "fold").persist()
    found = [run_protocol(folded, test_rows, n, 10, settings=compared(n)) for n in names]
    folded.unpersist()
    return found


@query("i11_protocol_reports")
def _(spark, folder):
    outcomes = _outcomes(spark, folder, list(COMPARED))
    return reduce(DataFrame.unionByName, (o.report().withColumn("model", F.lit(o.name)) for o in outcomes))


@query("i14_predict_with_confidence")
def _(spark, folder):
    fitted_on, judged = modelling_parts(spark, folder)
    model = train(fitted_on, FeatureParams(), ModelParams())
    scored = Scorer(model).predict_with_confidence(judged, 0.8)
    return scored.select("encounter_id", "prediction", "confidence", "high_confidence")


@query("j13_model_comparison")
def _(spark, folder):
    return compare(_outcomes(spark, folder, list(COMPARED)), vectors(spark, folder))


@query("j14_best_model")
def _(spark, folder):
    outcomes = _outcomes(spark, folder, list(COMPARED))
    return best_model(compare(outcomes, encounters(spark, folder)))


@query("k3_forest_importances")
def _(spark, folder):
    rows = vectors(spark, folder)
    fitted = fit_vectors(rows, "random_forest", 100, compared("random_forest"))
    names = vector_names(rows)
    return ranked_importances(rows, names, fitted.featureImportances.toArray(), ascending=True)


@query("l1_training_run")
def _(spark, folder):
    result = run_training(encounters(spark, folder), shared_folder(spark), WorkflowParams())
    return result.validation.withColumn("part", F.lit("validation")).unionByName(
        result.test.withColumn("part", F.lit("test"))
    )


@query("l2_exploration")
def _(spark, folder):
    # the table has fewer columns than the 20 that the flow keeps by default
    return run_exploration(raw_encounters(spark, folder), ExplorationParams(keep=8)).comparison


@query("l3_batch_scoring")
def _(spark, folder):
    root = shared_folder(spark)
    table = modelling_table(spark, folder)
    save_model(train(table, FeatureParams(), ModelParams()), f"{root}/model")
    score_files(f"{root}/model", table, f"{root}/predictions")
    stored = spark.read.csv(
        f"{root}/predictions", header=True, schema="prediction string, probability double, confidence double"
    )
    return stored.groupBy("prediction").agg(
        F.count(F.lit(1)).alias("n"), F.avg("confidence").alias("mean_confidence")
    )


@query("l3_stream_scoring")
def _(spark, folder):
    root = shared_folder(spark)
    table = modelling_table(spark, folder)
    table.write.parquet(f"{root}/arriving")
    scorer = Scorer(train(table, FeatureParams(), ModelParams()))
    run = score_arriving_files(
        spark, scorer, f"{root}/arriving", table.schema, f"{root}/scored", f"{root}/progress"
    )
    run.awaitTermination()
    stored = spark.read.parquet(f"{root}/scored")
    return stored.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))


import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tabwright.operators import metrics as m


def frame_of(spark, labels, scores):
    rows = [(int(a), float(b)) for a, b in zip(labels, scores)]
    return spark.createDataFrame(rows, "label int, score double")


def full_curve(labels, scores):
    """Rates at every distinct score, highest first, by plain counting."""
    labels, scores = np.array(labels), np.array(scores)
    points = []
    for s in sorted(set(scores), reverse=True):
        passed = labels[scores >= s]
        points.append((s, (passed == 0).sum() / (labels == 0).sum(), (passed == 1).sum() / (labels == 1).sum()))
    return points


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 12)), min_size=2, max_size=60), st.integers(1, 9))
def test_roc_curve_properties(spark, pairs, buckets):
    labels, scores = [p[0] for p in pairs] + [0, 1], [p[1] / 4 for p in pairs] + [1.0, 2.0]
    frame = frame_of(spark, labels, scores)
    expected = full_curve(labels, scores)
    everything = m.roc_curve(frame, drop_collinear=False, buckets=buckets).orderBy(F.desc("threshold")).collect()
    assert np.allclose([tuple(r) for r in everything], expected)
    kept = m.roc_curve(frame, keep_start=True, buckets=buckets).orderBy(F.desc("threshold")).collect()
    x, y = np.array([r["fpr"] for r in kept]), np.array([r["tpr"] for r in kept])
    assert (x[0], y[0], x[-1], y[-1]) == (0, 0, 1, 1) and (np.diff(x) >= 0).all() and (np.diff(y) >= 0).all()
    area = m.roc_auc(frame, buckets=buckets).first()["auc"]
    assert area == pytest.approx(np.trapezoid(y, x))  # dropped points were on the line


def test_auc_agrees_with_the_exact_evaluator(spark):
    frame = spark.range(2000).select(
        (F.xxhash64("id") % 2 == 0).cast("double").alias("label"), (F.pmod(F.xxhash64("id"), 37) / 37).alias("score")
    )
    mine = m.roc_auc(frame, positive=1.0).first()["auc"]
    theirs = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(frame)
    assert mine == pytest.approx(theirs, abs=1e-9)


def test_all_equal_scores_and_single_class(spark):
    flat = frame_of(spark, [0, 1, 1], [0.5] * 3)
    assert [tuple(r) for r in m.roc_curve(flat).collect()] == [(0.5, 1.0, 1.0)]
    assert m.roc_auc(flat).first()["auc"] == 0.5
    one = frame_of(spark, [1, 1], [0.1, 0.9])
    assert m.roc_auc(one).first()["auc"] is None
    assert {r["fpr"] for r in m.roc_curve(one).collect()} == {None}


def test_precision_recall(spark):
    frame = frame_of(spark, [0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8])
    rows = m.precision_recall_curve(frame).orderBy("threshold", F.desc("recall")).collect()
    assert [r["threshold"] for r in rows] == [0.1, 0.35, 0.4, 0.8, 1.0]
    assert np.allclose([r["precision"] for r in rows], [0.5, 2 / 3, 0.5, 1, 1])
    assert np.allclose([r["recall"] for r in rows], [1, 1, 0.5, 0.5, 0])
    none = m.precision_recall_curve(frame_of(spark, [0, 0], [0.1, 0.2])).filter("threshold < 1").collect()
    assert [(r["precision"], r["recall"]) for r in none] == [(0, 1), (0, 1)]


def test_curve_reads_the_table_once_for_points(spark):
    frame = frame_of(spark, [0, 1] * 50, [i / 100 for i in range(100)])
    curve = m.roc_curve(frame)
    curve.collect()
    assert "ReusedExchange" in curve._jdf.queryExecution().executedPlan().toString()


def labelled(spark, pairs):
    return spark.createDataFrame(pairs, "label string, prediction string")


PAIRS = [("NO", "NO")] * 5 + [("NO", "YES")] * 2 + [("YES", "YES")] * 4 + [("YES", "NO")] + [("YES", "ODD")]


def test_label_metrics_agree_with_spark_ml(spark):
    frame = labelled(spark, PAIRS)
    found = {r["metric"]: r["value"] for r in m.label_metrics(frame).collect()}
    codes = frame.select(*(F.element_at(F.create_map(*map(F.lit, ["NO", 0.0, "YES", 1.0, "ODD", 2.0])), F.col(c)).alias(c)
                           for c in ("label", "prediction")))
    for name, theirs in (("accuracy", "accuracy"), ("precision", "weightedPrecision"),
                         ("recall", "weightedRecall"), ("f1", "f1")):
        assert found[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(codes))
    assert all(0 <= v <= 1 for v in found.values())
    assert {r["metric"] for r in m.label_metrics(frame, metrics=["f1"]).collect()} == {"f1"}
    with pytest.raises(ValueError, match="Unknown"):
        m.label_metrics(frame, metrics=["other"])


def test_confusion_grid(spark):
    cells = {(r["actual"], r["predicted"]): r["n"] for r in m.confusion_matrix(labelled(spark, PAIRS)).collect()}
    assert len(cells) == 9 and sum(cells.values()) == len(PAIRS)
    assert cells["YES", "ODD"] == 1 and cells["ODD", "ODD"] == 0


def test_report(spark):
    rows = {r["class"]: r for r in m.classification_report(labelled(spark, PAIRS)).collect()}
    assert set(rows) == {"NO", "YES", "ODD", "accuracy", "macro avg", "weighted avg"}
    assert rows["NO"]["precision"] == pytest.approx(5 / 6) and rows["NO"]["recall"] == pytest.approx(5 / 7)
    assert rows["ODD"]["support"] == 0 and rows["ODD"]["f1"] == 0
    assert rows["macro avg"]["support"] == len(PAIRS) and rows["accuracy"]["f1"] == pytest.approx(9 / 13)


def test_null_labels_are_refused(spark):
    frame = labelled(spark, [("NO", "NO"), (None, "NO")])
    with pytest.raises(Exception, match="label holds a null"):
        m.label_metrics(frame).collect()
    with pytest.raises(Exception, match="label holds a null"):
        m.roc_auc(spark.createDataFrame([(None, 0.1)], "label int, score double")).collect()


def test_auc_over_classes(spark):
    rows = [("a", [0.9, 0.1]), ("b", [0.2, 0.8]), ("b", [0.95, 0.05])]
    frame = spark.createDataFrame(rows, "y string, p array<double>")
    assert m.roc_auc_by_class(frame, "y", "p", ["a", "b"]).first()["auc"] == 0.5
    three = spark.createDataFrame(
        [("a", [0.9, 0.1, 0.0]), ("b", [0.2, 0.8, 0.0]), ("c", [0.1, 0.1, 0.8])], "y string, p array<double>"
    )
    assert m.roc_auc_by_class(three, "y", "p", ["a", "b", "c"]).first()["auc"] == 1.0
    assert m.roc_auc_by_class(three.limit(2), "y", "p", ["a", "b", "c"]).first()["auc"] is None


@pytest.mark.parametrize("buckets", [1, 3])
def test_area_under_any_curve(spark, buckets):
    x, y = [0.0, 0.5, 0.5, 2.0, 3.5], [1.0, 2.0, 4.0, 4.0, -1.0]
    curve = spark.createDataFrame(list(zip(x, y)), "x double, y double").repartition(3)
    assert m.area_under(curve, "x", "y", buckets=buckets).first()["area"] == pytest.approx(np.trapezoid(y, x))
    falls = [1.0, 4.0, 2.0, 4.0, -1.0]
    area = m.area_under(curve, "x", "y", falling=True, buckets=buckets).first()["area"]
    assert area == pytest.approx(np.trapezoid(falls, x))
    assert m.area_under(curve.limit(1), "x", "y").first()["area"] is None
    with pytest.raises(Exception, match="holds a null"):
        m.area_under(curve.withColumn("y", F.nullif("y", F.lit(-1.0))), "x", "y").collect()


def test_repeated_scores_do_not_crowd_the_buckets(spark):
    from tabwright.operators.cumulate import bucket_edges

    # nine of ten rows on ten scores
    frame = spark.range(20_000).select(
        F.when(F.col("id") % 10 > 0, F.col("id") % 10).otherwise(F.col("id") / 20_000).alias("score").cast("double"))
    distinct = frame.select("score").distinct()
    edges = [float("-inf"), *bucket_edges(distinct, "score", 20), float("inf")]
    values = np.array([r["score"] for r in distinct.collect()])
    sizes = [((values >= a) & (values < b)).sum() for a, b in zip(edges, edges[1:])]
    assert len(values) > 2_000 and max(sizes) <= 2 * len(values) / 20

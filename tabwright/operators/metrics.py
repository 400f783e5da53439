"""Evaluation of a scored table.

Label metrics come from the counts per (actual, predicted) pair, so one pass with
map-side combining feeds all of them. Curves work on one row per distinct score.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators.clean import quoted
from tabwright.operators.cumulate import bucket_edges, running_totals
from tabwright.params import METRICS
from tabwright.session import settle

MAX_CLASSES = 1000


def pair_counts(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (actual, predicted); a null on either side is an error when it is read."""
    def present(name):
        return F.when(quoted(name).isNull(), F.raise_error(F.lit(f"{name} holds a null"))).otherwise(
            quoted(name)
        )

    return scored.groupBy(
        present(label).alias("actual"), present(prediction).alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"))


def class_scores(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class; an undefined ratio is 0."""
    pairs = pair_counts(scored, label, prediction)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    sides = F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("support"),
                 F.lit(0).cast("long").alias("claimed"), hit.cast("long").alias("hits")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("claimed"), F.lit(0).cast("long").alias("hits")),
    )
    counts = pairs.select(F.explode(sides).alias("s")).groupBy("s.class").agg(
        F.sum("s.support").alias("support"),
        F.sum("s.claimed").alias("claimed"),
        F.sum("s.hits").alias("hits"),
    )
    return counts.select(
        "class",
        _ratio(F.col("hits"), F.col("claimed")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(F.col("hits") * 2, F.col("claimed") + F.col("support")).alias("f1"),
        "support",
        "hits",
    )


def label_metrics(
    scored: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    score: str | None = None,
    positive=1,
    metrics: Sequence[str] = METRICS,
) -> DataFrame:
    """Accuracy, support-weighted precision / recall / F1, and AUC when a score is given,
    as ``(metric, value)`` rows (J1-J7)."""
    unknown = set(metrics) - set(METRICS)
    if unknown:
        raise ValueError(f"Unknown metrics: {sorted(unknown)}")
    total = F.sum("support")
    wide = class_scores(scored, label, prediction).agg(
        F.try_divide(F.sum("hits").cast("double"), total).alias("accuracy"),
        *(F.try_divide(F.sum(F.col(m) * F.col("support")), total).alias(m)
          for m in ("precision", "recall", "f1")),
    )
    long = wide.unpivot([], wide.columns, "metric", "value").filter(
        F.col("metric").isin(*metrics) if metrics else F.lit(False)
    )
    if score is None or "roc_auc" not in metrics:
        return long
    area = roc_auc(scored, label, score, positive)
    return long.unionByName(area.select(F.lit("roc_auc").alias("metric"), F.col("auc").alias("value")))


def classification_report(
    scored: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Per-class rows, then accuracy, macro average and weighted average.

    The accuracy row holds the accuracy in all three ratio columns.
    """
    classes = class_scores(scored, label, prediction)
    ratios = ("precision", "recall", "f1")
    total = F.sum("support")
    accuracy = F.try_divide(F.sum("hits").cast("double"), total)
    rows = {
        "accuracy": [accuracy] * 3,
        "macro avg": [F.avg(r) for r in ratios],
        "weighted avg": [F.try_divide(F.sum(F.col(r) * F.col("support")), total) for r in ratios],
    }
    averages = classes.agg(F.array(*(
        F.struct(F.lit(name).alias("class"),
                 *(v.alias(r) for r, v in zip(ratios, values)), total.alias("support"))
        for name, values in rows.items()
    )).alias("rows")).select(F.inline("rows"))
    return classes.select(
        F.col("class").cast("string").alias("class"), *ratios, "support"
    ).unionByName(averages)


def confusion_matrix(
    scored: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    labels: Sequence | None = None,
    max_classes: int = MAX_CLASSES,
) -> DataFrame:
    """``(actual, predicted, n)`` over the grid of all labels seen, zeros included.

    The grid has a column per label, so more than ``max_classes`` of them are an error.
    """
    pairs = pair_counts(scored, label, prediction)
    if labels is None:
        seen = pairs.select(F.explode(F.array("actual", "predicted")).alias("v")).distinct()
        labels = sorted(r["v"] for r in seen.limit(max_classes + 1).collect())
        if len(labels) > max_classes:
            raise ValueError(f"more than {max_classes} classes")
    if not labels:
        return pairs
    # every label gets its row from itself, every column from the label list
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("actual"), F.col("predicted"), F.col("n")),
        F.struct(F.col("actual"), F.col("actual").alias("predicted"), zero.alias("n")),
        F.struct(F.col("predicted").alias("actual"), F.col("predicted"), zero.alias("n")),
    )
    cells = pairs.select(F.inline(sides)).groupBy("actual").agg(F.array(*(
        F.struct(F.lit(v).alias("predicted"),
                 F.coalesce(F.sum(F.when(F.col("predicted") == F.lit(v), F.col("n"))), zero).alias("n"))
        for v in labels
    )).alias("cells"))
    return cells.select("actual", F.inline("cells"))


def score_points(
    scored: DataFrame, label: str = "label", score: str = "score", positive=1, buckets: int | None = None
) -> DataFrame:
    """One row per distinct score with its positives and negatives, the running totals
    ``tp`` and ``fp`` from the highest score down, and the counts at the next score."""
    base = scored.select(
        quoted(score).cast("double").alias("score"),
        F.when(quoted(label).isNull(), F.raise_error(F.lit("label holds a null")))
        .otherwise((quoted(label) == F.lit(positive)).cast("long")).alias("is_positive"),
    ).filter(F.col("score").isNotNull())
    grouped = base.groupBy("score").agg(
        F.sum("is_positive").alias("pos"), F.sum(1 - F.col("is_positive")).alias("neg")
    )
    edges = bucket_edges(grouped, "score", buckets)
    return running_totals(grouped, "score", ("pos", "neg"), edges).withColumnsRenamed(
        {"cum_pos": "tp", "cum_neg": "fp"}
    )


def roc_curve(
    scored: DataFrame,
    label: str = "label",
    score: str = "score",
    positive=1,
    keep_start: bool = False,
    drop_collinear: bool = True,
    buckets: int | None = None,
) -> DataFrame:
    """``(threshold, fpr, tpr)``.

    An inner point is dropped when it has as many positives and as many negatives as the
    next score, for then it lies on a straight line. ``keep_start`` adds the point (0, 0)
    with an infinite threshold. A rate without any row behind it is null.
    """
    points = score_points(scored, label, score, positive, buckets)
    if drop_collinear:
        first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
        last = F.col("next_pos").isNull()
        bends = (F.col("pos") != F.col("next_pos")) | (F.col("neg") != F.col("next_neg"))
        points = points.filter(first | last | bends)
    curve = points.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("fp").cast("double"), F.col("all_neg")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.col("all_pos")).alias("tpr"),
    )
    if not keep_start:
        return curve
    start = scored.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(curve)


def precision_recall_curve(
    scored: DataFrame, label: str = "label", score: str = "score", positive=1, buckets: int | None = None
) -> DataFrame:
    """``(threshold, precision, recall)`` with the end point (1, 0) at threshold 1.

    Without positives the recall is 1 everywhere but at the end point.
    """
    points = score_points(scored, label, score, positive, buckets)
    curve = points.select(
        F.col("score").alias("threshold"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("all_pos")), F.lit(1.0)).alias("recall"),
    )
    end = scored.sparkSession.range(1).select(
        F.lit(1.0).alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return curve.unionByName(end)


def roc_auc(
    scored: DataFrame, label: str = "label", score: str = "score", positive=1, buckets: int | None = None
) -> DataFrame:
    """Exact area under the ROC curve by trapezoids, ties included; null for a single
    class (J5, J11). One row, column ``auc``."""
    points = score_points(scored, label, score, positive, buckets)
    return points.agg(*trapezoid_sums()).select(trapezoid_area().alias("auc"))


def roc_auc_by_class(
    scored: DataFrame, label: str, probabilities: str, labels: Sequence, buckets: int | None = None
) -> DataFrame:
    """AUC of the class probabilities (an array column in the order of ``labels``).

    Two classes: the second against the first. More: the mean over each class against the
    others (J7). One row, column ``auc``.
    """
    ones = [1] if len(labels) == 2 else range(len(labels))
    known = F.when(quoted(label).isNull(), F.raise_error(F.lit("label holds a null"))).otherwise(quoted(label))
    sides = F.array(*(F.struct(F.lit(i).alias("class"), F.get(quoted(probabilities), F.lit(i)).cast("double").alias("score"),
                               (known == F.lit(labels[i])).cast("long").alias("is_positive")) for i in ones))
    # classes side by side, so the scores are grouped and cumulated in one go
    grouped = scored.select(F.inline(sides)).filter(F.col("score").isNotNull()).groupBy("class", "score").agg(
        F.sum("is_positive").alias("pos"), F.sum(1 - F.col("is_positive")).alias("neg"))
    points = running_totals(grouped, "score", ("pos", "neg"), bucket_edges(grouped, "score", buckets), by=("class",)).withColumnsRenamed(
        {"cum_pos": "tp", "cum_neg": "fp"})
    areas = points.groupBy("class").agg(*trapezoid_sums()).select(trapezoid_area().alias("auc"))
    # undefined as soon as one class is
    return areas.agg(F.when(F.count("auc") == len(ones), F.avg("auc")).alias("auc"))


def area_under(
    curve: DataFrame, x: str, y: str, falling: bool = False, buckets: int | None = None
) -> DataFrame:
    """Area under the points of any curve by trapezoids (J11). One row, column ``area``.

    Points are joined in the order of ``x``. Where several share an ``x`` the curve enters at their
    least ``y`` and leaves at the greatest, or the other way round if it is ``falling``. Fewer
    than two places on the axis give null; a null or NaN coordinate is an error.
    """
    def number(name):
        value = quoted(name).cast("double")
        return F.when(value.isNull() | F.isnan(value), F.raise_error(F.lit(f"{name} holds a null or NaN"))).otherwise(value)

    low, high = F.min("y"), F.max("y")
    places = settle(curve.select(number(x).alias("x"), number(y).alias("y")).groupBy("x").agg(
        (high if falling else low).alias("enter"), (low if falling else high).alias("leave"), F.first("x").alias("at")))
    steps = running_totals(places, "x", ("at", "enter", "leave"), bucket_edges(places, "x", buckets))
    # the next row is the place to the left
    return steps.agg(
        F.sum((F.col("at") - F.col("next_at")) * (F.col("enter") + F.col("next_leave")) / 2.0).alias("area"))


def trapezoid_sums():
    """Aggregates of score points that :func:`trapezoid_area` divides."""
    # each step in fp spans the running tp before and after it
    doubled = F.col("neg").cast("double") * (F.col("tp") + F.col("tp") - F.col("pos")).cast("double")
    return F.sum(doubled).alias("__area"), F.sum("pos").alias("__pos"), F.sum("neg").alias("__neg")


def trapezoid_area():
    pairs = F.col("__pos").cast("double") * F.col("__neg").cast("double")
    return F.try_divide(F.col("__area") / F.lit(2.0), pairs)


def curves_by_model(scored: dict[str, DataFrame], **options) -> DataFrame:
    """ROC points of several models with a ``model`` column."""
    return reduce(DataFrame.unionByName, (
        roc_curve(df, keep_start=True, **options).select(F.lit(name).alias("model"), "threshold", "fpr", "tpr")
        for name, df in scored.items()
    ))


def _ratio(part, whole):
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

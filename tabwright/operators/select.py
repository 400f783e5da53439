"""Feature selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators.clean import numeric_columns, quoted
from tabwright.operators.trees import TreeParams, TreeTable, tree_table
from tabwright.session import settle


def anova_scores(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """``(feature, position, f_value)`` of the one-way analysis of variance.

    One grouping by the label gives count, mean and variance of all features. F is
    infinite for a feature without spread inside the classes, null for a constant one.
    ValueError for text columns and for nulls, as they have no score.
    """
    numeric = set(numeric_columns(df))
    wrong = [c for c in features if c not in numeric]
    if wrong:
        raise ValueError(f"Features must be numeric: {wrong}")
    columns = {f"x{i}": quoted(c).cast("double") for i, c in enumerate(features)}
    by_class = df.groupBy(quoted(label).alias("__class")).agg(
        *(F.struct(
            F.count(x).alias("n"), F.avg(x).alias("mean"),
            (F.var_pop(x) * F.count(x)).alias("within"),
            F.count_if(x.isNull() | F.isnan(x)).alias("gaps"),
        ).alias(name) for name, x in columns.items())
    )
    long = by_class.unpivot(["__class"], list(columns), "name", "s").select("name", "s.*")
    # one row per class and feature, read twice: for the overall means, then for the spread around them
    stored = settle(long)
    totals = stored.groupBy("name").agg(
        F.sum("n").alias("all"), F.sum("gaps").alias("gaps"), F.count(F.lit(1)).alias("k"),
        F.sum("within").alias("inside"),
        F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("centre"),
    )
    # as many rows as features
    apart = F.col("mean") - F.col("centre")
    spread = stored.join(F.broadcast(totals.select("name", "centre")), "name").groupBy("name").agg(
        F.coalesce(F.sum(F.col("n") * apart * apart), F.lit(0.0)).alias("between"))
    grouped = totals.join(F.broadcast(spread), "name")
    between = F.col("between")
    above = F.try_divide(between, F.col("k") - 1)
    below = F.try_divide(F.col("inside"), F.col("all") - F.col("k"))
    f_value = F.when((below == 0) & (above > 0), F.lit(float("inf"))).otherwise(F.try_divide(above, below))
    position = F.substring("name", 2, 10).cast("int")
    names = F.array(*(F.lit(c) for c in features))
    checked = F.when(F.col("gaps") > 0, F.raise_error(F.lit("Features contain missing values"))).otherwise(f_value)
    return grouped.select(
        F.get(names, position).alias("feature"), position.alias("position"), checked.alias("f_value")
    )


def best_by_anova(df: DataFrame, features: Sequence[str], label: str, k: int = 10) -> list[str]:
    """Names of the ``k`` best features in their original order.

    On a tie the later column wins; features without a score rank lowest.
    """
    ranked = anova_scores(df, features, label).orderBy(
        F.desc_nulls_last("f_value"), F.desc("position")
    )
    try:
        best = ranked.limit(k).collect()
    except Exception as error:
        if "missing values" in str(error):
            raise ValueError("Features contain missing values") from error
        raise
    chosen = {r["feature"] for r in best}
    return [c for c in features if c in chosen]


def select_features(
    df: DataFrame, features: Sequence[str], label: str, k: int = 10, keep: Sequence[str] = ()
) -> tuple[DataFrame, list[str]]:
    """Project the table to the selected features, the label and ``keep``."""
    names = best_by_anova(df, features, label, k)
    return df.select(*(quoted(c) for c in (*keep, *names, label))), names


def assemble(df: DataFrame, features: Sequence[str], into: str = "features") -> DataFrame:
    """Feature columns as one vector; nulls are an error."""
    return VectorAssembler(inputCols=list(features), outputCol=into, handleInvalid="error").transform(df)


def importance_ranking(
    df: DataFrame, features: Sequence[str], label: str, trees: int = 100, seed: int = 42,
    max_depth: int | None = None, top: int | None = None, ascending: bool = False, key: str | None = None,
) -> DataFrame:
    """Forest importances as ``(feature, importance)``, best first (G15, K1-K3). The result does not depend on the
    table's partitions. ``key`` is a unique column to draw rows by; without one equal rows are drawn together."""
    model = forest_table(df, features, label, trees, seed, max_depth, key).fit()
    return ranked_importances(df, features, model.featureImportances.toArray(), top, ascending)


def ranked_importances(df: DataFrame, features, importances, top=None, ascending=False) -> DataFrame:
    """Importances as a sorted table; equal ones in name order (K1-K3)."""
    rows = [(f, float(v)) for f, v in zip(features, importances)]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    order = F.asc("importance") if ascending else F.desc("importance")
    ranked = table.orderBy(order, "feature")
    return ranked if top is None else ranked.limit(top)


def recursive_elimination(
    df: DataFrame, features: Sequence[str], label: str, keep: int = 20, step: int = 1,
    trees: int = 100, seed: int = 42, max_depth: int | None = None, key: str | None = None,
) -> tuple[list[str], dict[str, int]]:
    """Drop the least important features round by round.

    Returns the kept names in original order and the rank of every feature (1 = kept). The table is
    stored once in the form that fits read; rounds leave columns out of it. ``key`` is as for :func:`importance_ranking`.
    """
    if step < 1:
        raise ValueError("step must be at least 1")
    held = forest_table(df, features, label, trees, seed, max_depth, key) if len(features) > keep else None
    remaining, dropped = list(range(len(features))), []
    while len(remaining) > keep:
        scores = held.fit(remaining).featureImportances.toArray()
        order = sorted(range(len(remaining)), key=lambda i: scores[i])
        gone = set(order[: min(step, len(remaining) - keep)])
        dropped.append([remaining[i] for i in sorted(gone)])
        remaining = [c for i, c in enumerate(remaining) if i not in gone]
    ranks = {features[c]: 1 for c in remaining}
    for rank, places in enumerate(reversed(dropped), start=2):
        ranks.update({features[c]: rank for c in places})
    return [features[c] for c in remaining], ranks


def forest_table(df: DataFrame, features: Sequence[str], label: str, trees: int, seed: int, max_depth: int | None, key: str | None) -> TreeTable:
    """The table in the form that forests for importances read: gini, sqrt of the features a node, bagged."""
    rows = df.select(F.array(*(quoted(c).cast("double") for c in features)).alias("features"), quoted(label).cast("double").alias("label"),
                     *([quoted(key).alias("key")] if key else []))
    params = TreeParams(trees=trees, max_depth=max_depth, per_split="sqrt", bagging=True, bins=512, seed=seed, key="key" if key else None)
    return tree_table(rows, params)

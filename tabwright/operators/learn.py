"""Training, cross-validation and comparison of classifiers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import IndexToString
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions import confidence, map_values, positive_probability
from tabwright.operators.bayes import bayes_fold_scores
from tabwright.operators.clean import quoted
from tabwright.operators.logistic import LogisticParams, fit_logistic
from tabwright.operators.metrics import classification_report, confusion_matrix, roc_auc
from tabwright.operators.prepare import fit_preparation
from tabwright.operators.trees import TreeParams, fit_trees, tree_table
from tabwright.params import FeatureParams, ModelParams

MAX_CLASSES = 100


def _forest(rows: int, seed: int, **settings):
    # 30 is the greatest depth Spark allows; the memory lets a level of many nodes be one pass
    return RandomForestClassifier(
        seed=seed, featureSubsetStrategy="sqrt", **{"maxDepth": 30, "maxMemoryInMB": 1024, **settings})


def _tree(rows: int, seed: int, **settings):
    # 30 is the greatest depth Spark allows
    return DecisionTreeClassifier(seed=seed, **{"impurity": "entropy", "maxDepth": 30, **settings})


def _logistic(rows: int, seed: int, C: float = 1.0, **settings):
    # the summed loss weighted by C is the mean loss with penalty 1 / (C rows)
    return LogisticRegression(
        regParam=1.0 / (C * max(1, rows)), elasticNetParam=0.0, standardization=False,
        **{"maxIter": 1000, **settings},
    )


def _bayes(rows: int, seed: int, **settings):
    return NaiveBayes(modelType="gaussian", **settings)


CLASSIFIERS: dict[str, Callable] = {
    "logistic_regression": _logistic,
    "decision_tree": _tree,
    "random_forest": _forest,
    "naive_bayes": _bayes,
}

Settings = dict | TreeParams | LogisticParams

# name -> settings of the four compared models
COMPARED: dict[str, Settings] = {
    "logistic_regression": LogisticParams(),
    "decision_tree": TreeParams(impurity="entropy", min_split=10, seed=100),
    "random_forest": TreeParams(trees=100, per_split="sqrt", bagging=True, min_split=10, bins=512, seed=100),
    "naive_bayes": {},
}


def make_classifier(name: str, rows: int, seed: int, settings: dict | None = None):
    """An unfitted classifier by name; ValueError for an unknown one."""
    if name not in CLASSIFIERS:
        raise ValueError(f"Unsupported model type: {name}")
    return CLASSIFIERS[name](rows, seed, **(settings or {})).setFeaturesCol("features").setLabelCol("label")


def class_labels(df: DataFrame, target: str, max_classes: int = MAX_CLASSES) -> list[str]:
    """Sorted class values; their position is the class index. More than ``max_classes`` are an
    error: models hold numbers per class and node."""
    values = df.select(quoted(target).cast("string").alias("v")).distinct().limit(max_classes + 1).collect()
    labels = [r["v"] for r in values]
    if None in labels:
        raise ValueError(f"{target} holds nulls")
    if len(labels) > max_classes:
        raise ValueError(f"{target} has more than {max_classes} classes")
    return sorted(labels)


def train(
    df: DataFrame,
    features: FeatureParams = FeatureParams(),
    model: ModelParams = ModelParams(),
    max_classes: int = MAX_CLASSES,
) -> PipelineModel:
    """Fit preparation and classifier as one saved unit.

    The result maps a raw table to ``prediction`` (the target's own values),
    ``probability`` and the columns the classifier adds.
    """
    labels = class_labels(df, features.target, max_classes)
    return train_prepared(df, fit_preparation(df.drop(*features.dropped), features.numeric, features.categorical),
                          features.target, labels, model)


def train_prepared(
    df: DataFrame, preparation: PipelineModel, target: str, labels: Sequence[str], model: ModelParams
) -> PipelineModel:
    """Fit a classifier behind a fitted preparation."""
    index = map_values(quoted(target).cast("string"), {v: float(i) for i, v in enumerate(labels)})
    prepared = preparation.transform(df).select("features", index.alias("label")).persist()
    try:
        rows = prepared.count() if model.name == "logistic_regression" else 0
        classifier = make_classifier(model.name, rows, model.seed, model.settings)
        fitted = classifier.setPredictionCol("predicted_index").fit(prepared)
    finally:
        prepared.unpersist()
    names = IndexToString(inputCol="predicted_index", outputCol="prediction", labels=list(labels))
    return PipelineModel([preparation, fitted, names])


def fit_vectors(df: DataFrame, name: str, seed: int = 100, settings: Settings | None = None):
    """Fit a classifier on ``features`` and ``label`` columns (I6-I9). Settings as a dict are for Spark's learner of that name;
    ``TreeParams`` and ``LogisticParams`` say which of :mod:`trees` and :mod:`logistic` to fit, seed included."""
    if isinstance(settings, TreeParams):
        return fit_trees(df, settings)
    if isinstance(settings, LogisticParams):
        return fit_logistic(df, settings)
    rows = df.count() if name == "logistic_regression" else 0
    return make_classifier(name, rows, seed, settings).fit(df)


@dataclass(frozen=True)
class FoldScores:
    """Accuracy per fold with mean and population deviation."""

    scores: tuple[float, ...]

    @property
    def mean(self) -> float:
        return sum(self.scores) / len(self.scores)

    @property
    def std(self) -> float:
        return (sum((s - self.mean) ** 2 for s in self.scores) / len(self.scores)) ** 0.5


def cross_validate(
    df: DataFrame, name: str, folds: int = 10, fold_column: str = "fold", seed: int = 100,
    settings: Settings | None = None, parallelism: int = 2,
    resample: Callable[[DataFrame], DataFrame] | None = None,
) -> FoldScores:
    """Accuracy of each fold by a model of the other folds.

    ``df`` has ``features``, ``label`` and the fold column; hold it before the call.
    ``resample`` changes the training rows of each round and leaves the judged ones alone.
    A fold without rows is an error: the mean would be of fewer folds than asked for. Naive Bayes at its defaults is fitted for
    all rounds from one pass; trees store the table once and leave a fold out of it.
    """
    stored = None
    if isinstance(settings, TreeParams) and resample is None:
        stored = tree_table(df.filter(F.col(fold_column).isNotNull()), settings, part=fold_column)

    def one(fold: int) -> float:
        if stored is not None:
            fitted = stored.fit(left_out=fold)
        else:
            others = df.filter(F.col(fold_column) != fold)
            fitted = fit_vectors(others if resample is None else resample(others), name, seed, settings)
        judged = fitted.transform(df.filter(F.col(fold_column) == fold))
        return judged.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]

    if name == "naive_bayes" and not settings and resample is None:
        scores = bayes_fold_scores(df, folds, fold_column)
    else:
        pool = ThreadPool(min(parallelism, folds))
        try:
            scores = pool.map(inheritable_thread_target(df.sparkSession)(one), range(folds))
        finally:
            pool.close()
    if empty := [i for i, s in enumerate(scores) if s is None]:
        raise ValueError(f"folds without rows: {empty}")
    return FoldScores(tuple(scores))


@dataclass(frozen=True)
class ModelOutcome:
    """What one model's protocol produces; the tables are lazy."""

    name: str
    folds: FoldScores
    test_accuracy: float
    fitted: object
    scored: DataFrame

    def report(self) -> DataFrame:
        return classification_report(self.scored)

    def confusion(self) -> DataFrame:
        return confusion_matrix(self.scored)

    def auc(self) -> DataFrame:
        return roc_auc(self.scored)


def run_protocol(
    train_df: DataFrame, test_df: DataFrame, name: str, folds: int = 10, seed: int = 100,
    settings: Settings | None = None, parallelism: int = 2,
    resample: Callable[[DataFrame], DataFrame] | None = None,
) -> ModelOutcome:
    """Cross-validate, fit on all training rows, score the test rows."""
    scores = cross_validate(
        train_df, name, folds, seed=seed, settings=settings, parallelism=parallelism, resample=resample
    )
    fitted = fit_vectors(train_df if resample is None else resample(train_df), name, seed, settings)
    scored = with_scores(fitted.transform(test_df))
    accuracy = scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    return ModelOutcome(name, scores, accuracy, fitted, scored)


def with_scores(predicted: DataFrame) -> DataFrame:
    """Add the positive-class score and the confidence."""
    return predicted.withColumns({
        "score": positive_probability(F.col("probability")),
        "confidence": confidence(F.col("probability")),
    })


def compare(outcomes: Sequence[ModelOutcome], df: DataFrame) -> DataFrame:
    """``(position, model, cv_accuracy, test_accuracy)``, best test accuracy first."""
    rows = [(i, o.name, o.folds.mean, o.test_accuracy) for i, o in enumerate(outcomes)]
    table = df.sparkSession.createDataFrame(
        rows, "position int, model string, cv_accuracy double, test_accuracy double"
    )
    return table.orderBy(F.desc("test_accuracy"), "position")


def best_model(comparison: DataFrame) -> DataFrame:
    """The model with the best test accuracy, the first one on a tie."""
    rank = F.struct(F.col("test_accuracy"), -F.col("position"))
    return comparison.agg(
        F.max_by("model", rank).alias("model"), F.max("test_accuracy").alias("test_accuracy")
    )

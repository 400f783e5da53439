"""The training job from a raw table to written predictions (L1)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.operators.clean import keep_declared, numeric_columns
from tabwright.operators.learn import train
from tabwright.operators.metrics import label_metrics, roc_auc_by_class
from tabwright.operators.prepare import impute
from tabwright.operators.quality import all_passed, check_all
from tabwright.operators.select import best_by_anova
from tabwright.operators.split import part, split_table
from tabwright.params import FeatureParams, WorkflowParams
from tabwright.plans.features import derive_features
from tabwright.plans.scoring import Scorer
from tabwright.session import laid_out
from tabwright.sources import runs
from tabwright.sources.models import save_model
from tabwright.sources.sinks import write_labelled_predictions, write_metrics_csv, write_splits


@dataclass(frozen=True)
class TrainingResult:
    model: PipelineModel
    features: list[str]
    validation: DataFrame
    test: DataFrame
    predictions: DataFrame


def prepare_and_train(
    train_df: DataFrame, params: WorkflowParams
) -> tuple[PipelineModel, FeatureParams]:
    """Select numeric features on the training part only, then fit the model on them.

    All numeric columns but the target and the dropped ones compete, with nulls filled by
    the median; the categorical ones always stay. Returns the model and its input columns.
    """
    f = params.features
    skipped = {f.target, params.split.key, *f.dropped}
    candidates = [c for c in numeric_columns(train_df) if c not in skipped]
    filled = impute(keep_declared(train_df, candidates, [f.target]), candidates)
    names = best_by_anova(filled, candidates, f.target, f.select_k)
    chosen = replace(f, numeric=tuple(names))
    return train(train_df, chosen, params.model), chosen


def evaluate(scored: DataFrame, target: str, labels: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """The named metrics of a scored table, AUC from its array of class probabilities."""
    table = label_metrics(scored, target, "prediction", metrics=metrics)
    if "roc_auc" not in metrics:
        return table
    area = roc_auc_by_class(scored, target, "probability", labels)
    return table.unionByName(area.select(F.lit("roc_auc").alias("metric"), F.col("auc").alias("value")))


def run_training(
    data: DataFrame, out: str, params: WorkflowParams = WorkflowParams()
) -> TrainingResult | None:
    """Check, split, derive, select, fit, evaluate, score and write under ``out``.

    Returns None when a check fails. The assigned table is written once and read back,
    so all later steps start from files and not from the source's lineage.
    """
    spark: SparkSession = data.sparkSession
    f = params.features
    derived = derive_features(data, f)
    if not all_passed(check_all(derived, params)):
        return None

    write_splits(split_table(derived, params.split), f"{out}/splits")
    stored = spark.read.schema(derived.schema.add("split", "string")).parquet(f"{out}/splits")
    train_df, validation_df, test_df = (part(stored, n) for n in ("train", "validation", "test"))

    model, chosen = prepare_and_train(laid_out(train_df, params.split.key), params)
    model_path = f"{out}/model"
    save_model(model, model_path)
    run_id = runs.new_run()
    runs.log_params(spark, f"{out}/runs", run_id, {"name": params.model.name, **params.model.settings}, model_path)

    # one scoring pass feeds all metrics and the prediction file
    scorer = Scorer(model, chosen)
    judged = scorer.predict_with_confidence(
        stored.filter(F.col("split").isin("validation", "test")), params.confidence_threshold
    ).withColumn("probability", vector_to_array("probability"))
    judged.write.partitionBy("split").mode("overwrite").parquet(f"{out}/scored")
    scored = spark.read.schema(judged.schema).parquet(f"{out}/scored")

    labels = model.stages[-1].getLabels()
    results = {}
    for name in ("validation", "test"):
        metrics = evaluate(part(scored, name), f.target, labels, params.metrics)
        write_metrics_csv(metrics, f"{out}/{name}_metrics", params.metrics)
        results[name] = spark.read.csv(
            f"{out}/{name}_metrics", header=True, schema=", ".join(f"{m} double" for m in params.metrics)
        )
    long = results["validation"].unpivot([], list(params.metrics), "metric", "value")
    runs.log_metrics(long, f"{out}/runs", run_id)

    predictions = part(scored, "test")
    write_labelled_predictions(predictions, f.target, f"{out}/predictions")
    return TrainingResult(model, list(chosen.numeric), results["validation"], results["test"], predictions)

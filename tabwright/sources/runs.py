"""Run table: parameters and metrics of each run, append only."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "run_id string, at timestamp, kind string, key string, value string"


def new_run() -> str:
    """A fresh run id."""
    return uuid.uuid4().hex


def log_params(spark: SparkSession, path: str, run_id: str, params: Mapping, model_path: str | None = None) -> None:
    """Append the parameters of a run and where its model is."""
    now = dt.datetime.now()
    rows = [(run_id, now, "param", str(k), str(v)) for k, v in params.items()]
    if model_path is not None:
        rows.append((run_id, now, "model", "path", model_path))
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def log_metrics(metrics: DataFrame, path: str, run_id: str) -> None:
    """Append the ``(metric, value)`` rows of a run."""
    metrics.select(
        F.lit(run_id).alias("run_id"), F.current_timestamp().alias("at"), F.lit("metric").alias("kind"),
        F.col("metric").alias("key"), F.col("value").cast("string").alias("value"),
    ).coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All logged entries."""
    return spark.read.schema(SCHEMA).parquet(path)

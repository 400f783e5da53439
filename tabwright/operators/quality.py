"""Data-quality rules (D1-D12): one aggregation pass per run, however many rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.operators.clean import quoted
from tabwright.params import (
    INTEGER_COLUMNS,
    REQUIRED,
    TARGET,
    TARGET_DOMAIN,
    FeatureParams,
    WorkflowParams,
)


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required names the table lacks."""
    present = set(df.columns)
    return [c for c in required if c not in present]


def wrong_types(df: DataFrame, columns: Sequence[str], kinds: tuple = (T.NumericType,)) -> list[str]:
    """Columns whose type is none of the kinds."""
    return [c for c in columns if c in df.columns and not isinstance(df.schema[c].dataType, kinds)]


def require_valid(
    df: DataFrame,
    required: Sequence[str] = REQUIRED,
    integers: Sequence[str] = INTEGER_COLUMNS,
    target: str = TARGET,
    domain: Sequence[str] = TARGET_DOMAIN,
) -> bool:
    """True, or ValueError for the first rule that fails, in order D1-D4."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"Missing required columns: {sorted(missing)}")
    found = df.agg(
        F.count_if(_any_null(df)).alias("nulls"),
        F.count_if(~quoted(target).cast("string").isin(*domain)).alias("off_domain"),
    ).first()
    if found["nulls"]:
        raise ValueError("Data contains missing values")
    wrong = wrong_types(df, integers, (T.IntegerType, T.LongType))
    if wrong:
        raise ValueError(f"{wrong[0]} must be numeric")
    if found["off_domain"]:
        allowed = " or ".join(f"'{v}'" for v in domain)
        raise ValueError(f"Target variable must contain only {allowed}")
    return True


def require_scorable(df: DataFrame, features: FeatureParams = FeatureParams()) -> None:
    """ValueError unless all model inputs are present and the numerics numeric."""
    missing = missing_columns(df, (*features.numeric, *features.categorical))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    wrong = wrong_types(df, features.numeric)
    if wrong:
        raise ValueError(f"Column {wrong[0]} must be numeric")


def rule_report(
    df: DataFrame,
    required: Sequence[str],
    integers: Sequence[str],
    target: str,
    domain: Sequence,
) -> DataFrame:
    """The rules of D1-D4 as rows ``(check, passed, failures)`` instead of an error."""
    schema_failures = len(missing_columns(df, required))
    type_failures = len(wrong_types(df, integers, (T.IntegerType, T.LongType)))
    facts = df.agg(
        F.count_if(_any_null(df)).alias("missing_values"),
        F.count_if(~quoted(target).isin(*domain)).alias("target_domain"),
    ).select(
        F.lit(schema_failures).cast("long").alias("required_columns"),
        "missing_values",
        F.lit(type_failures).cast("long").alias("integer_types"),
        "target_domain",
    )
    long = facts.unpivot([], facts.columns, "check", "failures")
    return long.select("check", (F.col("failures") == 0).alias("passed"), "failures")


def check_all(df: DataFrame, params: WorkflowParams = WorkflowParams()) -> DataFrame:
    """Schema, types, null shares and class shares as ``(check, passed, detail)``.

    ``detail`` is the number of missing columns or wrong types, the largest null share,
    or the smallest class share. Both data rules come from one grouping by the target.
    A null share equal to the limit, or a class share equal to the floor, passes.
    """
    f = params.features
    missing = missing_columns(df, (*f.categorical, *f.numeric, f.target))
    wrong = [*wrong_types(df, f.numeric), *(c for c in f.numeric if c in missing)]

    target = quoted(f.target) if f.target in df.columns else F.lit(None).cast("string")
    grouped = df.groupBy(target.alias("__class")).agg(
        F.count(F.lit(1)).alias("__rows"),
        *(F.count_if(quoted(c).isNull()).alias(f"__null{i}") for i, c in enumerate(df.columns)),
    )
    classified = F.col("__class").isNotNull()
    facts = grouped.agg(
        F.sum("__rows").alias("rows"),
        F.sum(F.when(classified, F.col("__rows"))).alias("classified"),
        F.min(F.when(classified, F.col("__rows"))).alias("smallest"),
        F.greatest(
            F.lit(0), *(F.sum(f"__null{i}") for i in range(len(df.columns)))
        ).alias("nulls"),
    ).select(
        F.lit(float(len(missing))).alias("schema"),
        F.lit(float(len(wrong))).alias("data_types"),
        F.coalesce(F.try_divide(F.col("nulls").cast("double"), "rows"), F.lit(0.0)).alias("missing_values"),
        F.try_divide(F.col("smallest").cast("double"), "classified").alias("target_distribution"),
    )
    long = facts.unpivot([], facts.columns, "check", "detail")
    has_target = F.lit(f.target in df.columns)
    passed = (
        F.when(F.col("check") == "missing_values", F.col("detail") <= params.null_share_limit)
        .when(
            F.col("check") == "target_distribution",
            has_target & F.coalesce(F.col("detail") >= params.class_share_floor, F.lit(True)),
        )
        .otherwise(F.col("detail") == 0)
    )
    return long.select("check", passed.alias("passed"), "detail")


def all_passed(report: DataFrame) -> bool:
    """Gate on a report: every check passed."""
    return report.filter(~F.col("passed")).isEmpty()


def _any_null(df: DataFrame):
    test = F.lit(False)
    for field in df.schema:
        column = quoted(field.name)
        test = test | column.isNull()
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            test = test | F.isnan(column)
    return test

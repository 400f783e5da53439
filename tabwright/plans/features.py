"""Derived features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tabwright.functions import bracket_midpoint, code_group, cut, row_sum
from tabwright.operators.clean import columns_like, numeric_columns, quoted
from tabwright.operators.select import select_features
from tabwright.params import DIAGNOSIS_COLUMNS, FeatureParams


def derive_features(
    df: DataFrame,
    params: FeatureParams = FeatureParams(),
    age: str = "age",
    stay: str = "time_in_hospital",
) -> DataFrame:
    """Age and stay groups and the two row sums.

    The sums take every column whose name contains the pattern, also one they replace.
    """
    return df.withColumns({
        "age_group": cut(quoted(age), params.age_edges, params.age_labels),
        "length_of_stay_group": cut(quoted(stay), params.stay_edges, params.stay_labels),
        "num_medications": row_sum(map(quoted, columns_like(df, params.medication_pattern))),
        "num_diagnoses": row_sum(map(quoted, columns_like(df, params.diagnosis_pattern))),
    })


def group_diagnoses(df: DataFrame, columns: Sequence[str] = DIAGNOSIS_COLUMNS) -> DataFrame:
    """``<column>_category`` per diagnosis column (F2)."""
    return df.withColumns({f"{c}_category": code_group(quoted(c)) for c in columns})


def age_midpoints(df: DataFrame, column: str = "age") -> DataFrame:
    """``age_midpoint`` from a bracket text."""
    return df.withColumn("age_midpoint", bracket_midpoint(quoted(column)))


def engineer(
    df: DataFrame, params: FeatureParams = FeatureParams(), keep: Sequence[str] = ()
) -> tuple[DataFrame, list[str]]:
    """Derive, then select the best numeric features for the target."""
    derived = derive_features(df, params)
    skipped = {params.target, *keep, *params.dropped}
    numeric = [c for c in numeric_columns(derived) if c not in skipped]
    return select_features(derived, numeric, params.target, params.select_k, keep)

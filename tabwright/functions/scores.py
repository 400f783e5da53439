"""Columns computed from a probability vector."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def confidence(probability: Column, is_vector: bool = True) -> Column:
    """Largest class probability of the row."""
    return F.array_max(vector_to_array(probability) if is_vector else probability)


def positive_probability(probability: Column, is_vector: bool = True) -> Column:
    """Probability of the second class."""
    return F.get(vector_to_array(probability) if is_vector else probability, F.lit(1))


def at_least(value: Column, threshold: float) -> Column:
    """High-confidence mask, threshold included."""
    return value >= F.lit(threshold)

"""Column expressions: everything here stays inside Catalyst and code generation."""

from tabwright.functions.bins import bracket_midpoint, code_group, cut
from tabwright.functions.hashing import hash60, unit_interval
from tabwright.functions.nulls import (
    fill_missing,
    finite_or_zero,
    map_values,
    not_in,
    row_sum,
    sentinel_to_null,
    to_number,
)
from tabwright.functions.scores import at_least, confidence, positive_probability

__all__ = [
    "at_least", "bracket_midpoint", "code_group", "confidence", "cut", "fill_missing",
    "finite_or_zero", "hash60", "map_values", "not_in", "positive_probability", "row_sum",
    "sentinel_to_null", "to_number", "unit_interval",
]

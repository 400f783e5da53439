"""Binning and grouping of codes, ages and stays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabwright.functions.nulls import to_number
from tabwright.params import DIAGNOSIS_GROUPS, DIAGNOSIS_OTHER


def cut(
    value: Column, edges: Sequence[float], labels: Sequence[str], right: bool = True
) -> Column:
    """Label of the bin a value falls in; null outside the edges.

    Bins are ``(low, high]`` by default and ``[low, high)`` with ``right=False``.
    NaN belongs to no bin: Spark orders it above every number, so each bin is
    tested on both sides.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("cut needs one label fewer than edges")
    if any(a >= b for a, b in zip(edges, edges[1:])):
        raise ValueError("cut edges must increase")
    label = None
    for low, high, name in zip(edges, edges[1:], labels):
        inside = (
            (value > low) & (value <= high) if right else (value >= low) & (value < high)
        )
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return label


def code_group(
    code: Column, groups=DIAGNOSIS_GROUPS, other: str = DIAGNOSIS_OTHER
) -> Column:
    """Disease group of a diagnosis code (F1); range ends are inclusive.

    Null, empty and non-numeric codes, and the V and E supplements, are ``other``:
    none of them parses as a number, so no range matches.
    """
    def grouped(number: Column) -> Column:
        group = None
        for name, ranges in groups:
            inside = None
            for low, high in ranges:
                one = number.between(low, high)
                inside = one if inside is None else inside | one
            group = F.when(inside, name) if group is None else group.when(inside, name)
        return group.otherwise(other)

    # the number is bound once; spelled out it would be parsed again for every range
    return F.get(F.transform(F.array(to_number(code)), grouped), F.lit(0))


def bracket_midpoint(bracket: Column) -> Column:
    """Mean of the two integers in a text such as ``[10-20)``, else null."""
    low, high = (
        F.regexp_extract(bracket, r"^\D*(\d+)\D+(\d+)\D*$", i).try_cast("double") for i in (1, 2)
    )
    return (low + high) / F.lit(2.0)

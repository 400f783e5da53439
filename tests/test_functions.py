import math

import pytest
from pyspark.sql import functions as F

from tabwright import functions as fn
from tabwright.params import AGE_EDGES, AGE_LABELS, STAY_EDGES, STAY_LABELS


def values(spark, schema, rows, expression):
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {schema}")
    return [r[0] for r in frame.orderBy("i").select(expression).collect()]


def test_not_in_keeps_null(spark):
    assert values(spark, "int", [11, 1, None, 21], fn.not_in(F.col("x"), [11, 21])) == [False, True, True, False]


@pytest.mark.parametrize("code, group", [
    (None, "Other"), ("", "Other"), ("V27", "Other"), ("E909", "Other"), ("250", "Diabetes"),
    ("250.00", "Diabetes"), ("250.83", "Other"), ("390", "Circulatory"), ("459", "Circulatory"),
    ("459.5", "Other"), ("460", "Respiratory"), ("519", "Respiratory"), ("785", "Circulatory"),
    ("786", "Respiratory"), ("787", "Digestive"), ("788", "Genitourinary"), ("139", "Other"),
    ("140", "Neoplasms"), ("239", "Neoplasms"), ("240", "Other"), ("999", "Injury"), ("1000", "Other"),
    ("720", "Musculoskeletal"), ("600", "Genitourinary"), ("530", "Digestive"), ("400d", "Other"),
    ("nan", "Other"), ("abc", "Other"), (" 400 ", "Circulatory"), ("4e2", "Circulatory"),
])
def test_code_group(spark, code, group):
    assert values(spark, "string", [code], fn.code_group(F.col("x"))) == [group]


def test_cut_is_right_closed(spark):
    ages = [0, 1, 10, 11, 100, 101, None]
    assert values(spark, "int", ages, fn.cut(F.col("x"), AGE_EDGES, AGE_LABELS)) == [
        None, "[0-10)", "[0-10)", "[10-20)", "[90-100)", None, None]
    stays = [0, 3, 4, 30, 31]
    assert values(spark, "int", stays, fn.cut(F.col("x"), STAY_EDGES, STAY_LABELS)) == [
        None, "short", "medium", "very_long", None]
    left = fn.cut(F.col("x"), AGE_EDGES, AGE_LABELS, right=False)
    assert values(spark, "int", [0, 10, 100], left) == ["[0-10)", "[10-20)", None]
    assert values(spark, "double", [math.nan], fn.cut(F.col("x"), AGE_EDGES, AGE_LABELS)) == [None]
    with pytest.raises(ValueError):
        fn.cut(F.lit(1), (0, 1), ())
    with pytest.raises(ValueError):
        fn.cut(F.lit(1), (1, 0), ("a",))


def test_bracket_midpoint(spark):
    texts = ["[0-10)", "[90-100)", ">75", None, "a1b2c3"]
    assert values(spark, "string", texts, fn.bracket_midpoint(F.col("x"))) == [5.0, 95.0, None, None, None]


def test_to_number_rejects_suffixes(spark):
    texts = ["1", "1.5", " 2 ", "1e3", "1d", "2f", "", "nan", "abc", None, "-.5", "inf", "0x1"]
    assert values(spark, "string", texts, fn.to_number(F.col("x"))) == [
        1.0, 1.5, 2.0, 1000.0, None, None, None, None, None, None, -0.5, math.inf, None]


def test_row_sum(spark):
    frame = spark.createDataFrame([(1, None), (None, None), (2, 3)], "a int, b int")
    assert [r[0] for r in frame.select(fn.row_sum([F.col("a"), F.col("b")])).collect()] == [1, 0, 5]
    assert frame.select(fn.row_sum([])).first()[0] == 0


def test_fill_map_and_finite(spark):
    assert values(spark, "string", ["a", None], fn.fill_missing(F.col("x"))) == ["a", "Missing"]
    mapping = fn.map_values(F.col("x"), {"<30": 1, ">30": 0, "NO": 0})
    assert values(spark, "string", ["<30", ">30", "NO", "other", None], mapping) == [1, 0, 0, None, None]
    numbers = [math.nan, None, math.inf, -math.inf, 1.5]
    largest = 1.7976931348623157e308
    assert values(spark, "double", numbers, fn.finite_or_zero(F.col("x"))) == [0.0, 0.0, largest, -largest, 1.5]
    with pytest.raises(ValueError):
        fn.map_values(F.lit(1), {})


def test_sentinels(spark):
    texts = ["?", "Unknown/Invalid", "None", " ?", None]
    assert values(spark, "string", texts, fn.sentinel_to_null(F.col("x"))) == [None, None, "None", " ?", None]


def test_scores(spark):
    rows = [[0.8, 0.2], [0.3, 0.7], [0.9, 0.1]]
    sure = fn.confidence(F.col("x"), is_vector=False)
    assert values(spark, "array<double>", rows, sure) == [0.8, 0.7, 0.9]
    assert values(spark, "array<double>", rows, fn.positive_probability(F.col("x"), False)) == [0.2, 0.7, 0.1]
    assert values(spark, "array<double>", rows, fn.at_least(sure, 0.8)) == [True, False, True]


def test_hash_is_stable(spark):
    hashed = values(spark, "long", [1, 2], fn.hash60(F.col("x"), 42))
    import hashlib
    assert hashed == [int(hashlib.md5(f"{i}:42".encode()).hexdigest()[:15], 16) for i in (1, 2)]
    units = values(spark, "long", list(range(50)), fn.unit_interval(fn.hash60(F.col("x"), 1)))
    assert all(0 <= u < 1 for u in units) and len(set(units)) == 50

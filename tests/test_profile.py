import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators import profile
from tabwright.operators.clean import null_sentinels, numbers_with_median_fill
from tabwright.operators.quantiles import exact_medians, exact_quantiles


def test_quantiles_agree_with_numpy_on_both_paths(spark):
    draw = np.random.default_rng(1)
    smooth = draw.normal(size=3000)
    tied = np.where(np.arange(3000) % 3 == 0, 5.0, draw.normal(size=3000))
    frame = spark.createDataFrame([(float(a), float(b)) for a, b in zip(smooth, tied)], "a double, b double")
    shares = [0.0, 0.01, 0.25, 0.5, 0.667, 0.9, 1.0]
    for options in ({}, {"few_values": 10, "fetch_limit": 20}):
        found = exact_quantiles(frame, ["a", "b"], shares, **options)
        assert np.allclose(found["a"], np.quantile(smooth, shares), rtol=1e-12, atol=1e-12)
        assert np.allclose(found["b"], np.quantile(tied, shares), rtol=1e-12, atol=1e-12)


def test_two_heavy_values_around_the_median(spark):
    data = [0.0] * 1500 + [0.001 * i for i in range(1, 101)] + [1.0] * 1500
    frame = spark.createDataFrame([(x,) for x in data], "x double")
    found = exact_quantiles(frame, ["x"], [0.5, 0.49], few_values=5, fetch_limit=5)["x"]
    assert np.allclose(found, np.quantile(data, [0.5, 0.49]))


def test_median_of_even_count_nulls_and_nothing(spark):
    frame = spark.createDataFrame(
        [(1, None, math.nan), (2, None, 3.0), (4, None, None), (10, None, 1.0)], "a int, b int, c double"
    )
    assert exact_medians(frame, ["a", "b", "c"]) == {"a": 3.0, "b": None, "c": 2.0}
    assert exact_medians(frame, []) == {}


def test_column_profile(spark):
    frame = spark.createDataFrame([(1, "a"), (2, None), (2, "a")], "x int, y string")
    rows = {r["column"]: r for r in profile.column_profile(frame).collect()}
    assert (rows["x"]["rows"], rows["x"]["nulls"], rows["x"]["distinct"]) == (3, 0, 2)
    assert (rows["y"]["type"], rows["y"]["nulls"], rows["y"]["distinct"]) == ("string", 1, 1)
    rough = {r["column"]: r["distinct"] for r in profile.column_profile(frame, exact=False).collect()}
    assert rough == {"x": 2, "y": 1}


def test_describe_ties_and_all_null(spark):
    frame = spark.createDataFrame(
        [("b", 1.0, None), ("a", 2.0, None), ("a", 4.0, None), ("b", None, None)], "t string, x double, n string"
    )
    rows = {r["column"]: r for r in profile.describe(frame).collect()}
    assert (rows["t"]["top"], rows["t"]["freq"], rows["t"]["unique"]) == ("a", 2, 2)
    assert rows["x"]["count"] == 3 and rows["x"]["q50"] == 2.0 and rows["x"]["q25"] == 1.5
    assert (rows["n"]["count"], rows["n"]["unique"], rows["n"]["top"]) == (0, 0, None)


def test_counts_ignore_null(spark):
    frame = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "c string")
    assert [tuple(r) for r in profile.value_counts(frame, "c").collect()] == [("x", 2), ("y", 1)]
    shares = {r["c"]: r["share"] for r in profile.value_shares(frame, "c").collect()}
    assert shares == pytest.approx({"x": 2 / 3, "y": 1 / 3})
    assert [tuple(r) for r in profile.null_counts(frame).collect()] == [("c", 1)]


def test_sentinel_counts_and_nulls(spark):
    frame = spark.createDataFrame([("?", "ok", 1), ("a", "?x", 2)], "a string, `b-c` string, n int")
    assert [tuple(r) for r in profile.sentinel_counts(frame).collect()] == [("a", 1)]
    cleaned = null_sentinels(frame).collect()
    assert cleaned[0]["a"] is None and cleaned[1]["b-c"] == "?x"
    assert profile.sentinel_counts(frame.select("n")).count() == 0


@pytest.mark.parametrize("data", [[1.0, 2.0, 2.0, 10.0], [3.0, 3.0], [0.1 * i for i in range(101)]])
def test_histogram_agrees_with_numpy(spark, data):
    frame = spark.createDataFrame([(x,) for x in data] + [(None,)], "x double")
    rows = profile.histogram(frame, "x").orderBy("bin").collect()
    counts, edges = np.histogram(data, bins=10)
    assert [r["n"] for r in rows] == list(counts)
    assert np.allclose([r["low"] for r in rows], edges[:-1])


def test_density(spark):
    data = [5.0, 15.0, 15.0, 25.0, 95.0]
    frame = spark.createDataFrame([(x,) for x in data], "x double")
    rows = profile.density_curve(frame, "x", points=50).orderBy("point").collect()
    width = np.std(data, ddof=1) * len(data) ** -0.2
    grid = np.linspace(5, 95, 50)
    expected = np.exp(-((grid[:, None] - np.array(data)) / width) ** 2 / 2).sum(1) / (5 * width * np.sqrt(2 * np.pi))
    assert np.allclose([r["density"] for r in rows], expected)


def test_numbers_with_median_fill(spark):
    frame = spark.createDataFrame([("1", 5, "k"), ("x", None, "l"), ("4", 7, "m")], "t string, n int, id string")
    rows = numbers_with_median_fill(frame, exclude=["id"]).collect()
    assert [r["t"] for r in rows] == [1.0, 2.5, 4.0] and [r["n"] for r in rows] == [5.0, 6.0, 7.0]
    assert [r["id"] for r in rows] == ["k", "l", "m"]


def test_balance_and_shape(spark):
    frame = spark.createDataFrame([(1, "a"), (0, "a"), (0, "b")], "y int, p string")
    rows = {r["p"]: (r["n"], r["positives"], r["positive_pct"]) for r in profile.class_balance(frame, "y", "p").collect()}
    assert rows == {"a": (2, 1, 50.0), "b": (1, 0, 0.0)}
    assert tuple(profile.shape(frame).first()) == (3, 2)
    assert {r["type"]: r["columns"] for r in profile.type_counts(frame).collect()} == {"int": 1, "string": 1}
    assert tuple(profile.mean_and_deviation(frame.select(F.col("y").cast("double").alias("s")), "s").first()) == (
        pytest.approx((1 / 3, math.sqrt(2) / 3)))


def test_infinities_on_both_paths_of_the_quantiles(spark):
    rows = [(float("-inf"),)] * 3 + [(float(i),) for i in range(900)] + [(float("inf"),)] * 3
    df = spark.createDataFrame(rows, "x double")
    shares = [0, 0.001, 0.3, 0.5, 0.999, 1]
    few = exact_quantiles(df, ["x"], shares)
    assert exact_quantiles(df, ["x"], shares, few_values=1) == few and few["x"][0] == float("-inf")


def test_nan_counts_as_null_in_a_histogram(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "x double")
    assert sum(r["n"] for r in profile.histogram(df, "x", 4).collect()) == 2


def test_describe_takes_every_column(spark):
    df = spark.sql("SELECT 1 AS id, DATE'2020-01-02' AS day, true AS flag, 'a' AS s UNION ALL SELECT 2, DATE'2020-01-02', false, 'b'")
    found = {r["column"]: r for r in profile.describe(df).collect()}
    assert set(found) == {"id", "day", "flag", "s"} and found["day"]["top"] == "2020-01-02" and found["day"]["freq"] == 2

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tabwright.operators.prepare import (
    TablePreparer,
    fit_preparation,
    impute,
    most_frequent,
    numeric_statistics,
    standardize,
    vector_names,
)
from tabwright.params import FeatureParams

FEATURES = FeatureParams(numeric=("a", "flat", "none"), categorical=("c", "o'k \\x"), dropped=("id",))


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(
        [(1, 1.0, 7, None, "y", "it's"), (2, None, 7, None, "x", "b\\s"), (3, 4.0, 7, None, "x", None),
         (4, 10.0, 7, None, "y", "b\\s"), (5, 2.0, 7, None, None, "it's")],
        "id int, a double, flat int, none double, c string, `o'k \\x` string",
    )


def test_unfitted(frame):
    with pytest.raises(ValueError, match="fitted"):
        TablePreparer(FEATURES).transform(frame)
    with pytest.raises(ValueError, match="fitted"):
        TablePreparer(FEATURES).feature_names(frame)


def test_vector(frame, spark):
    preparer = TablePreparer(FEATURES)
    prepared = preparer.fit_transform(frame)
    names = preparer.feature_names(frame)
    # a column without any number takes no slot
    assert names == ["num__a", "num__flat", "cat__c_x", "cat__c_y", "cat__o'k \\x_b\\s", "cat__o'k \\x_it's"]
    matrix = np.array([r["features"].toArray() for r in prepared.collect()])
    filled = np.array([1.0, 3.0, 4.0, 10.0, 2.0])
    assert np.allclose(matrix[:, 0], (filled - filled.mean()) / filled.std())
    assert np.allclose(matrix[:, 1], 0)
    assert np.allclose(matrix[4, 2:4], [1, 0])  # tie of x and y: the lower is the mode
    assert np.allclose(matrix[2, 4:], [1, 0])
    assert prepared.columns == [*(c for c in frame.columns if c != "id"), "features"]


def test_unknown_level_is_all_zero_and_reload_agrees(frame, spark, tmp_path):
    preparer = TablePreparer(FEATURES).fit(frame)
    new = spark.createDataFrame([(9, None, None, 1.0, "zz", "it's")], frame.schema)
    row = preparer.transform(new).first()["features"].toArray()
    assert np.allclose(row[2:], [0, 0, 0, 1]) and row[1] == 0 and not np.isnan(row).any()
    preparer.model.write().overwrite().save(str(tmp_path / "m"))
    again = TablePreparer(FEATURES, PipelineModel.load(str(tmp_path / "m")))
    assert np.array_equal(again.transform(new).first()["features"].toArray(), row)


def test_errors(frame, spark):
    with pytest.raises(ValueError, match="Missing required columns"):
        TablePreparer(FEATURES).fit(frame.drop("a"))
    with pytest.raises(ValueError, match="must be numeric"):
        TablePreparer(FeatureParams(numeric=("c",), categorical=(), dropped=())).fit(frame)


def test_impute_and_mode(frame):
    rows = impute(frame, ["a", "none"], ["c"]).collect()
    assert rows[1]["a"] == 3.0 and rows[0]["none"] is None and rows[4]["c"] == "x"
    modes = {r["column"]: (r["value"], r["n"]) for r in most_frequent(frame, ["c", "flat"]).collect()}
    assert modes == {"c": ("x", 2), "flat": ("7", 5)}


def test_standardize_properties(spark):
    frame = spark.range(100).selectExpr("id", "cast(id * id as double) as x", "nullif(id % 10, 3) as y").repartition(7)
    rows = standardize(frame, ["x", "y"]).collect()
    for c in ("x", "y"):
        data = np.array([r[c] for r in rows])
        assert abs(data.mean()) < 1e-9 and math.isclose(data.std(), 1.0, rel_tol=1e-9)
    assert numeric_statistics(frame.selectExpr("cast(null as double) as z"), ["z"]) == {}


def test_names_from_metadata(frame):
    assert len(vector_names(TablePreparer(FEATURES).fit_transform(frame))) == 6


def test_more_levels_than_allowed_are_refused(spark):
    frame = spark.range(50).select(F.col("id").alias("x"), F.col("id").cast("string").alias("t"))
    with pytest.raises(ValueError, match="too many levels"):
        fit_preparation(frame, ["x"], ["t"], max_levels=20)

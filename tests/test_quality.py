import pytest
from pyspark.sql import functions as F

from tabwright.operators import quality
from tabwright.params import FeatureParams, WorkflowParams


@pytest.fixture
def valid(spark):
    """37 encounters of 12 patients, a third of them readmitted."""
    i = F.col("id")
    own = {
        "encounter_id": i * 7 + 9_000, "patient_nbr": i % 12, "age": F.lit(31) + i % 50, "time_in_hospital": 1 + i % 13,
        "num_lab_procedures": (i * i) % 83, "num_procedures": i % 5, "num_medications": 2 + i % 17, "number_outpatient": i % 3,
        "number_emergency": i % 2, "number_inpatient": i % 4,
        "race": F.element_at(F.array(F.lit("Hispanic"), F.lit("Other")), (1 + i % 2).cast("int")),
        "gender": F.when(i % 5 == 0, "Male").otherwise("Female"), "readmitted": F.when(i % 3 == 0, "YES").otherwise("NO"),
    }
    return spark.range(37).select(*(own[c].alias(c) for c in quality.REQUIRED))


def test_valid_table(valid):
    assert quality.require_valid(valid) is True


def test_rules_in_order(spark, valid):
    with pytest.raises(ValueError, match="Missing required columns"):
        quality.require_valid(spark.range(5).withColumnRenamed("id", "encounter_id"))
    with pytest.raises(ValueError, match="missing values"):
        quality.require_valid(valid.withColumn("num_procedures", F.nullif("num_procedures", F.lit(4).cast("long"))))
    with pytest.raises(ValueError, match="encounter_id must be numeric"):
        quality.require_valid(valid.withColumn("encounter_id", F.col("encounter_id").cast("string")))
    with pytest.raises(ValueError, match="age must be numeric"):
        quality.require_valid(valid.withColumn("age", F.col("age").cast("double")))
    with pytest.raises(ValueError, match="must contain only 'NO' or 'YES'"):
        quality.require_valid(valid.withColumn("readmitted", F.when(F.col("age") > 60, "later").otherwise(F.col("readmitted"))))
    with pytest.raises(ValueError, match="missing values"):
        quality.require_valid(valid.withColumn("extra", F.lit(float("nan"))))


def checks(frame, **options):
    params = WorkflowParams(features=FeatureParams(numeric=("x",), categorical=("c",), target="y"), **options)
    report = quality.check_all(frame, params)
    return {r["check"]: r["passed"] for r in report.collect()}, report


def test_limits_are_inclusive(spark):
    half = spark.createDataFrame([(1, None, "a"), (2, "k", "b")], "x int, c string, y string")
    found, report = checks(half)
    assert found == {"schema": True, "data_types": True, "missing_values": True, "target_distribution": True}
    assert quality.all_passed(report)
    more = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, "k", "b")], "x int, c string, y string")
    found, report = checks(more)
    assert found["missing_values"] is False and not quality.all_passed(report)


@pytest.mark.parametrize("rare, passed", [(1, True), (0, True)])
def test_rare_class(spark, rare, passed):
    frame = spark.range(100).select(
        F.col("id").alias("x"), F.lit("k").alias("c"), F.when(F.col("id") < rare, "r").otherwise("o").alias("y")
    )
    assert checks(frame)[0]["target_distribution"] is passed
    below = spark.range(101).select(
        F.col("id").alias("x"), F.lit("k").alias("c"), F.when(F.col("id") < 1, "r").otherwise("o").alias("y")
    )
    assert checks(below)[0]["target_distribution"] is False


def test_text_in_numeric_and_absent_target(spark):
    frame = spark.createDataFrame([("1", "k")], "x string, c string")
    found, _ = checks(frame)
    assert found["schema"] is False and found["data_types"] is False and found["target_distribution"] is False


def test_scoring_input(spark, valid):
    features = FeatureParams(numeric=("age",), categorical=("race",))
    quality.require_scorable(valid, features)
    with pytest.raises(ValueError, match="Missing required columns"):
        quality.require_scorable(valid.drop("race"), features)
    with pytest.raises(ValueError, match="Column age must be numeric"):
        quality.require_scorable(valid.withColumn("age", F.lit("x")), features)

import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabwright.operators import split as sp


def numbered(spark, n, partitions=3):
    frame = spark.range(n).withColumnRenamed("id", "key")
    return frame.withColumn("c", F.when(F.col("key") % 9 == 0, "rare").otherwise("often")).repartition(partitions)


def test_three_way_sizes(spark):
    frame = numbered(spark, 100)
    counts = Counter(r["split"] for r in sp.split_table(frame, sp.SplitParams(key="key")).collect())
    assert counts == {"train": 70, "validation": 10, "test": 20}


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(1, 400), seed=st.integers(0, 5))
def test_split_is_exact_disjoint_and_stable(spark, n, seed):
    frame = numbered(spark, n)
    fitted = sp.three_way_split(frame, "key", seed=seed)
    rows = fitted.assign(frame).collect()
    assert sorted(r["key"] for r in rows) == list(range(n))
    counts = Counter(r["split"] for r in rows)
    tests = math.ceil(0.2 * n)
    assert counts.get("test", 0) == tests
    assert counts.get("validation", 0) == math.ceil(0.1 / 0.8 * (n - tests))


def test_same_for_any_partitioning(spark):
    results = []
    for partitions in (1, 2, 7):
        frame = numbered(spark, 500, partitions)
        results.append({r["key"]: r["split"] for r in sp.three_way_split(frame, "key").assign(frame).collect()})
    assert results[0] == results[1] == results[2]


def test_refined_cuts_match_a_full_sort(spark, monkeypatch):
    monkeypatch.setattr(sp, "_FETCH_LIMIT", 3)
    frame = numbered(spark, 2000)
    fitted = sp.fit_split(frame, "key", ("a", "b"), lambda c: {None: [777]}, seed=3, bits=4)
    rows = fitted.assign(frame).select("key", "split", sp.hash60(F.col("key"), 3).alias("h")).collect()
    order = sorted(rows, key=lambda r: (r["h"], r["key"]))
    assert [r["split"] for r in order] == ["a"] * 777 + ["b"] * 1223


def test_duplicate_keys_are_refused(spark, monkeypatch):
    monkeypatch.setattr(sp, "_FETCH_LIMIT", 3)
    frame = spark.range(50).select(F.lit(1).alias("key"))
    with pytest.raises(ValueError, match="not unique"):
        sp.fit_split(frame, "key", ("a", "b"), lambda c: {None: [10]}, seed=3)


def test_few_repeated_keys_are_refused_too(spark):
    frame = spark.range(100).select((F.col("id") % 4).alias("key"))
    with pytest.raises(ValueError, match="not unique"):
        sp.three_way_split(frame, "key")


def test_limit_of_classes_is_an_argument(spark):
    frame = numbered(spark, 40)
    with pytest.raises(ValueError, match="more than 1 classes"):
        sp.stratified_split(frame, "key", "c", max_strata=1)
    assert sp.stratified_split(frame, "key", "c", max_strata=2).assign(frame).count() == 40


def test_stratified_split(spark):
    frame = numbered(spark, 95)
    rows = sp.stratified_split(frame, "key", "c").assign(frame).collect()
    counts = Counter((r["c"], r["split"]) for r in rows)
    # 11 rare, 84 often; 76 train rows in proportion
    assert counts == {("rare", "train"): 9, ("rare", "test"): 2, ("often", "train"): 67, ("often", "test"): 17}


def test_proportional_sizes():
    assert sp.proportional_sizes({0: 5, 1: 5, 2: 5}, 10) == {0: 4, 1: 3, 2: 3}
    assert sum(sp.proportional_sizes({0: 7, 1: 13}, 11).values()) == 11


def test_folds_are_balanced(spark):
    frame = numbered(spark, 203)
    rows = sp.stratified_folds(frame, "key", "c", folds=10).assign(frame, "fold").collect()
    assert {r["fold"] for r in rows} == set(range(10))
    for level in ("rare", "often"):
        sizes = Counter(r["fold"] for r in rows if r["c"] == level)
        assert max(sizes.values()) - min(sizes.get(f, 0) for f in range(10)) <= 1
    totals = Counter(r["fold"] for r in rows)
    assert max(totals.values()) - min(totals.values()) <= 1


def test_null_class_is_a_class(spark):
    frame = numbered(spark, 100).withColumn("c", F.when(F.col("c") == "often", "often"))
    rows = sp.stratified_folds(frame, "key", "c", folds=5).assign(frame, "fold").collect()
    assert len(rows) == 100 and all(r["fold"] is not None for r in rows)


def test_sample_size(spark):
    frame = numbered(spark, 100)
    assert sp.hash_sample(frame, "key", 13, 1).assign(frame, "s").filter("s = 1").count() == 13
    assert sp.hash_sample(frame, "key", 0, 1).assign(frame, "s").filter("s = 1").count() == 0


def test_empty_table(spark):
    frame = numbered(spark, 0)
    assert sp.three_way_split(frame, "key").assign(frame).count() == 0
    assert sp.stratified_folds(frame, "key", "c").assign(frame, "fold").count() == 0


def test_assignment_does_not_shuffle(spark):
    frame = spark.range(1000).withColumnRenamed("id", "key")
    plan = sp.three_way_split(frame, "key").assign(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan

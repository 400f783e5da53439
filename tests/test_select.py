import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators import select as sel
from tabwright.session import laid_out


@pytest.fixture
def frame(spark):
    return spark.range(90).select(
        "id", (F.col("id") % 3).alias("y"), F.col("id").alias("drift"),
        (F.col("id") % 3 * 10 + F.pmod(F.xxhash64("id"), 5)).cast("double").alias("strong"),
        F.pmod(F.xxhash64("id", F.lit(1)), 11).alias("noise"), F.lit(4).alias("flat"),
        (F.col("id") % 3).cast("double").alias("copy"),
    ).repartition(3)


def test_f_values(frame):
    names = ["drift", "strong", "noise", "flat", "copy"]
    found = {r["feature"]: r["f_value"] for r in sel.anova_scores(frame, names, "y").collect()}
    data = frame.toPandas()
    for name in ("drift", "strong", "noise"):
        groups = [g[name].to_numpy(float) for _, g in data.groupby("y")]
        mean = data[name].mean()
        between = sum(len(g) * (g.mean() - mean) ** 2 for g in groups) / 2
        within = sum(((g - g.mean()) ** 2).sum() for g in groups) / 87
        assert found[name] == pytest.approx(between / within)
    assert found["flat"] is None and math.isinf(found["copy"])


def test_best_keeps_column_order_and_breaks_ties_late(frame):
    assert sel.best_by_anova(frame, ["noise", "strong", "copy", "flat"], "y", 2) == ["strong", "copy"]
    twice = frame.withColumn("again", F.col("strong"))
    assert sel.best_by_anova(twice, ["strong", "again"], "y", 1) == ["again"]
    assert sel.best_by_anova(frame, ["noise", "strong"], "y", 10) == ["noise", "strong"]
    table, names = sel.select_features(frame, ["noise", "strong"], "y", 1, keep=["drift"])
    assert table.columns == ["drift", "strong", "y"] and names == ["strong"]


def test_bad_input(frame):
    with pytest.raises(ValueError, match="must be numeric"):
        sel.best_by_anova(frame.withColumn("t", F.lit("x")), ["t"], "y")
    with pytest.raises(ValueError, match="missing values"):
        sel.best_by_anova(frame.withColumn("drift", F.nullif("drift", F.lit(3))), ["drift"], "y")


def test_importance_and_elimination(frame):
    names = ["noise", "strong", "flat"]
    labelled = frame.withColumn("y", (F.col("y") == 1).cast("double"))
    ranked = sel.importance_ranking(labelled, names, "y", trees=10, max_depth=4).collect()
    assert ranked[0]["feature"] == "strong" and sum(r["importance"] for r in ranked) == pytest.approx(1.0)
    assert sel.importance_ranking(labelled, names, "y", trees=10, max_depth=4, top=1).count() == 1
    kept, ranks = sel.recursive_elimination(labelled, names, "y", keep=1, trees=10, max_depth=4)
    assert kept == ["strong"] and ranks == {"strong": 1, "noise": 2, "flat": 3}
    assert np.isclose(ranked[-1]["importance"], 0)
    kept, ranks = sel.recursive_elimination(labelled, names, "y", keep=1, step=5, trees=5, max_depth=4)
    assert kept == ["strong"] and ranks["noise"] == ranks["flat"] == 2
    with pytest.raises(ValueError):
        sel.recursive_elimination(labelled, names, "y", step=0)


def test_importances_do_not_depend_on_the_partitions(spark, frame):
    names = ["noise", "drift", "flat"]
    labelled = frame.withColumn("y", (F.pmod(F.xxhash64("id"), 2) == 1).cast("double"))
    found, kept = [], []
    for parts in (1, 2, 7):
        rows = labelled.repartition(parts, F.xxhash64("drift", F.lit(parts)))
        ranked = sel.importance_ranking(rows, names, "y", trees=8, max_depth=5, key="id").collect()
        found.append([tuple(r) for r in ranked])
        kept.append(sel.recursive_elimination(rows, names, "y", keep=1, trees=8, max_depth=5, key="id"))
    assert found[0] == found[1] == found[2] and kept[0] == kept[1] == kept[2]
    assert 0 < found[0][0][1] < 1


def test_layout_follows_the_number_of_rows(spark):
    for rows, parts in ((0, 8), (90, 8), (91, 10)):
        table = spark.range(rows).repartition(3)
        assert laid_out(table, "id", rows_per_part=10 if rows > 90 else 100).rdd.getNumPartitions() == parts

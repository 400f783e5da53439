"""Readers, writers, models and whole jobs."""

import os

import pytest
from pyspark.sql import functions as F

from tabwright.operators import learn
from tabwright.operators.select import assemble
from tabwright.operators.split import stratified_folds
from tabwright.params import FeatureParams, ModelParams, SplitParams, WorkflowParams
from tabwright.plans.exploration import ExplorationParams, run_exploration
from tabwright.plans.features import derive_features, engineer, group_diagnoses
from tabwright.plans.scoring import Scorer, score_files
from tabwright.plans.training import run_training
from tabwright.sources import runs, sinks
from tabwright.sources.models import load_model, save_model
from tabwright.sources.tables import read_csv, read_table
from tabwright.streaming.scoring import score_arriving_files

FOREST = ModelParams(settings={"numTrees": 10, "maxDepth": 4})


def test_read_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('id,name,x,level\n1,"a, b",1.5,None\n2,NA,,x\n3,"say ""hi""",2,NULL\n')
    rows = read_csv(spark, str(path))
    assert dict(rows.dtypes) == {"id": "bigint", "name": "string", "x": "double", "level": "string"}
    assert [tuple(r) for r in rows.orderBy("id").collect()] == [
        (1, "a, b", 1.5, "None"), (2, None, None, "x"), (3, 'say "hi"', 2.0, None)]
    typed = read_table(spark, str(path), schema="id int, x double")
    assert dict(typed.dtypes) == {"id": "int", "x": "double"} and typed.count() == 3
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path / "absent.csv"))


def test_writers(spark, tmp_path):
    metrics = spark.createDataFrame([("accuracy", 0.5), ("f1", 0.25)], "metric string, value double")
    sinks.write_metrics_csv(metrics, str(tmp_path / "m"), ["accuracy", "f1"])
    assert spark.read.csv(str(tmp_path / "m"), header=True).first().asDict() == {"accuracy": "0.5", "f1": "0.25"}
    sinks.write_metrics_json(metrics, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first().asDict() == {"accuracy": 0.5, "f1": 0.25}
    sinks.write_splits(spark.range(4).withColumn("split", F.lit("train")), str(tmp_path / "s"), fmt="csv")
    assert os.path.isdir(tmp_path / "s" / "split=train")


def test_run_table(spark, tmp_path):
    path, run = str(tmp_path / "runs"), runs.new_run()
    runs.log_params(spark, path, run, {"numTrees": 10}, "models/m")
    runs.log_metrics(spark.createDataFrame([("f1", 0.5)], "metric string, value double"), path, run)
    found = {(r["kind"], r["key"]): r["value"] for r in runs.read_runs(spark, path).collect()}
    assert found == {("param", "numTrees"): "10", ("model", "path"): "models/m", ("metric", "f1"): "0.5"}


def test_derive(spark, modelling_rows):
    rows = derive_features(modelling_rows).collect()
    assert all(r["num_diagnoses"] == 0 for r in rows)
    ages = {r["age"]: r["age_group"] for r in rows}
    assert ages.get(0) is None and ages.get(50, "[40-50)") == "[40-50)"
    codes = spark.createDataFrame([("250", None, "E1")], "diag_1 string, diag_2 string, diag_3 string")
    assert group_diagnoses(codes).first()["diag_1_category"] == "Diabetes"
    table, names = engineer(modelling_rows, FeatureParams(select_k=3), keep=("encounter_id",))
    assert "age" in names and len(names) == 3 and table.columns == ["encounter_id", *names, "readmitted"]
    with pytest.raises(ValueError):
        engineer(modelling_rows.withColumn("age", F.nullif("age", F.lit(5))))


@pytest.fixture(scope="module")
def trained(modelling_rows):
    table = derive_features(modelling_rows)
    return table, learn.train(table, FeatureParams(), FOREST)


def test_train_predict_reload(spark, trained, tmp_path):
    table, model = trained
    scorer = Scorer(model)
    rows = scorer.predict_with_confidence(table, 0.8).collect()
    assert len(rows) == 300 and {r["prediction"] for r in rows} <= {"NO", "YES"}
    for r in rows:
        p = r["probability"].toArray()
        assert len(p) == 2 and p.sum() == pytest.approx(1.0) and r["confidence"] == pytest.approx(p.max())
        assert r["high_confidence"] == (r["confidence"] >= 0.8) and r["score"] == pytest.approx(p[1])
    assert sum(r["prediction"] == r["readmitted"] for r in rows) > 230
    assert set(scorer.predict(table).columns) == {*table.columns, "prediction"}
    assert set(scorer.predict_proba(table).columns) == {*table.columns, "probability"}
    path = str(tmp_path / "model")
    save_model(model, path)
    again = Scorer(load_model(path)).predict(table.drop("readmitted"))
    expected = {r["encounter_id"]: r["prediction"] for r in rows}
    assert {r["encounter_id"]: r["prediction"] for r in again.collect()} == expected
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("Exchange RoundRobinPartitioning")  # the fixture's own
    score_files(path, table, str(tmp_path / "p"))
    stored = spark.read.csv(str(tmp_path / "p"), header=True)
    assert stored.columns == ["prediction", "probability", "confidence"] and stored.count() == 300


def test_scorer_guards(trained, spark):
    table, model = trained
    for method in (Scorer().predict, Scorer().predict_proba, Scorer().predict_with_confidence):
        with pytest.raises(ValueError, match="Model not loaded"):
            method(table)
    with pytest.raises(ValueError, match="Missing required columns"):
        Scorer(model).predict(table.drop("race"))
    with pytest.raises(ValueError, match="must be numeric"):
        Scorer(model).predict(table.withColumn("age", F.lit("x")))
    with pytest.raises(ValueError, match="No model to save"):
        save_model(None)
    with pytest.raises(Exception):
        load_model("/tmp/absent-model")


def test_training_input_errors(trained, spark):
    table, _ = trained
    with pytest.raises(ValueError, match="Unsupported model type"):
        learn.train(table, FeatureParams(), ModelParams(name="other", settings={}))
    with pytest.raises(ValueError):
        learn.train(table.select("age", "readmitted"), FeatureParams(), FOREST)
    with pytest.raises(ValueError, match="holds nulls"):
        learn.train(table.withColumn("readmitted", F.nullif("readmitted", F.lit("NO"))), FeatureParams(), FOREST)


@pytest.mark.parametrize("name, settings", [
    ("logistic_regression", {}), ("decision_tree", {"maxDepth": 5}),
    ("random_forest", {"numTrees": 10, "maxDepth": 4}), ("naive_bayes", {}),
])
def test_protocol_beats_the_base_rate(modelling_rows, name, settings):
    rows = assemble(
        modelling_rows.withColumn("label", (F.col("readmitted") == "YES").cast("double")), ["age", "num_procedures"]
    ).select("encounter_id", "features", "label")
    folded = stratified_folds(rows, "encounter_id", "label", 3).assign(rows, "fold").persist()
    outcome = learn.run_protocol(folded, rows, name, 3, settings=settings)
    assert len(outcome.folds.scores) == 3 and outcome.folds.mean > 0.75 and outcome.test_accuracy > 0.8
    assert outcome.auc().first()["auc"] > 0.85
    assert sum(r["n"] for r in outcome.confusion().collect()) == 300
    assert outcome.report().count() == 5
    folded.unpersist()


def test_comparison_ties(spark):
    def outcome(name, accuracy):
        return learn.ModelOutcome(name, learn.FoldScores((0.5, 0.7)), accuracy, None, None)

    table = learn.compare([outcome("a", 0.5), outcome("b", 0.9), outcome("c", 0.9)], spark.range(1))
    assert [r["model"] for r in table.collect()] == ["b", "c", "a"]
    assert learn.best_model(table).first()["model"] == "b"
    assert learn.FoldScores((0.5, 0.7)).std == pytest.approx(0.1)


def test_training_job(spark, modelling_rows, tmp_path):
    params = WorkflowParams(features=FeatureParams(select_k=5), split=SplitParams(), model=FOREST)
    # nothing competes with the derived sums but the raw numerics
    result = run_training(modelling_rows.drop("age_group"), str(tmp_path), params)
    assert "age" in result.features and len(result.features) == 5
    for metrics in (result.validation, result.test):
        assert all(0 <= v <= 1 for v in metrics.first().asDict().values())
    assert result.test.first()["roc_auc"] > 0.8
    stored = spark.read.csv(str(tmp_path / "predictions"), header=True)
    assert stored.columns == ["true_label", "predicted_label", "confidence_score"] and stored.count() == 60
    assert runs.read_runs(spark, str(tmp_path / "runs")).filter("kind = 'metric'").count() == 5
    bad = modelling_rows.withColumn("readmitted", F.when(F.col("encounter_id") == 0, "RARE").otherwise(F.col("readmitted")))
    assert run_training(bad, str(tmp_path / "bad"), params) is None


def raw_rows(spark, modelling_rows):
    bracket = F.floor(F.col("age") / 10) * 10
    return modelling_rows.withColumns({
        "readmitted": F.when((F.col("age") > 70) | (F.col("encounter_id") % 19 == 0), "<30").otherwise("NO"),
        "age": F.concat(F.lit("["), bracket.cast("string"), F.lit("-"), (bracket + 10).cast("string"), F.lit(")")),
        "race": F.when(F.col("encounter_id") % 11 == 0, "?").otherwise(F.col("race")),
        "discharge_disposition_id": F.when(F.col("encounter_id") % 29 == 0, 11).when(F.col("encounter_id") % 7 == 0, None)
        .otherwise(1), "diag_1": F.lit("250"), "diag_2": F.lit("V1"), "diag_3": F.lit(None).cast("string"),
    })


@pytest.mark.parametrize("fold_safe", [False, True])
def test_exploration_job(spark, modelling_rows, fold_safe):
    params = ExplorationParams(
        keep=4, step=20, trees=5, max_depth=3, folds=2, fold_safe=fold_safe,
        models={"naive_bayes": {}, "random_forest": {"numTrees": 3, "maxDepth": 3}},
    )
    result = run_exploration(raw_rows(spark, modelling_rows), params)
    assert len(result.selected) == 4 and "age_midpoint" in result.selected
    assert result.ranking.count() == 15
    assert result.comparison.count() == 2 and result.best.count() == 1
    assert result.top_features.count() == 4
    assert {r["model"] for r in result.curves.select("model").distinct().collect()} == {"naive_bayes", "random_forest"}
    assert result.profile["sentinels"].first()["column"] == "race"
    assert {r["split"] for r in result.balance.collect()} == {"train", "test"}


def test_stream_scoring_equals_batch(spark, trained, tmp_path):
    table, model = trained
    table.write.parquet(str(tmp_path / "in"))
    run = score_arriving_files(
        spark, Scorer(model), str(tmp_path / "in"), table.schema, str(tmp_path / "out"), str(tmp_path / "c")
    )
    run.awaitTermination()
    found = {r["encounter_id"]: r["prediction"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    expected = {r["encounter_id"]: r["prediction"] for r in Scorer(model).predict(table).collect()}
    assert found == expected


def test_line_breaks_in_cells(spark, tmp_path):
    file = tmp_path / "broken.csv"
    file.write_text('id,note\n1,"first\nsecond"\n2,plain\n')
    rows = sorted(map(tuple, read_csv(spark, str(file)).collect()))
    assert rows == [(1, "first\nsecond"), (2, "plain")]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        read_csv(spark, str(file), schema="id long, note string", multiline=False).collect()

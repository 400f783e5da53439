"""The quality classifier and its cut come from all labelled documents."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabwright.llm import quality
from tabwright.llm.linear import fit_logistic, seeded
from tests.llm.test_pipeline_operators import labelled, table


def plain_threshold(held_out, settings):
    good, bad = (np.sort(held_out["score"][held_out["y"] == v].to_numpy(float)) for v in (1, 0))
    if not len(good):
        return 0.0
    least = float(np.quantile(good, 1 - settings.keep_share))
    if least >= settings.top_threshold or not len(bad):
        return min(settings.top_threshold, least)
    cuts = np.unique(np.concatenate([[least, settings.top_threshold], good, bad]))
    cuts = cuts[(cuts >= least) & (cuts <= settings.top_threshold)]
    lost, kept = np.searchsorted(good, cuts) / len(good), 1 - np.searchsorted(bad, cuts) / len(bad)
    return float(cuts[np.argmin(settings.good_weight * lost + kept)])


@pytest.mark.parametrize("n, share, steps, keep", [(500, 0.7, 40, 0.999), (1, 1.0, 9, 0.999), (300, 0.0, 9, 0.999), (400, 0.5, 10_000, 0.95), (2_000, 0.98, 1_000, 0.99)])
def test_the_threshold_is_that_of_sorted_rows(spark, n, share, steps, keep):
    draw = np.random.default_rng(n)
    y = (draw.random(n) < share).astype(float)
    held_out = pd.DataFrame({"y": y, "score": np.round(draw.beta(1 + 3 * y, 2) * steps) / steps})
    settings = quality.Quality(keep_share=keep)
    assert quality.threshold(spark.createDataFrame(held_out), settings) == plain_threshold(held_out, settings)


def test_the_fit_is_that_of_all_rows_in_memory(spark):
    docs, labels = labelled(spark, 1_200)
    model, held_out = quality.fit_classifier(docs, labels)
    rows = docs.join(labels, "doc_id").select("text", "quality", (seeded(F.col("doc_id"), 43) < 0.5).alias("fit")).toPandas()
    x = quality._expanded(np.array([quality.shape(t) for t in rows["text"]], np.float32).astype(float))
    fit, y = rows["fit"].to_numpy(), rows["quality"].to_numpy(float)
    scale = x[fit].std(0) + 1e-6
    plain = quality.Classifier(x[fit].mean(0), scale, fit_logistic((x[fit] - x[fit].mean(0)) / scale, y[fit]))
    assert np.allclose(model.mean, plain.mean) and np.allclose(model.scale, plain.scale) and np.allclose(model.weights, plain.weights, atol=1e-6)
    found = held_out.toPandas()
    assert len(found) == (~fit).sum() and found["y"].sum() == y[~fit].sum()


def test_no_labelled_document_is_left_out(spark):
    n = 50_000
    text = F.concat(F.lit("word "), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 4 == 0, " ### !!! ||| ###").otherwise(" and some more of it."))
    docs = spark.range(n).select(F.col("id").alias("doc_id")).select("doc_id", text.alias("text"), F.lit("en").alias("lang"), F.lit("host").alias("source"))
    labels = docs.select("doc_id", (F.col("doc_id") % 4 > 0).cast("int").alias("quality"))
    _, held_out = quality.fit_classifier(docs, labels)
    assert held_out.count() == docs.where(seeded(F.col("doc_id"), 43) >= 0.5).count()


def test_a_known_shape_is_not_computed_again(spark):
    docs, labels = labelled(spark, 300)
    (one, held), (other, others) = (quality.fit_classifier(d, labels, **more) for d, more in (
        (docs, {}), (docs.withColumn("x", quality.shapes(F.col("text"))).drop("text"), {"shaped": "x"})))
    assert (one.weights == other.weights).all() and sorted(held.collect()) == sorted(others.collect())


def test_no_rows_to_fit_on(spark):
    model, held_out = quality.fit_classifier(table(spark, []), table(spark, [], "doc_id long, quality int, toxic int"))
    assert held_out.isEmpty() and model.scores(np.zeros((2, len(quality.FEATURES)))).min() > 0.99 and quality.threshold(quality.held_out_scores(
        held_out, quality.site_posteriors(table(spark, [("a", "b", 1.0)], "host string, path string, p double")))) == 0.0

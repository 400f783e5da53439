"""Quality classifier with hierarchical empirical Bayes over hosts and paths.

A logistic classifier on shape features of the text, fitted on half of all labelled documents by
sums over them, gives each document its evidence p. Grouped aggregation sums p by path (within
host) and by host. Posteriors of the sites shrink towards the level above: a host towards the
global mean, a path towards its host, each with a strength estimated from the spread between the
sites (method of moments), so sparse sites stay near the prior. A document's score joins its
own evidence with the shift of its path's posterior from the global mean, in log odds; the
document itself is left out of its sites' sums, so evidence is not counted twice. The cut is
chosen on that score, of the other half of the labelled documents with their sites, from both classes' errors.

Sites are grouped rows of three numbers. Where the labelled documents are those to be judged, their shapes are computed once and
texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm.linear import added_up, bounded_sample, fit_logistic_by_sums, predict, seeded
from tabwright.llm.words import fresh
from tabwright.operators.cumulate import bucket_edges, running_totals
from tabwright.session import settle

_CLASS = np.zeros(256, np.uint8)  # 1 lower or beyond ASCII, 2 capital, 3 digit, 4 space, 5 line break, 6 other
_CLASS[:] = 6
_CLASS[0x80:] = _CLASS[0x61:0x7B] = 1
_CLASS[0x41:0x5B] = 2
_CLASS[0x30:0x3A] = 3
_CLASS[[0x20, 0x09, 0x0B, 0x0C]] = 4
_CLASS[[0x0A, 0x0D]] = 5
FEATURES = (
    "log_words", "mean_word", "long_words", "capital_share", "digit_share", "mark_share", "mark_pairs", "bars",
    "exclamations", "capital_words", "marked_words", "repeat_next", "distinct_words", "top_word", "distinct_pairs",
    "line_repeat", "log_lines", "stop_marks",
)


@dataclass(frozen=True)
class Quality:
    """``keep_share``: share of good held-out documents that the threshold lets pass, unless a higher one rejects, for each share of them that it loses, ``good_weight`` times that
    share of the bad ones: then labels of the good class are wrong. ``site_weight``: weight of the site's shift in log odds."""

    keep_share: float = 0.999
    good_weight: float = 20.0
    top_threshold: float = 0.5
    site_weight: float = 0.5
    seed: int = 42


def shape(text: str | None) -> list[float]:
    """Features of a whole text; zeros for a text without words."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    kinds = _CLASS[np.frombuffer(data, np.uint8)]
    n, size = len(words), len(data)
    counts = np.bincount(kinds, minlength=7)
    marks = kinds == 6
    lower = data.lower().split()
    seen: dict[bytes, int] = {}
    for w in lower:
        seen[w] = seen.get(w, 0) + 1
    lines = data.split(b"\n")
    solid = max(1, size - int(counts[4]) - int(counts[5]))
    return [
        float(np.log1p(n)), min(solid / n, 40.0) / 10, sum(len(w) > 20 for w in words) / n,
        counts[2] / solid, counts[3] / solid, counts[6] / solid, float(np.count_nonzero(marks[1:] & marks[:-1])) / solid,
        data.count(b"|") / n, data.count(b"!") / n, sum(w.isupper() and len(w) > 1 for w in words) / n,
        sum(w[-2:-1] in b"#$%&*!" and w[-1:] in b"#$%&*!" and len(w) > 2 for w in words) / n,
        sum(a == b for a, b in zip(lower, lower[1:])) / n, len(seen) / n, max(seen.values()) / n,
        len(set(zip(lower, lower[1:]))) / max(1, n - 1),
        1 - len(set(lines)) / len(lines), float(np.log1p(len(lines))), (data.count(b".") + data.count(b",")) / n,
    ]


def _expanded(x: np.ndarray) -> np.ndarray:
    """Features and their square roots, so that a little of a mark tells already."""
    return np.hstack([x, np.sqrt(np.abs(x))])


@dataclass(frozen=True)
class Classifier:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return predict((_expanded(x) - self.mean) / self.scale, self.weights) if len(x) else np.zeros(0)

    def column(self, shapes: Column) -> Column:
        """The evidence as a column, from that of :func:`shapes`."""
        model = self

        @F.pandas_udf("double")
        def evidence(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(model.scores(_features(batch)), dtype=float)

        return evidence(shapes)


def shapes(text: Column) -> Column:
    """The features of each text as bytes, computed over Arrow batches."""
    @F.pandas_udf("binary")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([np.array(shape(t), float).tobytes() for t in texts], dtype=object)

    return found(text)


def _features(found: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(found)).reshape(-1, len(FEATURES))


def labels_of(labels: DataFrame, label: str) -> DataFrame:
    """doc_id and y of the documents with a label of 0 or 1; those with contradicting labels are left out."""
    return labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min(label).alias("y"), F.max(label).alias("top")).where("y = top").select("doc_id", "y")


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, most: int, seed: int, *more: Column) -> DataFrame:
    """About ``most`` documents with a label of 0 or 1, chosen by a seeded hash of the id: doc_id,
    text, y and ``more``. Documents with contradicting labels are left out; copies of a row count once."""
    return _with_labels(docs.select("doc_id", "text", *more), bounded_sample(labels_of(labels, label), "doc_id", most, seed))


def _with_labels(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The documents that the labels name, with y; copies of a row count once."""
    return docs.join(chosen.select(F.col("doc_id").alias("__id"), "y"), F.col("doc_id") == F.col("__id")).drop("__id").dropDuplicates(["doc_id"])


def fit_classifier(docs: DataFrame, labels: DataFrame, settings: Quality = Quality(), *, host: str = "source",
                   path: str = "lang", shaped: str | None = None) -> tuple[Classifier, DataFrame]:
    """The classifier, fitted on one half of all labelled documents, and its evidence for the other half: rows (y, p, host, path).
    Without labels of both classes every document gets the evidence 1 and nothing is held out.

    ``shaped``: a column that holds the documents' :func:`shapes`; without it those of the labelled ones are computed."""
    known = docs.select("doc_id", F.col(host).cast("string").alias("__host"), F.col(path).cast("string").alias("__path"),
                        F.col(shaped or "text").alias("__of"))
    found = _with_labels(known, labels_of(labels, "quality").hint("merge")).withColumn("x", F.col("__of") if shaped else shapes(F.col("__of")))
    rows = settle(found.select("doc_id", F.col("y").cast("double").alias("y"), F.col("__host").alias("host"), F.col("__path").alias("path"),
                               (seeded(F.col("doc_id"), settings.seed + 1) < 0.5).alias("fit"), "x").sortWithinPartitions("doc_id"))
    fitted = rows.where("fit").select("x", "y")
    width = 2 * len(FEATURES)

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Single-precision features, widened, and classes."""
        for batch in batches:
            yield _expanded(_features(batch.column(0).to_pylist()).astype(np.float32).astype(float)), batch.column(1).to_numpy()

    counted = added_up(fitted, blocks, lambda some: sum((np.concatenate([[len(y), y.sum()], x.sum(0)]) for x, y in some), np.zeros(2 + width)))
    if not 0 < counted[1] < counted[0]:
        return Classifier(np.zeros(width), np.ones(width), np.array([0.0] * width + [35.0])), rows.where("false").select(
            "y", F.lit(0.0).alias("p"), "host", "path")
    mean = counted[2:] / counted[0]
    scale = np.sqrt(added_up(fitted, blocks, lambda some: sum((((x - mean) ** 2).sum(0) for x, _ in some), np.zeros(width))) / counted[0]) + 1e-6
    weights = fit_logistic_by_sums(fitted, lambda batches: (((x - mean) / scale, y) for x, y in blocks(batches)), width, counted[1] / counted[0])
    model = Classifier(mean, scale, weights)

    def judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _features(batch.column(0).to_pylist()).astype(np.float32).astype(float)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(model.scores(x), pa.float64()), batch.column(2), batch.column(3)],
                                             names=["y", "p", "host", "path"])

    return model, rows.where("NOT fit").select("x", "y", "host", "path").mapInArrow(judged, "y double, p double, host string, path string")


def threshold(held_out: DataFrame | pd.DataFrame, settings: Quality = Quality()) -> float:
    """From held-out rows (y, score): the largest score, at most ``top_threshold``, that ``keep_share`` of the
    good documents reach, or the one above it where lost good and kept bad documents cost least. Rows of one score are counted,
    and the counts cumulated in many tasks; the driver sees a few of these rows."""
    if isinstance(held_out, pd.DataFrame):
        held_out = SparkSession.active().createDataFrame(held_out[["y", "score"]].astype(float), "y double, score double")
    scores = settle(held_out.groupBy("score").agg(*(F.count_if(F.col("y") == v).cast("double").alias(n) for n, v in (("good", 1), ("bad", 0)))))
    good, bad = (float(v or 0) for v in scores.agg(F.sum("good"), F.sum("bad")).first())
    if not good:
        return 0.0
    below = settle(running_totals(scores, "score", ["good", "bad"], bucket_edges(scores, "score")).select(
        "score", "good", (F.col("all_good") - F.col("cum_good")).alias("lost"), (F.col("all_bad") - F.col("cum_bad")).alias("gone")))
    place = (good - 1) * (1 - settings.keep_share)
    first = np.floor(place)
    around = {i: r["score"] for r in below.where((F.col("good") > 0) & (F.col("lost") <= first + 1) & (F.col("lost") + F.col("good") > first)).collect()
              for i in (first, first + 1) if r["lost"] <= i < r["lost"] + r["good"]}
    least = float(np.quantile([around[first], around.get(first + 1, around[first])], place - first))
    if least >= settings.top_threshold or not bad:
        return min(settings.top_threshold, least)

    def cost(lost, gone):
        return settings.good_weight * (lost / good) + (1 - gone / bad)

    inside = below.where(F.col("score").between(least, settings.top_threshold)).agg(F.min(F.struct(cost(F.col("lost"), F.col("gone")).alias("cost"), "score"))).first()[0]
    ends = scores.agg(*(F.coalesce(F.sum(F.when(F.col("score") < cut, F.col(n))), F.lit(0.0)) for cut in (least, settings.top_threshold) for n in ("good", "bad"))).first()
    found = [(cost(*ends[:2]), least), (cost(*ends[2:]), settings.top_threshold)] + ([tuple(inside)] if inside else [])
    return float(min(found)[1])


def _odds(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(q / (1 - q))


def site_posteriors(evidence: DataFrame) -> tuple[DataFrame, float, float, float]:
    """From a stored table of host, path, p: one row per path with the sums of path and host
    (h_n, h_s, s_n, s_s), the global mean, and the prior strengths of hosts and of paths."""
    paths = settle(evidence.groupBy("host", "path").agg(F.count(F.lit(1)).alias("s_n"), F.sum("p").alias("s_s")))
    hosts = paths.groupBy("host").agg(F.sum("s_n").alias("h_n"), F.sum("s_s").alias("h_s"))
    hosts = hosts.withColumnRenamed("host", "h_host")
    sites = settle(paths.join(hosts, F.col("host").eqNullSafe(F.col("h_host"))).drop("h_host"))
    total = sites.agg(F.sum("s_n"), F.sum("s_s")).first()
    n, mean = total[0] or 0, (total[1] or 0.0) / (total[0] or 1)

    def strength(groups: DataFrame, size: str, observed: Column, centre: Column) -> float:
        """Beta-binomial: the mean squared distance to the centre is c(1-c)(1/n + (1-1/n)/(k+1))."""
        c = F.least(F.greatest(centre, F.lit(1e-6)), F.lit(1 - 1e-6))
        v = c * (1 - c)
        row = groups.agg(F.sum((observed - centre) ** 2), F.sum(v / F.col(size)), F.sum(v * (1 - 1 / F.col(size)))).first()
        between = ((row[0] or 0.0) - (row[1] or 0.0)) / (row[2] or 1.0)
        return 1e4 if between <= 1e-4 else max(1.0, 1 / min(between, 0.5) - 1)

    k_host = strength(hosts, "h_n", F.col("h_s") / F.col("h_n"), F.lit(mean))
    k_path = strength(sites, "s_n", F.col("s_s") / F.col("s_n"), F.col("h_s") / F.col("h_n"))
    return sites, mean if n else 0.5, k_host, k_path


Posteriors = tuple[DataFrame, float, float, float]


def joined(scored: DataFrame, p: str, host: str, path: str, posteriors: Posteriors,
           settings: Quality = Quality()) -> tuple[DataFrame, tuple[str, str]]:
    """``scored`` with the path's posterior and the document's score, in columns whose names are returned.
    A path that the posteriors lack has the global mean."""
    host_c, path_c = F.col(host).cast("string"), F.col(path).cast("string")
    sites, mean, k_host, k_path = posteriors
    sites = sites.select(*(F.col(c).alias(f"__{c}") for c in ("host", "path", "h_n", "h_s", "s_n", "s_s")))
    rows = scored.join(sites, host_c.eqNullSafe(F.col("__host")) & path_c.eqNullSafe(F.col("__path")), "left")
    site, score = fresh(scored, "site_quality", "score")
    others = lambda s, n, prior, k: F.coalesce((F.col(s) - F.col(p) + F.lit(k) * prior) / (F.col(n) - 1 + F.lit(k)), prior)
    host_mean = others("__h_s", "__h_n", F.lit(mean), k_host)
    shift = settings.site_weight * (_odds(F.col(site)) - _odds(F.lit(mean)))
    out = rows.withColumn(site, others("__s_s", "__s_n", host_mean, k_path)).withColumn(
        score, 1 / (1 + F.exp(-(_odds(F.col(p)) + shift))))
    return out.drop(*sites.columns), (site, score)


def combined(scored: DataFrame, p: str, host: str, path: str, settings: Quality = Quality()) -> tuple[DataFrame, tuple[str, str]]:
    """``joined`` with the posteriors of the rows themselves."""
    stored = settle(scored.select(F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"), F.col(p).alias("p")))
    return joined(scored, p, host, path, site_posteriors(stored), settings)


def held_out_scores(held_out: DataFrame | pd.DataFrame, posteriors: Posteriors, settings: Quality = Quality()) -> DataFrame | pd.DataFrame:
    """The held-out rows (y, score), each with its site's posterior: a table for a table, a frame for a frame."""
    if isinstance(held_out, pd.DataFrame):
        table = posteriors[0].sparkSession.createDataFrame(held_out, "y double, p double, host string, path string")
        return held_out_scores(table, posteriors, settings).toPandas()
    out, (_, score) = joined(held_out, "p", "host", "path", posteriors, settings)
    return out.select("y", F.col(score).alias("score"))


def quality_report(docs: DataFrame, labels: DataFrame, *, host: str = "source", path: str = "lang",
                   settings: Quality = Quality()) -> DataFrame:
    """Per document: doc_id, evidence, site_quality, score (0 to 1) and keep.

    Documents have no URL; their host is the source, their path the language within it. Null
    hosts and paths are sites of their own. A text without words has all features zero and is
    judged by them. Rows without labels are scored as all others; repeated rows stay.
    """
    known = settle(docs.select("doc_id", F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"), shapes(F.col("text")).alias("x")))
    model, held_out = fit_classifier(known, labels, settings, host="host", path="path", shaped="x")
    scored = settle(known.select("doc_id", "host", "path", model.column(F.col("x")).alias("p")))
    posteriors = site_posteriors(scored)
    out, (site, score) = joined(scored, "p", "host", "path", posteriors, settings)
    cut = threshold(held_out_scores(held_out, posteriors, settings), settings)
    return out.select("doc_id", F.col("p").alias("evidence"), F.col(site).alias("site_quality"), F.col(score).alias("score"),
                      (F.col(score) >= cut).alias("keep"))


def keep_good(docs: DataFrame, corpus: DataFrame, labels: DataFrame, *, host: str = "source", path: str = "lang",
              settings: Quality = Quality()) -> DataFrame:
    """The documents that are not rejected; columns as they came. ``corpus``: where the labelled
    documents are found. The documents are stored with their shapes, so that these are computed once, for the fit too where
    the corpus is the same table."""
    p, x = fresh(docs, "evidence", "shapes")
    stored = settle(docs.withColumn(x, shapes(F.col("text"))))
    if docs.sameSemantics(corpus):
        model, held_out = fit_classifier(stored, labels, settings, host=host, path=path, shaped=x)
    else:
        model, held_out = fit_classifier(corpus, labels, settings, host=host, path=path)
    scored = stored.withColumn(p, model.column(F.col(x))).drop(x)
    posteriors = site_posteriors(settle(scored.select(
        F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"), F.col(p).alias("p"))))
    out, (_, score) = joined(scored, p, host, path, posteriors, settings)
    cut = threshold(held_out_scores(held_out, posteriors, settings), settings)
    return out.where(F.col(score) >= cut).select(*docs.columns)

"""Toxicity by a classifier chain.

Categories are predicted one after the other by logistic models over the same word features; each
later model also sees the probabilities of the earlier ones. Those are out-of-fold predictions
when the later model is fitted, so it learns from them as they will be on new texts.

The vocabulary is counted by Spark over the sample of labelled documents: the words, and the
starts of longer words, whose presence goes with the label by the likelihood-ratio statistic. Word
starts catch the forms of a stem. The models are fitted on that
sample, whose bound is a parameter. Scoring is one narrow pass over all texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.linear import fit_logistic, predict, seeded
from tabwright.llm.quality import labelled_rows
from tabwright.llm.words import byte_texts, fresh, words_of
from tabwright.session import settle


@dataclass(frozen=True)
class Toxicity:
    """``seeds``: words that tell the kind of a document labelled toxic, by category; the last
    category is the label itself. ``sample``: most labelled documents fitted on."""

    seeds: tuple[tuple[str, tuple[str, ...]], ...] = (
        ("insult", ("idiot", "moron", "stupid", "loser", "clown")),
        ("contempt", ("trash", "worthless", "disgusting", "pathetic", "scum")),
    )
    sample: int = 20_000
    vocabulary: int = 200
    least_documents: int = 3
    least_gain: float = 10.8  # of the statistic, as a chi-square of one degree: 0.1 %
    folds: int = 4
    seed: int = 42

    @property
    def categories(self) -> list[str]:
        return [*(name for name, _ in self.seeds), "toxic"]


#: Bytes of a word's start.
STEM = 6


def tokens(text: bytes | None) -> tuple[Counter, int]:
    """How often each word and each start of a longer word (marked ``~``) stands in a text, and the
    number of words."""
    words = Counter(words_of((text or b"").lower()))
    out = Counter(words)
    for word, n in words.items():
        if len(word) > STEM:
            out[word[:STEM] + b"~"] += n
    return out, sum(words.values())


@dataclass
class Chain:
    vocabulary: list[bytes]
    models: list[np.ndarray] = field(default_factory=list)
    threshold: float = 0.5

    def __post_init__(self):
        self.place = {w: i for i, w in enumerate(self.vocabulary)}

    def features(self, text: bytes | None) -> np.ndarray:
        """Log counts of the vocabulary, and how many and what share of the text they are."""
        counts, n = tokens(text)
        out = np.zeros(len(self.place) + 2)
        for token in counts.keys() & self.place.keys():
            out[self.place[token]] = counts[token]
        hits = out.sum()
        return np.append(np.log1p(out[:-2]), [np.log1p(hits), hits / (n or 1)])

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """One column per category, each model fed with the columns before."""
        for w in self.models:
            x = np.hstack([x, predict(x, w)[:, None]])
        return x[:, len(self.place) + 2:]


def words_by_label(rows: DataFrame, settings: Toxicity) -> list[bytes]:
    """The words and word starts that go with the label: doc_id, text, y -> at most ``vocabulary``."""
    totals = rows.agg(F.sum("y"), F.count(F.lit(1))).first()
    positive, n = float(totals[0] or 0), float(totals[1] or 0)
    if not 0 < positive < n:
        return []

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(tokens(t)[0]) for t in byte_texts(batch.column(0))]
            for at in range(0, len(found), 256):
                some = found[at: at + 256]
                marks = np.repeat(batch.column(1).to_numpy()[at: at + 256], [len(f) for f in some])
                yield pa.RecordBatch.from_arrays([pa.array([w for f in some for w in f], pa.binary()),
                                                  pa.array(marks, pa.int32())], names=["word", "y"])

    counts = rows.select("text", F.col("y").cast("int").alias("y")).mapInArrow(cut, "word binary, y int").groupBy("word").agg(
        F.sum("y").cast("double").alias("a"), F.count(F.lit(1)).cast("double").alias("m")).where(
        (F.col("m") >= settings.least_documents) & (F.col("a") / F.col("m") > positive / n))

    def part(k, total, share):
        return F.when(k > 0, k * F.log(k / (total * F.lit(share)))).otherwise(0.0)

    a, m, share = F.col("a"), F.col("m"), positive / n
    rest_a, rest = F.lit(positive) - a, F.lit(n) - m
    gain = 2 * (part(a, m, share) + part(m - a, m, 1 - share) + part(rest_a, rest, share) + part(rest - rest_a, rest, 1 - share))
    best = counts.withColumn("gain", gain).where(F.col("gain") > settings.least_gain).orderBy(F.desc("gain"), "word").limit(settings.vocabulary)
    return [bytes(r["word"]) for r in best.collect()]


def fit_chain(docs: DataFrame, labels: DataFrame, settings: Toxicity = Toxicity()) -> Chain:
    """The chain for labels 0 and 1 in column ``toxic``. Without both, nothing is toxic."""
    rows = settle(labelled_rows(docs, labels, "toxic", settings.sample, settings.seed))
    chain = Chain(words_by_label(rows, settings))
    width = len(chain.vocabulary) + 2
    seeds = [[w.encode() for w in words] for _, words in settings.seeds]

    def featured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column(1))
            found = [set(words_of((t or b"").lower())) for t in texts]
            kinds = [[int(any(w in f for w in words)) for words in seeds] for f in found]
            x = [chain.features(t).astype(np.float32).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(2).cast(pa.int32()), pa.array(kinds, pa.list_(pa.int32())), pa.array(x, pa.binary()),
                                              batch.column(3)], names=["y", "kinds", "x", "fold"])

    data = rows.select("doc_id", "text", "y", F.floor(seeded(F.col("doc_id"), settings.seed + 1) * settings.folds).cast("int").alias("fold")).mapInArrow(
        featured, "y int, kinds array<int>, x binary, fold int").toPandas()
    y = data["y"].to_numpy(float)
    if len(set(y)) < 2:
        chain.models = [np.array([0.0] * (width + i) + [-35.0]) for i in range(len(settings.categories))]
        return chain
    x = np.array([np.frombuffer(b, np.float32) for b in data["x"]], float).reshape(len(data), width)
    kinds = np.array(data["kinds"].tolist(), float).reshape(len(data), len(seeds))
    fold = data["fold"].to_numpy()
    for target in (*(y * kinds[:, i] for i in range(len(seeds))), y):
        held_out = np.zeros(len(y))
        for f in range(settings.folds):
            inside = fold != f
            held_out[~inside] = predict(x[~inside], fit_logistic(x[inside], target[inside]))
        chain.models.append(fit_logistic(x, target))
        x = np.hstack([x, held_out[:, None]])
    chain.threshold = max(0.5, _best_threshold(held_out, y))
    return chain


def _best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The middle between the two neighbouring scores where F1 is best."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + y.sum())
    ends = np.append(np.flatnonzero(np.diff(p[order])), len(p) - 1)  # equal scores fall together
    at = ends[f1[ends].argmax()]
    below = p[order][at + 1] if at + 1 < len(p) else 0.0
    return float((p[order][at] + below) / 2)


def score(docs: DataFrame, chain: Chain, settings: Toxicity = Toxicity(), *, text: str = "text") -> tuple[DataFrame, list[str]]:
    """The documents without their text, with a probability per category and the verdict, in
    columns whose names are returned. A text without words has no word of the vocabulary and is
    judged by that; rows are judged one by one."""
    rest = [c for c in docs.columns if c != text]
    names = fresh(docs, *(f"p_{c}" for c in settings.categories), "toxic")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([chain.features(t) for t in byte_texts(batch.column(text))], float).reshape(batch.num_rows, len(chain.place) + 2)
            p = chain.probabilities(x)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), *(pa.array(p[:, i]) for i in range(p.shape[1])), pa.array(p[:, -1] > chain.threshold)],
                names=[*rest, *names])

    schema = docs.select(*rest).selectExpr("*", *(f"CAST(NULL AS double) AS {n}" for n in names[:-1]), f"CAST(NULL AS boolean) AS {names[-1]}").schema
    return docs.select(*rest, text).mapInArrow(work, schema), names


def toxicity_report(docs: DataFrame, labels: DataFrame, settings: Toxicity = Toxicity()) -> DataFrame:
    """Per document: doc_id, a probability per category (p_insult, p_contempt, p_toxic) and toxic."""
    found, names = score(docs.select("doc_id", "text"), fit_chain(docs, labels, settings), settings)
    return found.select("doc_id", *names)


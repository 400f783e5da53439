"""Language by the nearest centroid of TF-IDF vectors of letter n-grams.

A text is lower-cased and cut into words of letters and marks; its one-, two- and three-letter grams (word
ends are letters too) are counted in hashed slots, damped, weighted by how few of the training documents
hold them, and brought to length 1. Document frequencies are counted over all training documents. Each
language has several centroids, clustered by cosine on a bounded sample of its documents; a new
text has the language of the centroid with the greatest cosine. It is rejected, as of no learned language, where that
cosine is below what all but a small share of held-back sample documents of like length reach.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.linear import seeded
from tabwright.llm.words import fresh

#: What a text without letters, or any text where nothing was learned, is said to be.
UNKNOWN = "und"
#: Characters hashed at a time.
_STEP = 1 << 20


@dataclass(frozen=True)
class Languages:
    """``sample``: documents of a language that are clustered, about. ``reject``: share of held-back documents
    below the cut. ``max_languages``: more are an error, as the centroids of all are held at once."""

    slots: int = 8_192
    grams: int = 3
    clusters: int = 4
    sample: int = 600
    rounds: int = 12
    held_back: float = 0.3
    reject: float = 0.005
    max_languages: int = 200
    seed: int = 42


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter (1) or a mark (2)."""
    kinds = (unicodedata.category(chr(i))[0] for i in range(0x110000))
    return np.fromiter(({"L": 1, "M": 2}.get(k, 0) for k in kinds), np.uint8, 0x110000)


def gram_counts(text: str | None, settings: Languages) -> tuple[np.ndarray, int]:
    """Counts by slot, and the number of letters. A text without letters has no grams."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _letters()[points]
    letters = int((kind == 1).sum())
    counts = np.zeros(settings.slots, np.int64)
    if not letters:
        return counts, 0
    padded = np.zeros(len(points) + 2, np.uint32)
    padded[1:-1] = np.where(kind > 0, points, 0)
    keep = padded > 0
    keep[1:] |= padded[:-1] > 0  # one end between words
    keep[0] = True
    w = padded[keep].astype(np.uint64)
    for n in range(1, settings.grams + 1):
        for at in range(0, len(w) - n + 1, _STEP):
            part = w[at: at + _STEP + n - 1]
            size = len(part) - n + 1
            code = np.full(size, n, np.uint64)
            for i in range(n):
                code = (code ^ part[i: i + size]) * np.uint64(0x9E3779B97F4A7C15)
                code ^= code >> np.uint64(29)
            whole = np.ones(size, bool)
            for i in range(1, n - 1):
                whole &= part[i: i + size] > 0
            if n == 1:
                whole = part > 0
            counts += np.bincount((code[whole] % np.uint64(settings.slots)).astype(np.int64), minlength=settings.slots)
    return counts, letters


def unit_vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Damped, weighted and brought to length 1, row by row."""
    x = (np.log1p(counts) * idf).astype(np.float32)
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def cluster(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """At most ``k`` centroids of unit vectors by cosine, the first one the mean, seeded farthest first."""
    def unit(c: np.ndarray) -> np.ndarray:
        return c / max(float(np.sqrt((c * c).sum())), 1e-12)

    centres = [unit(x.mean(0))]
    near = x @ centres[0]
    while len(centres) < min(k, len(x)) and near.min() < 1 - 1e-6:
        centres.append(x[near.argmin()])
        near = np.maximum(near, x @ centres[-1])
    now = np.array(centres)
    for _ in range(rounds):
        own = (x @ now.T).argmax(1)
        after = np.array([unit(x[own == i].mean(0)) if (own == i).any() else now[i] for i in range(len(now))])
        if np.allclose(after, now, atol=1e-6):
            break
        now = after
    return now


@dataclass
class Centroids:
    """Languages in order, a centroid per row with its language's place, and the least cosine by length class."""

    names: list[str]
    idf: np.ndarray
    vectors: np.ndarray
    of: np.ndarray
    least: np.ndarray = field(default_factory=lambda: np.zeros(64))

    def judge(self, texts: list[str | None], settings: Languages) -> list[tuple[str, float, bool]]:
        """Language, cosine held within 0 and 1, and whether it is rejected, of each text."""
        found = [gram_counts(t, settings) for t in texts]
        letters = np.array([n for _, n in found])
        if not self.names:
            return [(UNKNOWN, 0.0, True)] * len(texts)
        near = unit_vectors(np.array([c for c, _ in found]).reshape(len(found), settings.slots), self.idf) @ self.vectors.T
        at, top = near.argmax(1), near.max(1).clip(0, 1)
        return [(self.names[self.of[a]], float(s), bool(s < self.least[length_class(n)])) if n else (UNKNOWN, 0.0, True)
                for a, s, n in zip(at, top, letters.tolist())]


def length_class(letters: int) -> int:
    return int(letters).bit_length()


def _least_by_class(held: list[tuple[int, float]], share: float) -> np.ndarray:
    """The cut of each length class; one without held-back texts has that of the next shorter class with some,
    else of the next longer one."""
    by_class: dict[int, list[float]] = {}
    for n, cosine in held:
        by_class.setdefault(length_class(n), []).append(cosine)
    out = np.zeros(64)
    known = sorted(by_class)
    for c in range(64):
        below = [k for k in known if k <= c]
        if known:
            out[c] = np.quantile(by_class[below[-1] if below else known[0]], share, method="lower")
    return out


def learn(docs: DataFrame, settings: Languages = Languages(), *, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Centroids:
    """Centroids of the languages of ``docs``. Rows without text, letters or language teach nothing; of several
    rows of one key and language one is clustered, the least text, and all count in the frequencies."""
    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        "lang IS NOT NULL")

    def holding(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(settings.slots, np.int64), 0
        for batch in batches:
            for value in batch.column(0):
                counts, letters = gram_counts(value.as_py(), settings)
                held += counts > 0
                n += letters > 0
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, settings.slots), pa.int32()), pa.array(np.append(n, held))], names=["slot", "n"])

    sums = {r["slot"]: r["n"] for r in rows.select("text").where("text IS NOT NULL").mapInArrow(holding, "slot int, n long")
            .groupBy("slot").agg(F.sum("n").alias("n")).collect()}  # a row per slot
    n = sums.get(-1, 0)
    idf = np.log((1 + n) / (1 + np.array([sums.get(i, 0) for i in range(settings.slots)]))) + 1
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(settings.max_languages + 1).collect()}
    if len(sizes) > settings.max_languages:
        raise ValueError(f"more than {settings.max_languages} languages")
    if not n:
        return Centroids([], idf, np.zeros((0, settings.slots), np.float32), np.zeros(0, int))
    rate = F.create_map(*(F.lit(x) for name, size in sizes.items() for x in (name, min(1.0, settings.sample / size))))
    chosen = rows.where((seeded(F.col("key"), settings.seed) < rate[F.col("lang")]) & F.col("text").isNotNull()).groupBy("lang", "key").agg(
        F.min("text").alias("text"))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key", key=lambda k: k.fillna(""))
        found = [gram_counts(t, settings) for t in group["text"]]
        back = group["back"].to_numpy()[[n > 0 for _, n in found]]
        found = [f for f in found if f[1]]
        if not found:
            return pd.DataFrame({"lang": [], "centres": [], "letters": [], "cosines": []})
        x = unit_vectors(np.array([c for c, _ in found]), idf)
        if not 0 < back.sum() < len(back):
            fitted = tested = np.ones(len(x), bool)  # too few to hold any back
        else:
            fitted, tested = ~back, back
        centres = cluster(x[fitted], settings.clusters, settings.rounds)
        return pd.DataFrame({"lang": [group["lang"].iloc[0]], "centres": [centres.astype(np.float32).tobytes()],
                             "letters": [[n for (_, n), t in zip(found, tested) if t]],
                             "cosines": [(x[tested] @ centres.T).max(1).astype(float).tolist()]})

    fitted = chosen.withColumn("back", seeded(F.col("key"), settings.seed + 1) < settings.held_back).groupBy("lang").applyInPandas(
        fit, "lang string, centres binary, letters array<long>, cosines array<double>").collect()  # one row per language, of bounded size
    fitted.sort(key=lambda r: r["lang"])
    vectors = [np.frombuffer(r["centres"], np.float32).reshape(-1, settings.slots) for r in fitted]
    held = [pair for r in fitted for pair in zip(r["letters"], r["cosines"])]
    return Centroids([r["lang"] for r in fitted], idf, np.vstack(vectors) if vectors else np.zeros((0, settings.slots), np.float32),
                     np.repeat(np.arange(len(fitted)), [len(v) for v in vectors]), _least_by_class(held, settings.reject))


def identify(docs: DataFrame, model: Centroids, settings: Languages = Languages(), *, text: str = "text") -> tuple[DataFrame, list[str]]:
    """The documents without their text, with language, score (the cosine, 0 to 1) and whether it is rejected, in columns
    whose names are returned. A text that is null or has no letter is ``und``, score 0, rejected. Rows are
    judged one by one; on a tie the language first by code point is taken."""
    rest = [c for c in docs.columns if c != text]
    names = fresh(docs, "lang_pred", "score", "rejected")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most max_languages * clusters rows

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = shared.value.judge(part.column(text).to_pylist(), settings)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), *(pa.array([r[i] for r in out], kind) for i, kind in enumerate(
                    (pa.string(), pa.float64(), pa.bool_())))], names=[*rest, *names])

    schema = docs.select(*rest).selectExpr("*", *(f"CAST(NULL AS {k}) AS {n}" for n, k in zip(names, ("string", "double", "boolean")))).schema
    return docs.select(*rest, text).mapInArrow(work, schema), names


def held_out(key: Column) -> Column:
    """Documents kept from learning: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def language_report(docs: DataFrame, settings: Languages = Languages()) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected. Documents without an id are not held out, nor learned from."""
    model = learn(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))), settings)
    found, names = identify(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), model, settings)
    return found.select("doc_id", "held_out", *names)

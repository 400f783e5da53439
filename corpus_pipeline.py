"""A corpus pipeline: quality, near duplicates, benchmark passages, secrets, mixing.

Every stage takes (spark, docs, sf_dir) and returns a table, which is written as Parquet and
read again as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm.decontaminate import remove_contaminated
from tabwright.llm.mix import mix
from tabwright.llm.quality import keep_good
from tabwright.llm.secrets import redact
from tabwright.llm.simhash import drop_near_copies
from tabwright.llm.words import fresh
from tabwright.session import settle
from tabwright.sources.tables import parquet


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, with its site posteriors, does not reject."""
    return keep_good(docs, parquet(spark, sf_dir, "documents"), parquet(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (0.8 of the five-word shingles), that of the least id."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return remove_contaminated(docs, parquet(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; n_chars follows where the text changed."""
    return redact(docs, length="n_chars" if "n_chars" in docs.columns else None)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes: doc_id, source, size, source_size, target and taken words."""
    chosen, names = mix(docs.select("doc_id", "source", "text"))
    shown = chosen.select("doc_id", "source", *(
        F.col(n).alias(a) for n, a in zip(names, ("size", "source_size", "target", "taken"))))
    return shown.where("taken > 0")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mixing", mixing),
]

#: The classifier and the fingerprints are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = parquet(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs

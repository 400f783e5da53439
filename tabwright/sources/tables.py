"""Readers (A1, A2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.operators.clean import quoted
from tabwright.params import NA_TOKENS
from tabwright.sources.records import records


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    na_tokens: Sequence[str] = NA_TOKENS,
    multiline: bool = True,
) -> DataFrame:
    """Headered CSV (A1). Pass a schema for large inputs: inference reads the files twice.

    A cell whose whole text is an NA token is null; the text ``None`` stays a level.
    Cells are read as text and then cast, so a token never makes a number column text.

    Quoted cells may hold line breaks, and large files are split all the same, at the price of a first pass that counts
    quotes (:mod:`tabwright.sources.records`); a file that ends inside a quoted cell is a ValueError. ``multiline=False``
    takes every line as a row and saves that pass. A row with too few or too many cells is an error when it is read.
    """
    if multiline:
        names = spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"', multiLine=True).columns
        cells = F.from_csv("record", ", ".join(f"c{i} string" for i in range(len(names))),
                           {"quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST"})
        raw = records(spark, path).where("NOT is_head").select(cells.alias("r")).select(*(F.col(f"r.c{i}").alias(c) for i, c in enumerate(names)))
    else:
        raw = spark.read.option("columnPruning", False).csv(
            path, header=True, inferSchema=False, quote='"', escape='"', mode="FAILFAST")
    texts = raw.select(*(F.when(~quoted(c).isin(*na_tokens), quoted(c)).alias(c) for c in raw.columns))
    if schema is None:
        wanted = _inferred(texts)
    elif isinstance(schema, str):
        wanted = T.StructType.fromDDL(schema)
    else:
        wanted = schema
    by_name = {f.name: f.dataType for f in wanted}
    return texts.select(
        *((quoted(c) if isinstance(by_name[c], T.StringType) else F.trim(quoted(c)).cast(by_name[c])).alias(c)
          for c in texts.columns if c in by_name)
    )


def read_table(spark: SparkSession, path: str, **options) -> DataFrame:
    """CSV or Parquet by the path's ending."""
    if path.rstrip("/").lower().endswith((".csv", ".csv.gz")):
        return read_csv(spark, path, **options)
    return spark.read.parquet(path)


def parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One named table of a folder of Parquet tables."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _inferred(texts: DataFrame) -> T.StructType:
    """Long, double or string per column, in one aggregate over the texts."""
    row = texts.agg(*(
        F.struct(
            F.count(quoted(c)).alias("n"),
            F.count(F.trim(quoted(c)).try_cast("long")).alias("longs"),
            F.count(F.when(quoted(c).rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"), 1)).alias("doubles"),
            F.count_if(quoted(c).rlike(r"[.eE]")).alias("pointed"),
        ).alias(c) for c in texts.columns
    )).first()

    def kind(s):
        if s["n"] and s["longs"] == s["n"] and not s["pointed"]:
            return T.LongType()
        if s["n"] and s["doubles"] == s["n"]:
            return T.DoubleType()
        return T.StringType()

    return T.StructType([T.StructField(c, kind(row[c])) for c in texts.columns])

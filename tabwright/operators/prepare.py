"""Imputation, scaling and one-hot encoding as one fitted Spark ML pipeline.

The statistics differ from those of the stock imputer and scaler (exact median,
population deviation, lowest mode on a tie), so they are aggregated here and put into
stock stages that save, load and run on the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators.clean import drop_columns, numeric_columns, quoted
from tabwright.operators.profile import value_counts_by_column
from tabwright.operators.quality import missing_columns
from tabwright.operators.quantiles import exact_medians
from tabwright.params import FeatureParams

# the levels become slots of the vector and entries of its schema, which the driver holds
MAX_LEVELS = 1_000_000


class TablePreparer:
    """Fit on one table, apply to any: numerics first, then one-hot levels."""

    def __init__(self, features: FeatureParams = FeatureParams(), model: PipelineModel | None = None, max_levels: int = MAX_LEVELS):
        self.features = features
        self.model = model
        self.max_levels = max_levels

    def fit(self, df: DataFrame) -> TablePreparer:
        self.model = fit_preparation(
            drop_columns(df, self.features.dropped), self.features.numeric, self.features.categorical, max_levels=self.max_levels
        )
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the vector column ``features``; ValueError before a fit."""
        if self.model is None:
            raise ValueError("Preparation must be fitted before transforming data")
        return self.model.transform(drop_columns(df, self.features.dropped))

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def feature_names(self, df: DataFrame) -> list[str]:
        """``num__<column>`` and ``cat__<column>_<level>`` in vector order."""
        return vector_names(self.transform(df))


def vector_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector's slots, from its metadata."""
    groups = df.schema[column].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for group in groups.values() for a in group)
    return [name for _, name in slots]


def numeric_statistics(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float, float]]:
    """Median, then mean and population deviation of the median-filled column.

    A column without any number is left out; a constant one gets deviation 1.
    """
    medians = {c: m for c, m in exact_medians(df, columns).items() if m is not None}
    if not medians:
        return {}
    filled = {c: F.coalesce(_number(c), F.lit(m)) for c, m in medians.items()}
    row = df.agg(*(
        F.struct(F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), (F.min(x) == F.max(x)).alias("flat")).alias(c)
        for c, x in filled.items()
    )).first()
    return {
        c: (m, row[c]["mean"], 1.0 if row[c]["flat"] or not row[c]["std"] else row[c]["std"])
        for c, m in medians.items()
    }


def most_frequent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent non-null value per column, the lowest on a tie."""
    parts: dict[str, list[str]] = {}
    for c in columns:
        parts.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    result = None
    for names in parts.values():
        long = df.select(*(quoted(c) for c in names)).unpivot([], [quoted(c) for c in names], "column", "value")
        counted = long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(
            F.count(F.lit(1)).alias("n")
        )
        best = counted.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("rank"), "value")).alias("best"))
        rows = best.select("column", F.col("best.value").cast("string").alias("value"), (-F.col("best.rank")).alias("n"))
        result = rows if result is None else result.unionByName(rows)
    return result


def impute(df: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = ()) -> DataFrame:
    """Null numbers become the median, null levels the mode."""
    fills = {c: F.coalesce(_number(c), F.lit(m)) for c, m in exact_medians(df, numeric).items() if m is not None}
    if categorical:
        for row in most_frequent(df, categorical).collect():
            fills[row["column"]] = F.coalesce(
                quoted(row["column"]), F.lit(row["value"]).cast(df.schema[row["column"]].dataType)
            )
    return df.select(*(fills.get(c, quoted(c)).alias(c) for c in df.columns))


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Median-filled columns minus mean over population deviation."""
    stats = numeric_statistics(df, columns)
    scaled = {
        c: (F.coalesce(_number(c), F.lit(m)) - F.lit(mean)) / F.lit(std) for c, (m, mean, std) in stats.items()
    }
    return df.select(*(scaled.get(c, quoted(c)).alias(c) for c in df.columns))


def fit_preparation(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], into: str = "features",
    max_levels: int = MAX_LEVELS,
) -> PipelineModel:
    """Fit G1-G4 and chain them into one vector column.

    Each level is a slot of the vector; a column with more than ``max_levels`` is a ValueError. An unknown or null level at transform becomes, respectively, all zeros or the mode.
    """
    missing = missing_columns(df, (*numeric, *categorical))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    texts = [c for c in numeric if c not in set(numeric_columns(df))]
    if texts:
        raise ValueError(f"Column {texts[0]} must be numeric")

    stats = numeric_statistics(df, numeric)
    levels = _levels(df, categorical, max_levels)
    expressions, hidden = [], []
    for c, (median, mean, std) in stats.items():
        number = f"coalesce(nanvl(cast({_name(c)} as double), cast(null as double)), {_double(median)})"
        expressions.append(f"({number} - {_double(mean)}) / {_double(std)} AS {_name('num__' + c)}")
        hidden.append("num__" + c)
    for c, (mode, _) in levels.items():
        expressions.append(f"coalesce(cast({_name(c)} as string), {_text(mode)}) AS {_name('level__' + c)}")
        hidden += ["level__" + c, "index__" + c, "cat__" + c]

    stages: list = [SQLTransformer(statement=f"SELECT *, {', '.join(expressions)} FROM __THIS__")]
    if levels:
        # one indexer per column: the constructor for several pads short label lists
        stages += [
            StringIndexerModel.from_labels(
                values, inputCol="level__" + c, outputCol="index__" + c, handleInvalid="keep"
            )
            for c, (_, values) in levels.items()
        ]
        encoder = OneHotEncoder(
            inputCols=["index__" + c for c in levels], outputCols=["cat__" + c for c in levels], dropLast=True
        )
        # the sizes are in the indexers' metadata, so this fit reads no data
        stages.append(encoder.fit(PipelineModel(stages).transform(df)))
    stages.append(VectorAssembler(
        inputCols=["num__" + c for c in stats] + ["cat__" + c for c in levels], outputCol=into,
        handleInvalid="error",
    ))
    stages.append(SQLTransformer(
        statement=f"SELECT * EXCEPT ({', '.join(_name(h) for h in hidden)}) FROM __THIS__"
    ))
    return PipelineModel(stages)


def _levels(df: DataFrame, columns: Sequence[str], max_levels: int) -> dict[str, tuple[str, list[str]]]:
    """Mode and sorted levels per column; a column without any level is left out."""
    if not columns:
        return {}
    sizes = df.agg(*(F.approx_count_distinct(quoted(c)).alias(c) for c in columns)).first()
    wide = [c for c in columns if sizes[c] > max_levels]
    if wide:
        raise ValueError(f"{wide[0]} has too many levels for one slot each")
    counts: dict[str, list] = {}
    for row in value_counts_by_column(df, columns).collect():
        counts.setdefault(row["column"], []).append((row["value"], row["n"]))
    return {
        c: (min(counts[c], key=lambda p: (-p[1], p[0]))[0], sorted(v for v, _ in counts[c]))
        for c in columns if c in counts
    }


def _number(name: str):
    return F.nanvl(quoted(name).cast("double"), F.lit(None).cast("double"))


def _name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _double(value: float) -> str:
    return f"cast('{value!r}' as double)"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

"""Preprocessing fitted once and applied as a plain projection.

Fitting measures medians, means, population deviations, modes and category lists on
the cluster. The fitted transform is a pipeline of stock stages, so it persists with
the model, needs no Python worker and applies equally to batches and streams."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortica.functions.columns import (
    as_double, melt_text, ref, split_columns, sql_double, sql_name, sql_text,
)
from cohortica.operators.quantiles import medians

@dataclass
class Fitted:
    """Measured statistics and the stages built from them."""

    numeric: list[str]
    categorical: list[str]
    binarised: list[str]
    medians: dict[str, float]
    means: dict[str, float]
    deviations: dict[str, float]
    modes: dict[str, str]
    categories: dict[str, list[str]]
    feature_names: list[str] = field(default_factory=list)
    model: PipelineModel | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    """Most frequent text of each column, the smallest on a tie, nulls left out."""
    if not cols:
        return {}
    counts = melt_text(df, cols).where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"))
    top = counts.groupBy("column").agg(F.min(F.struct(-F.col("n"), F.col("value"))).alias("top"))
    return {r["column"]: r["top"]["value"] for r in top.collect()}


def category_counts(df: DataFrame, cols: Sequence[str]) -> dict[str, dict[str, int]]:
    """Rows per text of each column. Every text becomes a column of the model's matrix, whose names the driver holds."""
    if not cols:
        return {}
    rows = melt_text(df, cols).where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")).collect()
    found: dict[str, dict[str, int]] = {c: {} for c in cols}
    for r in rows:
        found[r["column"]][r["value"]] = r["n"]
    return found


def numeric_moments(df: DataFrame, cols: Sequence[str], fill: dict[str, float]):
    """Mean and population deviation of each column after filling its nulls."""
    if not cols:
        return {}, {}
    filled = [F.coalesce(as_double(c), F.lit(fill[c])) for c in cols]
    row = df.agg(*[F.avg(v).alias(f"m{i}") for i, v in enumerate(filled)],
                 *[F.stddev_pop(v).alias(f"s{i}") for i, v in enumerate(filled)]).first()
    return ({c: row[f"m{i}"] for i, c in enumerate(cols)}, {c: row[f"s{i}"] for i, c in enumerate(cols)})


def fit(df: DataFrame, features: Sequence[str], binarised: Sequence[str] = (), threshold: float = 1,
        middles: dict[str, float | None] | None = None) -> Fitted:
    """Flags (if any) first, then scaled numeric columns, then one-hot categories.

    ``middles``: the medians of the numeric columns of ``df``, if they are known."""
    absent = [c for c in binarised if c not in features]
    if absent:
        raise ValueError(f"columns to binarise not found: {absent}")
    data = df.select(*[ref(c) for c in features])
    numeric, categorical = split_columns(data)
    scaled = [c for c in numeric if c not in binarised]
    known = medians(data, scaled) if middles is None else middles
    fill = {c: 0.0 if known[c] is None else float(known[c]) for c in scaled}
    means, deviations = numeric_moments(data, scaled, fill)
    counts = category_counts(data, categorical)
    common = {c: min(n, key=lambda v: (-n[v], v)) for c, n in counts.items() if n}
    out = Fitted(scaled, categorical, list(binarised), fill, means, deviations, common,
                 {c: sorted(n) for c, n in counts.items()})
    out.model = _stages(out, threshold, df.sparkSession)
    return out


def _stages(f: Fitted, threshold: float, spark) -> PipelineModel:
    parts, inputs, names, indexed = [], [], [], []
    for i, c in enumerate(f.binarised):
        parts.append(f"CASE WHEN CAST({sql_name(c)} AS DOUBLE) >= {sql_double(threshold)} "
                     f"AND NOT isnan(CAST({sql_name(c)} AS DOUBLE)) THEN 1D ELSE 0D END AS _flag_{i}")
        inputs.append(f"_flag_{i}")
        names.append(f"binarize__{c}")
    for i, c in enumerate(f.numeric):
        # nanvl turns NaN into the median as well
        value = f"nanvl(CAST({sql_name(c)} AS DOUBLE), {sql_double(f.medians[c])})"
        spread = f.deviations[c] or 1.0
        parts.append(f"(coalesce({value}, {sql_double(f.medians[c])}) - {sql_double(f.means[c])}) "
                     f"/ {sql_double(spread)} AS _num_{i}")
        inputs.append(f"_num_{i}")
        names.append(f"num__{c}")
    for i, c in enumerate(f.categorical):
        cats = f.categories[c]
        if len(cats) < 2:
            continue  # the only category is the dropped one
        parts.append(f"coalesce(CAST({sql_name(c)} AS STRING), {sql_text(f.modes[c])}) AS _cat_{i}")
        indexed.append((f"_cat_{i}", f"_idx_{i}", f"_hot_{i}", cats[1:]))
        names += [f"cat__{c}_{v}" for v in cats[1:]]
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")]
    if indexed:
        # The first category and texts unseen in fitting share the index behind the listed ones, which is dropped.
        indexers = [StringIndexerModel.from_labels(labels, inputCol=text, outputCol=index, handleInvalid="keep")
                    for text, index, _, labels in indexed]
        # The encoder reads the sizes from the index columns' metadata; no data is scanned.
        sized = PipelineModel(indexers).transform(spark.createDataFrame([], T.StructType(
            [T.StructField(x[0], T.StringType()) for x in indexed])))
        encoder = OneHotEncoder(inputCols=[x[1] for x in indexed], outputCols=[x[2] for x in indexed],
                                dropLast=True).fit(sized)
        stages += [*indexers, encoder]
        inputs += [x[2] for x in indexed]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    f.feature_names = names
    return PipelineModel(stages)

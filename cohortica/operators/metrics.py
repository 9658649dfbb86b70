"""Evaluation of scored tables: exact ROC AUC, classification report, confusion matrix.

A scored table has a class code ``label``, a ``prediction`` and an array
``probability``; ``keys`` (such as the model name) evaluate many models in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortica.operators.ranges import add_bucket, value_cuts


def class_scores(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows (keys..., class, score, hit), one per scored row and class."""
    return scored.select(
        *keys, F.col("label").cast("int").alias("label"), F.posexplode("probability").alias("class", "score")
    ).select(*keys, "class", "score", (F.col("label") == F.col("class")).cast("int").alias("hit"))


def class_auc(scored: DataFrame, keys: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """One-vs-rest AUC by class, tied scores counted half: (keys..., class, positives, negatives, auc)."""
    long = class_scores(scored, keys)
    cuts = value_cuts(long, "score", buckets)
    counts = long.groupBy(*keys, "class", "score").agg(
        F.sum("hit").alias("pos"), F.sum(1 - F.col("hit")).alias("neg"))
    counts = add_bucket(counts, "score", cuts)
    inner = Window.partitionBy(*keys, "class", "bucket").orderBy("score").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    below = F.sum("neg").over(inner) - F.col("neg")
    totals = (
        counts.withColumn("wins", F.col("pos") * (below + F.col("neg") / 2))
        .groupBy(*keys, "class", "bucket")
        .agg(F.sum("wins").alias("wins"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    # One row per bucket from here on.
    outer = Window.partitionBy(*keys, "class").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    before = F.sum("neg").over(outer) - F.col("neg")
    return (
        totals.withColumn("wins", F.col("wins") + F.col("pos") * before.cast("double"))
        .groupBy(*keys, "class")
        .agg(F.sum("wins").alias("wins"), F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
        .select(*keys, "class", "positives", "negatives",
                F.try_divide(F.col("wins"), F.col("positives").cast("double") * F.col("negatives")).alias("auc"))
    )


def weighted_auc(scored: DataFrame, keys: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Mean of the class AUCs weighted by class size: (keys..., roc_auc)."""
    return class_auc(scored, keys, buckets).groupBy(*keys).agg(
        F.try_divide(F.sum(F.col("auc") * F.col("positives")),
                     F.sum(F.when(F.col("auc").isNotNull(), F.col("positives")))).alias("roc_auc"))


def confusion_cells(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return scored.groupBy(
        *keys, F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(scored: DataFrame, n_classes: int, keys: Sequence[str] = ()) -> DataFrame:
    """One row per true class, a column ``pred_<code>`` per predicted class."""
    cells = confusion_cells(scored, keys)
    return cells.groupBy(*keys, "label").agg(*[
        F.sum(F.when(F.col("prediction") == i, F.col("n")).otherwise(0)).alias(f"pred_{i}")
        for i in range(n_classes)
    ])


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def class_report(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support for every true or predicted class."""
    cells = confusion_cells(scored, keys)
    right = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                 right.cast("bigint").alias("right")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("right")),
    )
    counts = cells.select(*keys, F.inline(sides)).groupBy(*keys, "class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("right").alias("right"))
    precision = _ratio(F.col("right"), F.col("predicted"))
    recall = _ratio(F.col("right"), F.col("support"))
    f1 = _ratio(2 * F.col("right"), F.col("predicted") + F.col("support"))
    return counts.select(*keys, "class", "right", "support", precision.alias("precision"),
                         recall.alias("recall"), f1.alias("f1_score"))


def classification_report(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Class rows, ``accuracy`` (repeated in every column), ``macro avg`` and ``weighted avg``."""
    rows = class_report(scored, keys)
    scores = ["precision", "recall", "f1_score"]
    per_class = rows.select(*keys, F.col("class").cast("string").alias("row_label"), *scores,
                            F.col("support").cast("double").alias("support"))
    total = F.sum("support")
    overall = rows.groupBy(*keys).agg(
        (F.sum("right") / total).alias("accuracy"),
        F.array(*[F.avg(c) for c in scores], total.cast("double")).alias("macro"),
        F.array(*[F.sum(F.col(c) * F.col("support")) / total for c in scores], total.cast("double")).alias("weighted"),
    )
    one = F.col("accuracy")
    summary = overall.select(*keys, F.inline(F.array(
        F.struct(F.lit("accuracy").alias("row_label"), one.alias("precision"), one.alias("recall"),
                 one.alias("f1_score"), one.alias("support")),
        *[F.struct(F.lit(label).alias("row_label"), *[
            F.get(F.col(name), i).alias(c) for i, c in enumerate([*scores, "support"])])
          for label, name in (("macro avg", "macro"), ("weighted avg", "weighted"))],
    )))
    return per_class.unionByName(summary)


def full_report(scored: DataFrame, keys: Sequence[str] = ("model",), buckets: int | None = None) -> DataFrame:
    """Classification report widened by a ``roc_auc`` row and column."""
    auc = weighted_auc(scored, keys, buckets).select(*keys, F.lit("roc_auc").alias("row_label"), "roc_auc")
    return classification_report(scored, keys).unionByName(auc, allowMissingColumns=True)

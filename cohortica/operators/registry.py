"""Trained models as rows: summaries over the report table, best model, what is left to train."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")


def cell(row_label: str, column: str) -> Column:
    """Value at a report row and column, for use in an aggregate by model."""
    return F.max(F.when(F.col("row_label") == row_label, F.col(column)))


def summary_cells(reports: DataFrame) -> DataFrame:
    """One row per model: accuracy, weighted precision, recall and F1, ROC AUC; null where its report lacks the cell."""
    return reports.groupBy("model").agg(
        cell("accuracy", "f1_score").alias("accuracy"),
        cell("weighted avg", "precision").alias("precision"),
        cell("weighted avg", "recall").alias("recall"),
        cell("weighted avg", "f1_score").alias("f1"),
        cell("roc_auc", "roc_auc").alias("roc_auc"),
    )


def readable(cells: DataFrame) -> DataFrame:
    """Models whose report has every cell."""
    return cells.na.drop("any", subset=list(METRICS))


def summary(reports: DataFrame) -> DataFrame:
    """``summary_cells`` without the models whose report lacks one of the cells, as unreadable."""
    return readable(summary_cells(reports))


def run_summary(reports: DataFrame, trained: DataFrame) -> DataFrame:
    """``summary`` of the models trained in this run; ``trained`` has a column ``model``."""
    return summary(reports.join(trained.select("model").distinct(), "model", "left_semi"))


def lenient_summary(reports: DataFrame) -> DataFrame:
    """Summary that takes macro averages where weighted ones are absent and keeps nulls."""
    has_weighted = F.max((F.col("row_label") == "weighted avg").cast("int")) == 1

    def average(column):
        return F.when(has_weighted, cell("weighted avg", column)).otherwise(cell("macro avg", column))

    f1 = "f1_score" if "f1_score" in reports.columns else "f1"
    return reports.groupBy("model").agg(
        cell("accuracy", "precision").alias("accuracy"),
        average("precision").alias("precision"),
        average("recall").alias("recall"),
        average(f1).alias("f1"),
        cell("roc_auc", "roc_auc").alias("roc_auc"),
    )


def arg_max_auc(table: DataFrame) -> DataFrame:
    """Row with the highest AUC; nulls never win over values, ties go to the first name."""
    return table.orderBy(F.desc_nulls_last("roc_auc"), "model").limit(1)


def best_model(reports: DataFrame) -> DataFrame:
    """(model, roc_auc) of the best report; an AUC of zero or null never wins."""
    table = reports.where("row_label = 'roc_auc'").select("model", "roc_auc").where("roc_auc > 0")
    return arg_max_auc(table)


def register_best(reports: DataFrame, models: DataFrame) -> DataFrame:
    """Best model with the path of its artifact; ``models`` has (model, path)."""
    return best_model(reports).join(models, "model", "left").select("model", "roc_auc", "path")


def left_to_train(configs: DataFrame, trained: DataFrame, run_all: bool = False) -> DataFrame:
    """Configurations without a trained model, or all of them on request."""
    return configs if run_all else configs.join(trained.select("model").distinct(), "model", "left_anti")


def long_metrics(table: DataFrame, metrics=METRICS) -> DataFrame:
    """(model, metric, value) for comparison across models."""
    present = [m for m in metrics if m in table.columns]
    return table.unpivot("model", present, "metric", "value")


def rounded_metrics(table: DataFrame, digits: int = 4) -> DataFrame:
    return table.select(*[
        F.round(c, digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in table.dtypes
    ])

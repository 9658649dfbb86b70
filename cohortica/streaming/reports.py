"""The summary of models kept up to date while their report files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortica.operators import registry
from cohortica.workspace import remove


def follow_reports(reports: DataFrame, out: str, checkpoint: str):
    """Start a query over a stream of report rows (model, row_label, metrics) and return it.

    Its state is a row per model with the cells of its summary; each cell is a greatest value, so neither the order of
    arrival nor repeated files matter. Every batch writes the whole table under its own number, so a batch that
    is run again replaces itself, and a restart goes on from the state of the ``checkpoint``."""
    def put(table: DataFrame, number: int) -> None:
        table.write.mode("overwrite").parquet(f"{out}/{number:010d}")
        if number >= 2:
            remove(table.sparkSession, f"{out}/{number - 2:010d}")  # a reader may still hold the one before

    return (
        registry.summary_cells(reports).writeStream.outputMode("complete").foreachBatch(put)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _latest(spark: SparkSession, out: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(out)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [str(f.getPath()) for f in files.listStatus(path) if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
    return spark.read.parquet(max(done))


def summary_so_far(spark: SparkSession, out: str) -> DataFrame:
    """``registry.summary`` of all reports that have arrived."""
    return registry.readable(_latest(spark, out))


def best_so_far(spark: SparkSession, out: str) -> DataFrame:
    """``registry.best_model`` of all reports that have arrived."""
    return registry.arg_max_auc(_latest(spark, out).select("model", "roc_auc").where("roc_auc > 0"))

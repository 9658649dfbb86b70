"""Scoring of a file stream with a fitted model; stateless, append mode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from cohortica.operators.scoring import score
from cohortica.workspace import fresh_path


def read_cases(spark: SparkSession, folder: str, schema, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def score_stream(cases: DataFrame, model, labels: Sequence[str], out: str, checkpoint: str,
                 defaults: dict | None = None, keep: Sequence[str] = ()):
    """Start scoring all files present and return the running query."""
    return (
        score(cases, model, labels, defaults, keep).writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def score_available(spark: SparkSession, folder: str, schema, model, labels, defaults=None, keep=()) -> DataFrame:
    """Score every file of a folder as a stream and read the result back."""
    out, checkpoint = fresh_path(spark, "scored"), fresh_path(spark, "scored-offsets")
    query = score_stream(read_cases(spark, folder, schema), model, labels, out, checkpoint, defaults, keep)
    query.awaitTermination()
    return spark.read.parquet(out)

"""Value buckets: equal values share a bucket and no bucket holds much more than its share.

Ordered work (running sums, neighbours) runs per bucket and is stitched together
from small per-bucket totals, so no window spans a whole table."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows that a bucket is meant to hold; the number of buckets follows from the rows.
BUCKET_ROWS = 250_000


def bucket_count(df: DataFrame) -> int:
    return max(2, -(-df.count() // BUCKET_ROWS))


def value_cuts(df: DataFrame, value: str, buckets: int | None = None) -> list[float]:
    """At most ``buckets - 1`` increasing cut points from a quantile sketch of all rows."""
    b = buckets or bucket_count(df)
    points = df.approxQuantile(value, [i / b for i in range(1, b)], 1.0 / (4 * b))
    return sorted(set(points))


def add_bucket(df: DataFrame, value: str, cuts: list[float], name: str = "bucket") -> DataFrame:
    if not cuts:
        return df.withColumn(name, F.lit(0))
    splits = [float("-inf"), *cuts, float("inf")]
    return (
        Bucketizer(splits=splits, inputCol=value, outputCol=name).transform(df)
        .withColumn(name, F.col(name).cast("int"))
    )

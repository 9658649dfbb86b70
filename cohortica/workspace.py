"""Shared-folder handling, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SMALL_SIDE_ROWS = 200_000


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: the session's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        sc = spark.sparkContext
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="cohortica-")
        sc.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/cohortica-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialise(df: DataFrame, name: str, deal_by: str | None = None, path: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Cuts lineage and survives lost executors; later readers still prune columns. With
    ``deal_by``, a key column, rows are first dealt evenly over partitions of adaptive
    number: for tables that many passes read. Whoever gives the ``path`` can ``remove`` it later."""
    spark = df.sparkSession
    path = path or fresh_path(spark, name)
    if deal_by:
        df = df.repartition(deal_by)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = SMALL_SIDE_ROWS) -> DataFrame:
    """A join side that is broadcast only after its row count was checked.

    Above ``max_rows`` the frame comes back unhinted and the join shuffles."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))

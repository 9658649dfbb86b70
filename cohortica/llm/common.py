"""Helpers shared by the operators: table access, written tables, key runs and components."""

from __future__ import annotations

import contextvars
import functools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortica.workspace import fresh_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(column, modulus: int, value: int):
    """True for rows whose crc32 of the id as text leaves ``value``."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % modulus == value, F.lit(False))


# Tables that the running operator has written; None outside of one.
_OWNED: contextvars.ContextVar = contextvars.ContextVar("owned", default=None)


class Written:
    """A table written once to the shared folder, if asked in a folder for each value of the columns ``by``; ``drop()``
    deletes it when its operator has no more use for it."""

    def __init__(self, df: DataFrame, name: str, by: tuple[str, ...] = ()):
        self.spark, self.path = df.sparkSession, fresh_path(df.sparkSession, name)
        if _OWNED.get() is not None:
            _OWNED.get().append(self)
        (df.write.partitionBy(*by) if by else df.write).parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        delete(self.spark, self.path)


def scoped(operator):
    """``operator`` with its result written, and nothing else that it wrote left behind, also when it fails.

    The result belongs to the operator that called it, if any, and goes with that one's tables."""

    @functools.wraps(operator)
    def run(*args, **options):
        own: list = []
        token = _OWNED.set(own)
        result = None
        try:
            found = operator(*args, **options)
            _OWNED.reset(token)
            token = None
            result = Written(found, operator.__name__)
            return result.df
        finally:
            if token is not None:
                _OWNED.reset(token)
            for table in own:
                table.drop()

    return run


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def read(written: Written) -> DataFrame:
    """The table once more, as a frame of its own: for both sides of a join or cogroup."""
    return written.spark.read.schema(written.df.schema).parquet(written.path)


class Recent:
    """Names met lately, in a table of fixed size: a name that is new may push out another, never the reverse."""

    def __init__(self, places: int = 1 << 18):
        self.held = ~np.arange(places)  # no name of a place looks like this

    def new(self, name: int) -> bool:
        """Whether a name is not in the table; it is then."""
        at = name & (len(self.held) - 1)
        if self.held[at] == name:
            return False
        self.held[at] = name
        return True

    def fresh(self, names: np.ndarray) -> np.ndarray:
        """Places of the names that are not in the table, each name once; they are then."""
        _, first = np.unique(names, return_index=True)
        first = np.sort(first)
        at = names[first] & (len(self.held) - 1)
        new = self.held[at] != names[first]
        self.held[at[new]] = names[first[new]]
        return first[new]


def slices(batches, rows: int = 512):
    """Arrow batches a few hundred rows at a time: what is made of a slice stays small beside the batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def runs(batches, keys: list[str]):
    """Whole runs of equal keys from rows sorted by ``keys``: frames of complete runs and where each begins.

    A run may span batches; it is held until its end, so callers bound the length of runs."""
    held = []
    for pdf in batches:
        if not len(pdf):
            continue
        if held:
            first, last = pdf.iloc[0], held[-1].iloc[-1]
            if all(first[k] == last[k] for k in keys) and all(pdf[k].iloc[-1] == first[k] for k in keys):
                held.append(pdf)
                continue
            pdf = pd.concat([*held, pdf], ignore_index=True)
            held = []
        change = np.zeros(len(pdf), bool)
        change[0] = True
        for k in keys:
            v = pdf[k].to_numpy()
            change[1:] |= v[1:] != v[:-1]
        starts = np.flatnonzero(change)
        if len(starts) > 1:
            yield pdf.iloc[: starts[-1]], starts[:-1]
        held = [pdf.iloc[starts[-1]:]]
    if held:
        yield pd.concat(held, ignore_index=True), np.array([0])


def components(edges: DataFrame, name: str = "component") -> Written:
    """(node, component) for every node of ``edges`` (a, b): the smallest node reachable. Nodes without edges are absent.

    Alternates large stars and small stars; each round is written to the shared folder and its
    predecessor deleted. Rounds grow with the logarithm of the longest path."""
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, state = Written(e, name), None
    while True:
        count, mark = now.df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if (count, mark) == state or count == 0:
            break
        state, e = (count, mark), now.df
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        stars = (
            large.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(small).distinct()
        )
        after = Written(stars, name)
        now.drop()
        now = after
    now.df = now.df.select(F.col("u").alias("node"), F.col("v").alias("component"))
    now.df = now.df.union(now.df.select(F.col("component").alias("node"), "component").distinct())
    return now

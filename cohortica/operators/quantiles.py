"""Exact quantiles from sketches of fixed size and one filtered pass.

A sketch per group and column, merged on executors, brackets each wanted rank; only values within the
brackets are counted and ranked. So a column of distinct values shuffles a small share of its rows,
and neither a group nor a list of cuts passes through the driver."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortica.functions.columns import as_double, ref
from cohortica.workspace import fresh_path, materialise, remove

# Ranks of a sketch are right to one part in so many.
ACCURACY = 1000


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int | None = None,
) -> DataFrame:
    """Rows (by..., column, prob, value), linearly interpolated, nulls and NaN left out.

    Reads ``df`` three times: for the sketches, for the rows below each bracket, and for the values within. Should a
    sketch miss its rank, the brackets are opened wide and the ranks taken from all values."""
    probs, cols = list(dict.fromkeys(map(float, probs))), list(cols)
    found = _ranked(df, cols, probs, by, accuracy or ACCURACY)
    if found.where("a IS NULL OR b IS NULL").limit(1).count():
        found = _ranked(df, cols, probs, by, None)
    listed, wanted = F.array(*map(F.lit, cols)), F.array(*map(F.lit, probs))
    value = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.col("a") * (1 - F.col("frac")) + F.col("b") * F.col("frac"))
    return found.select(
        *[F.col(f"k{i}").alias(k) for i, k in enumerate(by)], F.get(listed, F.col("c")).alias("column"),
        F.get(wanted, F.col("p")).alias("prob"), value.alias("value"))


def _ranked(df: DataFrame, cols: list[str], probs: list[float], by: Sequence[str], accuracy: int | None) -> DataFrame:
    """(k..., c, p, frac, a, b): the values at the lower and the upper rank of each probability, written."""
    keys, each = [f"k{i}" for i in range(len(by))], [(i, j) for i in range(len(cols)) for j in range(len(probs))]
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], ", ".join([*(f"{k} string" for k in keys), "c int, p int, frac double, a double, b double"]))
    values = [as_double(c) for c in cols]
    wide = df.select(*[ref(k).alias(n) for k, n in zip(by, keys)], *[F.when(~F.isnan(v), v).alias(f"v{i}") for i, v in enumerate(values)])
    # Three errors to either side hold the rank, once a few thousand rows outweigh its rounding.
    reach = 3.0 / accuracy if accuracy else 1.0
    ends = [max(0.0, p - reach) for p in probs] + [min(1.0, p + reach) for p in probs]
    sums = []
    for i in range(len(cols)):
        v = F.col(f"v{i}")
        sums += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
        if accuracy:
            sums.append(F.percentile_approx(v, F.array(*map(F.lit, ends)), accuracy).alias(f"q{i}"))
    sketched = wide.groupBy(*keys).agg(*sums)
    brackets = []
    for i, j in each:
        few = F.col(f"n{i}") < 4 * (accuracy or 0)
        for name, edge, at, outside in (("low", f"lo{i}", j, ends[j] <= 0), ("high", f"hi{i}", len(probs) + j, ends[len(probs) + j] >= 1)):
            value = F.col(edge) if outside or not accuracy else F.when(few, F.col(edge)).otherwise(F.get(f"q{i}", F.lit(at)))
            brackets.append(value.alias(f"{name}{i}_{j}"))
    path = fresh_path(spark, "quantile-brackets")
    bounds = materialise(sketched.select(*keys, *[f"n{i}" for i in range(len(cols))], *brackets), "quantile-brackets", path=path)
    if by:
        near = wide
        for k in keys:
            near = near.withColumnRenamed(k, f"own_{k}")
        same = [near[f"own_{k}"].eqNullSafe(bounds[k]) for k in keys]
        near = near.join(bounds, same)
    else:
        row = bounds.first()  # one row
        near = wide.select("*", *[F.lit(row[c]).cast(t).alias(c) for c, t in bounds.dtypes])
    below = near.groupBy(*keys).agg(*[F.count_if(F.col(f"v{i}") < F.col(f"low{i}_{j}")).alias(f"below{i}_{j}") for i, j in each])
    stacked = F.inline(F.array(*[F.struct(F.lit(i).alias("c"), F.lit(j).alias("p"), F.col(f"below{i}_{j}").alias("below")) for i, j in each]))
    sizes = F.inline(F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"n{i}").alias("n")) for i in range(len(cols))]))
    totals = _joined(below.select(*keys, stacked), bounds.select(*keys, sizes).where("n > 0"), [*keys, "c"])
    cells = F.filter(F.array(*[
        F.struct(F.lit(i).alias("c"), F.lit(j).alias("p"), F.col(f"v{i}").alias("value"), F.col(f"v{i}").between(F.col(f"low{i}_{j}"), F.col(f"high{i}_{j}")).alias("inside"))
        for i, j in each]), lambda x: x["inside"])
    # Rows without a value in a bracket go before cells are made.
    held = reduce(or_, [F.col(f"v{i}").between(F.col(f"low{i}_{j}"), F.col(f"high{i}_{j}")) for i, j in each])
    counts = near.where(held).select(*keys, F.inline(cells)).groupBy(*keys, "c", "p", "value").agg(F.count(F.lit(1)).alias("copies"))
    upto = Window.partitionBy(*keys, "c", "p").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    # A bracket without values keeps its row, so it is noticed.
    ranked = _joined(totals, counts.withColumn("run", F.sum("copies").over(upto)), [*keys, "c", "p"], "left")
    at = (F.col("n") - 1) * F.get(F.array(*map(F.lit, probs)), F.col("p"))
    last = F.col("below") + F.col("run")

    def taken(rank):
        return F.max(F.when((rank <= last) & (rank > last - F.col("copies")), F.col("value")))

    found = ranked.groupBy(*keys, "c", "p").agg(
        F.first(at - F.floor(at)).alias("frac"), taken(F.floor(at) + 1).alias("a"), taken(F.ceil(at) + 1).alias("b"))
    found = materialise(found, "quantiles")
    remove(spark, path)
    return found


def _joined(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of which nulls are equal."""
    for c in on:
        right = right.withColumnRenamed(c, f"r_{c}")
    same = left[on[0]].eqNullSafe(right[f"r_{on[0]}"])
    for c in on[1:]:
        same = same & left[c].eqNullSafe(right[f"r_{c}"])
    return left.join(right, same, how).drop(*[f"r_{c}" for c in on])


def wide_quantiles(df, cols, names: dict[str, float], by=()) -> DataFrame:
    """One row per (by..., column) with a named column for each probability."""
    keys = [*by, "column"]
    long = quantiles(df, cols, list(names.values()), by)
    return long.groupBy(*[ref(k) for k in keys]).agg(*[
        F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("value"))).alias(name)
        for name, p in names.items()
    ])


def medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    if not cols:
        return {}
    found = {r["column"]: r["value"] for r in quantiles(df, cols, [0.5]).collect()}
    return {c: found.get(c) for c in cols}

"""Column profiles: the numbers behind overview tables, bars, histograms, densities and boxes.

Every operator handles all requested columns in one pass over long rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortica.functions.columns import as_double, melt_numeric, melt_text, ref, split_columns
from cohortica.operators.importance import distinct_counts
from cohortica.operators.quantiles import wide_quantiles
from cohortica.workspace import materialise

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
GRID_POINTS = 200
# Terms of a kernel's series about the middle of a box, beyond the first: the rest is below 1e-12 of the kernel's height.
SERIES = 12


def overview(df: DataFrame, target: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.count_distinct(ref(target)).alias("n_classes"))


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, n, mean, std, min, p25, p50, p75, max) of numeric columns; std is the sample deviation."""
    cols = list(cols or split_columns(df)[0])
    v = F.col("value")
    basic = melt_numeric(df, cols).groupBy("column").agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"))
    return basic.join(wide_quantiles(df, cols, QUARTILES), "column").select(
        "column", "n", "mean", "std", "min", "p25", "p50", "p75", "max")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.where(ref(col).isNotNull()).groupBy(ref(col).alias("value")).agg(
        F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value")


def counts_by_class(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """(column, value, class, n) for all columns at once."""
    data = df.select(ref(target).alias("class"), *[ref(c) for c in cols if c != target])
    return melt_text(data, [c for c in cols if c != target], ["class"]).where("value is not null").groupBy(
        "column", "value", "class").agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, col: str, target: str, classes: Sequence) -> DataFrame:
    """Share of each class within each value; a column per class, 0 where absent."""
    n = F.count(F.lit(1))
    return df.where(ref(col).isNotNull() & ref(target).isNotNull()).groupBy(ref(col).alias("value")).agg(*[
        (F.count_if(ref(target) == F.lit(c)) / n).alias(str(c)) for c in classes])


def sorted_options(df: DataFrame, col: str) -> DataFrame:
    return df.where(ref(col).isNotNull()).select(ref(col).alias("value")).distinct().orderBy("value")


def drop_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(ref(col).isNotNull())


def _integral(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)}


def auto_bins(n: int, low: float, high: float, iqr: float, whole: bool) -> int:
    """Automatic bin count: the narrower of the Freedman-Diaconis and Sturges widths,
    the first kept from growing too fine; whole numbers get a width of at least one."""
    span = high - low
    if span == 0 or n == 0:
        return 1
    quartile_width = 2.0 * iqr * n ** (-1.0 / 3.0)
    width = min(max(quartile_width, span / math.sqrt(n) / 2), span / (math.log2(n) + 1.0))
    if whole and width < 1:
        width = 1
    return int(math.ceil(span / width))


def histogram(df: DataFrame, cols: Sequence[str] | None = None, bins: int | None = None) -> DataFrame:
    """(column, bin, low, high, n) with equal widths, empty bins included, top edge closed."""
    cols = list(cols or split_columns(df)[0])
    whole = _integral(df)
    limits = melt_numeric(df, cols).groupBy("column").agg(
        F.count("value").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    iqr = {}
    if bins is None:
        iqr = {r["column"]: r["p75"] - r["p25"] for r in wide_quantiles(df, cols, QUARTILES).collect()}
    plan = []
    for r in limits.collect():  # one row per column
        k = bins or auto_bins(r["n"], r["lo"], r["hi"], iqr[r["column"]], r["column"] in whole)
        lo, hi = (r["lo"], r["hi"]) if r["hi"] > r["lo"] else (r["lo"] - 0.5, r["hi"] + 0.5)
        plan.append((r["column"], float(lo), float(hi), k))
    frame = df.sparkSession.createDataFrame(plan, "column string, lo double, hi double, k int")

    def edge(i):
        at = F.col("lo") + i * ((F.col("hi") - F.col("lo")) / F.col("k"))
        return F.when(i == F.col("k"), F.col("hi")).otherwise(at)

    placed = melt_numeric(df, cols).join(F.broadcast(frame), "column")  # a row per column
    v, k = F.col("value"), F.col("k")
    raw = F.least(F.floor((v - F.col("lo")) / (F.col("hi") - F.col("lo")) * k).cast("int"), k - 1)
    placed = placed.withColumn("raw", raw)
    i = F.col("raw")
    # Rounding can put a value beside an edge into the wrong bin.
    index = F.when(v < edge(i), i - 1).when((v >= edge(i + 1)) & (i != k - 1), i + 1).otherwise(i)
    counts = placed.groupBy("column", index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = frame.withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    b = F.col("bin")
    return every.join(counts, ["column", "bin"], "left").select(
        "column", "bin", edge(b).alias("low"), edge(b + 1).alias("high"), F.coalesce("n", F.lit(0)).alias("n"))


def density(df: DataFrame, cols: Sequence[str] | None = None, points: int = GRID_POINTS) -> DataFrame:
    """(column, point, x, density): Gaussian kernel density between minimum and maximum.

    Bandwidth is the sample deviation times n^(-1/5). A fast Gauss transform: one aggregate takes the moments of the rows
    in boxes of half a bandwidth, and a Hermite series per box is evaluated on the grid. The boxes, not the rows, meet
    the points."""
    cols = list(cols or split_columns(df)[0])
    stats = melt_numeric(df, cols).groupBy("column").agg(
        F.count("value").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"),
        F.stddev_samp("value").alias("std")).where("std > 0").collect()
    if not stats:
        return df.sparkSession.createDataFrame([], "column string, point int, x double, density double")
    # A row per column.
    plan = df.sparkSession.createDataFrame(
        [(r["column"], r["n"], r["lo"], r["hi"], r["std"] * r["n"] ** -0.2) for r in stats], "column string, n long, lo double, hi double, h double")
    box = F.floor((F.col("value") - F.col("lo")) / (F.col("h") / 2))
    placed = melt_numeric(df, cols).join(F.broadcast(plan.select("column", "lo", "h")), "column").withColumn("box", box)
    placed = placed.withColumn("u", (F.col("value") - F.col("lo")) / F.col("h") - (F.col("box") + 0.5) / 2)
    powers = [F.lit(1.0)]
    for _ in range(SERIES):
        powers.append(powers[-1] * F.col("u"))
    moments = placed.groupBy("column", "box").agg(F.array(*[F.sum(p) for p in powers]).alias("moments"))

    def evaluate(batches):
        for pdf in batches:
            for column, own in pdf.groupby("column"):
                lo, hi, h = (float(own[c].iloc[0]) for c in ("lo", "hi", "h"))
                grid, total = np.linspace(lo, hi, points), np.zeros(points)
                for s in range(0, len(own), 1024):
                    part = own.iloc[s:s + 1024]
                    m = np.stack(part["moments"].to_numpy())
                    z = (grid[None, :] - lo) / h - ((part["box"].to_numpy() + 0.5) / 2)[:, None]
                    before, now, series, factorial = np.zeros_like(z), np.ones_like(z), np.zeros_like(z), 1.0
                    for j in range(SERIES + 1):  # exp(z u - u u / 2) is the sum of He_j(z) u^j / j!
                        series += m[:, j:j + 1] / factorial * now
                        before, now, factorial = now, z * now - j * before, factorial * (j + 1)
                    total += (series * np.exp(-0.5 * z * z)).sum(axis=0)
                yield pd.DataFrame({"column": column, "point": np.arange(points, dtype=np.int32), "x": grid, "s": total})

    sums = moments.join(F.broadcast(plan.select("column", "lo", "hi", "h")), "column").mapInPandas(evaluate, "column string, point int, x double, s double")
    total = sums.groupBy("column", "point").agg(F.first("x").alias("x"), F.sum("s").alias("s"))
    scale = plan.select("column", (F.col("n") * F.col("h") * math.sqrt(2 * math.pi)).alias("scale"))
    return total.join(F.broadcast(scale), "column").select("column", "point", "x", (F.col("s") / F.col("scale")).alias("density"))


def box_summary(df: DataFrame, cols: Sequence[str], by: str) -> DataFrame:
    """(class, column, n, p25, p50, p75, whisker_low, whisker_high, n_outliers)."""
    fenced = _fenced(df, cols, by)
    v = F.col("value")
    low, high = F.col("p25") - 1.5 * F.col("iqr"), F.col("p75") + 1.5 * F.col("iqr")
    return fenced.groupBy("class", "column", "p25", "p50", "p75").agg(
        F.count(F.lit(1)).alias("n"),
        F.least(F.min(F.when(v >= low, v)), F.col("p25")).alias("whisker_low"),
        F.greatest(F.max(F.when(v <= high, v)), F.col("p75")).alias("whisker_high"),
        F.count_if((v < low) | (v > high)).alias("n_outliers"))


def box_outliers(df: DataFrame, cols: Sequence[str], by: str) -> DataFrame:
    """Rows (class, column, value) beyond the whiskers' reach."""
    v = F.col("value")
    reach = 1.5 * F.col("iqr")
    return _fenced(df, cols, by).where((v < F.col("p25") - reach) | (v > F.col("p75") + reach)).select(
        "class", "column", "value")


def _fenced(df, cols, by) -> DataFrame:
    data = df.select(ref(by).alias("class"), *[ref(c) for c in cols]).where(F.col("class").isNotNull())
    # A row per class and column, written: Spark knows its size when it chooses the join.
    boxes = materialise(wide_quantiles(data, cols, QUARTILES, ["class"]).withColumn("iqr", F.col("p75") - F.col("p25")), "boxes")
    return melt_numeric(data, cols, ["class"]).join(boxes, ["class", "column"])


def feature_grid(df: DataFrame, features: Sequence[str], target: str, first: int = 9, few: int = 10) -> DataFrame:
    """Few-valued features as counts by class, the others as boxes: one table with a ``kind``."""
    shown = [f for f in features if f in df.columns][:first]
    distinct = {r["column"]: r["n_distinct"] for r in distinct_counts(df, shown).collect()}
    numeric = split_columns(df)[0]
    counted = [f for f in shown if distinct.get(f, 0) <= few or f not in numeric]
    boxed = [f for f in shown if f not in counted]
    parts = []
    if counted:
        parts.append(counts_by_class(df, counted, target).withColumn("kind", F.lit("count")))
    if boxed:
        parts.append(box_summary(df, boxed, target).withColumn("kind", F.lit("box")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def correlation(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(col_a, col_b, r) for the strict lower triangle, pairs with both values present; null where r is undefined.

    One pass at any width: tasks add up masked products of whole batches, Spark adds the tasks' sums. Values are
    shifted by a value of their column, so sums of squares keep their digits."""
    cols = list(cols or split_columns(df)[0])
    data = df.select(*[as_double(c).alias(f"v{i}") for i, c in enumerate(cols)])
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, r double")
    # A present value per column where the first rows have one.
    head = data.limit(100).toPandas().to_numpy(dtype=float)
    shift = np.array([next((v for v in head[:, i] if np.isfinite(v)), 0.0) for i in range(len(cols))])

    def add_up(batches):
        width = len(shift)
        sums = np.zeros((6, width, width))
        for b in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], axis=1).astype(float) - shift
            there = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x, nan=0.0, posinf=np.inf, neginf=-np.inf)
            square = x * x
            sums += np.stack([there.T @ there, x.T @ there, there.T @ x, square.T @ there, there.T @ square, x.T @ x])
        a, b = np.tril_indices(width, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int32()), pa.array(b, pa.int32()), *[pa.array(s[a, b]) for s in sums]], names=["a", "b", "n", "x", "y", "xx", "yy", "xy"])

    names = ("n", "x", "y", "xx", "yy", "xy")
    parts = data.mapInArrow(add_up, "a int, b int, " + ", ".join(f"{n} double" for n in names))
    total = parts.groupBy("a", "b").agg(*[F.sum(n).alias(n) for n in names])
    n, x, y, xx, yy, xy = (F.col(c) for c in names)
    spread = (xx - x * x / n) * (yy - y * y / n)
    r = F.when((n > 1) & (spread > 0), F.least(F.greatest((xy - x * y / n) / F.sqrt(spread), F.lit(-1.0)), F.lit(1.0)))
    listed = F.array(*[F.lit(c) for c in cols])
    return total.select(F.get(listed, F.col("a")).alias("col_a"), F.get(listed, F.col("b")).alias("col_b"), r.alias("r"))

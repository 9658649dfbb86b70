"""Labels, class weights, exact stratified splits and folds.

Row order is the md5 of seed and row id. The row at a wanted rank within a class is
found from counts by hash prefix plus a ranking of one prefix, so a split costs two
small aggregates and a filter; whole classes are never sorted."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortica.functions.columns import ref

PREFIX = 4


def class_labels(df: DataFrame, target: str) -> list:
    """Sorted distinct target values. Every model holds a score per class, so their list fits the driver."""
    rows = df.select(ref(target).alias("c")).where(F.col("c").isNotNull()).distinct().collect()
    return sorted(r["c"] for r in rows)


def label_code(col: Column, labels: Sequence) -> Column:
    """0..K-1 in sorted class order, null outside the list."""
    return F.nullif(F.array_position(F.array(*[F.lit(c) for c in labels]), col), F.lit(0)).cast("int") - 1


def encode(df: DataFrame, target: str, labels: Sequence, name: str = "label") -> DataFrame:
    return df.withColumn(name, label_code(ref(target), labels))


def decode(col: Column, labels: Sequence) -> Column:
    return F.get(F.array(*[F.lit(c) for c in labels]), col.cast("int"))


def class_counts(df: DataFrame, label: str = "label") -> dict[int, int]:
    return {r[label]: r["count"] for r in df.groupBy(ref(label)).count().collect()}


def balanced_weights(counts: dict[int, int]) -> dict[int, float]:
    n, k = sum(counts.values()), len(counts)
    return {c: n / (k * m) for c, m in sorted(counts.items())}


def weight_column(label: Column, weights: dict[int, float]) -> Column:
    out = F.when(F.lit(False), F.lit(0.0))
    for c, w in sorted(weights.items()):
        out = out.when(label == c, F.lit(float(w)))
    return out


def order_hash(seed, row_id: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string")))


def test_quota(counts: dict[int, int], test_size: float) -> dict[int, int]:
    """Rows of each class that go to the test side; unit remainders go to the largest fractions."""
    n = sum(counts.values())
    n_train = n - math.ceil(test_size * n)
    floors = {c: m * n_train // n for c, m in counts.items()}
    open_units = n_train - sum(floors.values())
    by_fraction = sorted(counts, key=lambda c: (-(counts[c] * n_train % n), c))
    train = {c: floors[c] + (1 if i < open_units else 0) for i, c in enumerate(by_fraction)}
    return {c: counts[c] - train[c] for c in counts}


def fold_sizes(counts: dict[int, int], order: Sequence[int], k: int) -> dict[int, list[int]]:
    """Rows of each class per fold: lay the classes end to end and deal positions out in turn."""
    sizes, start = {}, 0
    for c in order:
        sizes[c] = [len(range(start + (i - start) % k, start + counts[c], k)) for i in range(k)]
        start += counts[c]
    return sizes


def _row_at(df: DataFrame, label: str, wanted: list[tuple[int, int]]) -> dict[tuple[int, int], tuple]:
    """(hash, id) of the row at each 1-based (class, rank); ``df`` has label, h, id."""
    wanted = [w for w in wanted if w[1] > 0]
    if not wanted:
        return {}
    spark = df.sparkSession
    targets = F.broadcast(spark.createDataFrame(wanted, f"t_label int, rank bigint"))
    prefix = F.substring("h", 1, PREFIX)
    counts = df.groupBy(ref(label).alias("label"), prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.partitionBy("label").orderBy("prefix"))
    hit = (F.col("label") == F.col("t_label")) & (F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("c"))
    found = counts.withColumn("upto", upto).join(targets, hit).select(
        "label", "prefix", "rank", (F.col("rank") - (F.col("upto") - F.col("c"))).alias("need")).collect()
    near = F.broadcast(spark.createDataFrame(found, "t_label int, t_prefix string, rank bigint, need bigint"))
    inside = df.select(ref(label).alias("label"), "h", "id").join(
        near, (F.col("label") == F.col("t_label")) & (prefix == F.col("t_prefix")))
    turn = F.row_number().over(Window.partitionBy("label", "rank").orderBy("h", "id"))
    rows = inside.withColumn("turn", turn).where(F.col("turn") == F.col("need")).collect()
    return {(r["label"], r["rank"]): (r["h"], r["id"]) for r in rows}


def _upto(h: Column, row_id: Column, cut: tuple) -> Column:
    return (h < cut[0]) | ((h == cut[0]) & (row_id <= F.lit(cut[1])))


def stratified_split(df: DataFrame, label: str, row_id: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test``. Sizes are exact; the first rows in hash order of each class train."""
    h = order_hash(seed, ref(row_id))
    counts = class_counts(df, label)
    if min(counts.values()) < 2:
        raise ValueError("every class needs at least two rows to be split")
    quota = test_quota(counts, test_size)
    train = {c: counts[c] - quota[c] for c in counts}
    rows = df.select(ref(label).alias(label), h.alias("h"), ref(row_id).alias("id"))
    cuts = _row_at(rows, label, [(c, n) for c, n in train.items() if n < counts[c]])
    in_train = F.lit(None).cast("boolean")
    for c, n in train.items():
        part = F.lit(True) if n == counts[c] else F.lit(False) if n == 0 else _upto(h, ref(row_id), cuts[(c, n)])
        in_train = F.when(ref(label) == c, part).otherwise(in_train)
    return df.withColumn("is_test", ~in_train)


def stratified_folds(df: DataFrame, label: str, row_id: str, k: int = 3, seed: int = 42) -> DataFrame:
    """Add ``fold`` 0..k-1; within a class folds are consecutive runs in hash order."""
    h = order_hash(seed, ref(row_id))
    first = df.groupBy(ref(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(h.alias("h"), ref(row_id).alias("id"))).alias("first")).collect()
    counts = {r["label"]: r["n"] for r in first}
    if min(counts.values()) < k:
        raise ValueError(f"every class needs at least {k} rows for {k} folds")
    order = [r["label"] for r in sorted(first, key=lambda r: (r["first"]["h"], r["first"]["id"]))]
    sizes = fold_sizes(counts, order, k)
    ends = {c: [sum(s[:i + 1]) for i in range(k - 1)] for c, s in sizes.items()}
    rows = df.select(ref(label).alias(label), h.alias("h"), ref(row_id).alias("id"))
    cuts = _row_at(rows, label, sorted({(c, e) for c, es in ends.items() for e in es}))
    fold = F.lit(None).cast("int")
    for c, es in ends.items():
        part = F.lit(k - 1)
        for i in reversed(range(k - 1)):
            if es[i] > 0:
                part = F.when(_upto(h, ref(row_id), cuts[(c, es[i])]), i).otherwise(part)
        fold = F.when(ref(label) == c, part).otherwise(fold)
    return df.withColumn("fold", fold)


def row_ids(df: DataFrame, name: str = "row_id", chunk: int = 10_000) -> DataFrame:
    """Stable ids for a table without a key: md5 of the row and a number among its copies.

    The table is rebuilt from its distinct rows and their counts. Copies are combined
    before the shuffle, and rows with many copies are dealt out in chunks, so neither a
    layout nor a hot row changes the ids or fills one task."""
    cells = [F.coalesce(ref(c).cast("string"), F.lit("\x00")) for c in df.columns]
    keys = [ref(c) for c in df.columns]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    counted = counted.withColumn("_h", F.md5(F.concat_ws("\x01", *cells)))
    few = counted.where(F.col("_n") <= chunk).withColumn("_from", F.lit(1).cast("bigint"))
    many = (
        counted.where(F.col("_n") > chunk)
        .withColumn("_from", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"), F.lit(chunk).cast("bigint"))))
        .repartition("_h", "_from")
    )
    last = F.least(F.col("_n"), F.col("_from") + (chunk - 1))
    dealt = few.unionByName(many).withColumn("_i", F.explode(F.sequence(F.col("_from"), last)))
    return dealt.select(*keys, F.concat_ws("-", "_h", F.col("_i").cast("string")).alias(name))

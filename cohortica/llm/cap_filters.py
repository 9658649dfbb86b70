"""Near duplicates among vectors by spherical-cap filters."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.llm.common import Written, components, runs, scoped

# Rows of a bucket that meet in one block; a task holds two blocks at a time.
BLOCK_ROWS = 1024
# Codewords of a block of a product code.
MOST_WORDS = 2048


def cap_share(dims: int, alpha: float) -> float:
    """Share of the unit sphere within the cap <x, c> >= alpha."""
    x = np.linspace(-1, 1, 200_001)
    y = np.maximum(0, 1 - x * x) ** ((dims - 3) / 2) if dims > 2 else 1 / np.sqrt(np.maximum(1e-9, 1 - x * x))
    return float(y[x >= alpha].sum() / y.sum())


class Filters:
    """Random product codes: each repetition rotates the space, cuts it into blocks and takes as filter directions
    all concatenations of one codeword per block.

    ``words`` codewords a block give ``words ** blocks`` directions a repetition: two blocks, or more once ``MOST_WORDS``
    codewords do not keep ``bucket`` random vectors to a direction. ``alpha`` is chosen so that a random vector exceeds
    ``hits`` of them on average; directions of more blocks depend on one another more, so each further block takes four
    times the hits for the same recall."""

    def __init__(self, dims: int, n_vectors: int, repeats: int = 8, hits: float = 6.0, bucket: float = 16.0, seed: int = 7):
        rng = np.random.RandomState(seed)
        share = min(0.25, bucket / max(n_vectors, 1))
        self.dims, self.blocks = dims, min(2, dims)
        while (hits / share) ** (1 / self.blocks) > MOST_WORDS and self.blocks < dims:
            self.blocks, hits = self.blocks + 1, 4 * hits
        self.words = int(np.clip(np.ceil((hits / share) ** (1 / self.blocks)), 4, MOST_WORDS))
        low, high = 0.0, 1.0
        for _ in range(40):
            alpha = (low + high) / 2
            low, high = (alpha, high) if cap_share(dims, alpha) * self.words ** self.blocks > hits else (low, alpha)
        self.alpha = low
        cuts = np.linspace(0, dims, self.blocks + 1).astype(int)
        self.parts = list(zip(cuts[:-1], cuts[1:]))
        self.codes = []
        for _ in range(repeats):
            rotation = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
            books = []
            for a, b in self.parts:
                c = rng.normal(size=(self.words, b - a))
                books.append(c / np.linalg.norm(c, axis=1, keepdims=True) / np.sqrt(self.blocks))
            self.codes.append((rotation, books))

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of every direction that a row of ``unit`` exceeds. Partial sums that the best
        codewords of the later blocks cannot lift over ``alpha`` are dropped block by block."""
        rows, filters = [], []
        for k, (rotation, books) in enumerate(self.codes):
            turned = unit @ rotation
            scores = [turned[:, a:b] @ book.T for (a, b), book in zip(self.parts, books)]
            rest = np.zeros((len(unit), self.blocks + 1))
            for j in range(self.blocks - 1, -1, -1):
                rest[:, j] = rest[:, j + 1] + scores[j].max(axis=1)
            row, sums, code = np.arange(len(unit)), np.zeros(len(unit)), np.zeros(len(unit), np.int64)
            for j in range(self.blocks):
                total = sums[:, None] + scores[j][row]
                at, word = np.nonzero(total + rest[row, j + 1][:, None] >= self.alpha)
                row, sums, code = row[at], total[at, word], code[at] * self.words + word
            rows.append(row)
            filters.append(code + k * self.words ** self.blocks)
        return np.concatenate(rows), np.concatenate(filters)


def unit_rows(vectors) -> np.ndarray:
    """Rows as unit vectors in double precision; scaled first, so that squares neither overflow nor vanish."""
    v = np.stack(vectors).astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def usable(column):
    """Not null, not empty, every component finite, one at least not zero."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(column) > 0) & ~bad & F.exists(column, lambda x: x != 0), F.lit(False))


@scoped
def link_vectors(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    threshold: float = 0.98, repeats: int = 8, hits: float = 6.0, bucket: float = 16.0,
) -> DataFrame:
    """Links of cosine >= ``threshold`` between vectors of one label, and their components.

    One row per input row: id, n_links, component_id, kept. Equal vectors of a label count as one until the end.
    Each is decoded to all filter directions it exceeds and meets the others of a filter there; large buckets meet
    block by block, and a pair counts in the smallest filter that both exceed. Cosines are exact, so no reported link
    is below the threshold; ``repeats`` and ``hits`` set the share of links that is found.

    Vectors that are null, empty, zero or hold null or non-finite components, rows without a label or without an id
    link with nothing: no links, component_id is the id. Vectors of unlike length never meet. Repeated rows are
    vectors of their own. An empty table gives no rows."""
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("v"), F.col(f"`{label_col}`").alias("label"))
    rows = rows.withColumn("ok", usable(F.col("v")) & F.col("label").isNotNull() & F.col("id").isNotNull())
    rows = rows.withColumn("h1", F.xxhash64(F.lit(1), "v")).withColumn("h2", F.xxhash64(F.lit(2), "v"))
    classes = Written(
        rows.where("ok").groupBy("label", "h1", "h2")
        .agg(F.first("v").alias("v"), F.min("id").alias("low"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()).withColumn("dims", F.size("v")),
        "cap-classes",
    )
    links, edges = [], []
    for dims, n in classes.df.groupBy("dims").count().collect():  # a row per vector length
        found = Written(_meet(classes.df.where(F.col("dims") == dims), Filters(dims, n, repeats, hits, bucket), threshold), "cap-links")
        links.append(found.df)
        edges.append(found.df.select(F.col("node").alias("a"), F.col("root").alias("b")))
    out = rows.select("id", "label", "h1", "h2", "ok")
    if not links:
        return _named(out.withColumn("n_links", F.lit(0).cast("long")).withColumn("component_id", F.col("id")), id_col)
    every, pairs = links[0], edges[0]
    for a, b in zip(links[1:], edges[1:]):
        every, pairs = every.union(a), pairs.union(b)
    counts = every.groupBy("node").agg(F.sum("n").alias("n"))
    comp = components(pairs, "cap-components").df
    lows = comp.join(classes.df.select("node", "low"), "node")
    lows = lows.join(lows.groupBy("component").agg(F.min("low").alias("least")), "component").select("node", "least")
    known = (
        classes.df.select("node", "label", "h1", "h2", "low", "copies").join(counts, "node", "left").join(lows, "node", "left")
        .select("label", "h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("least", "low").alias("component_id"), F.lit(True).alias("ok"))
    )
    out = out.join(known, ["label", "h1", "h2", "ok"], "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return _named(out, id_col)


def _named(df: DataFrame, id_col: str) -> DataFrame:
    return df.select(
        F.col("id").alias(id_col), "n_links", F.col("component_id").cast("long").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _meet(classes: DataFrame, filters: Filters, threshold: float) -> DataFrame:
    """(node, n, root): per bucket block the copies that a node links with, and a node it is connected to."""

    def decode(batches):
        for pdf in batches:
            if len(pdf):
                for a in range(0, len(pdf), 2048):
                    part = pdf.iloc[a:a + 2048]
                    row, code = filters.decode(unit_rows(part["v"].to_numpy()))
                    yield part.iloc[row].assign(filter=code)

    def decode_narrow(batches):
        for pdf in decode(batches):
            yield pdf[["label", "filter"]]

    narrow = classes.select("label", "node", "copies", "v")
    wide = narrow.withColumn("filter", F.lit(0).cast("long"))
    hits = narrow.mapInPandas(decode, wide.schema)
    # Only buckets over a block are listed; the table is written, so Spark knows its size when it plans the join.
    large = Written(
        narrow.mapInPandas(decode_narrow, wide.select("label", "filter").schema).groupBy("label", "filter")
        .agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("parts")).where("parts > 1"),
        "cap-large",
    ).df
    dealt = (
        hits.join(large, ["label", "filter"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("label", "filter", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", "copies", "v")
    )
    keys = ["label", "filter", "i", "j"]

    def verify(batches):
        for pdf, starts in runs(batches, keys):
            unit, node = unit_rows(pdf["v"].to_numpy()), pdf["node"].to_numpy()
            copies, part = pdf["copies"].to_numpy(), pdf["part"].to_numpy()
            code, i, j = (pdf[k].to_numpy() for k in ("filter", "i", "j"))
            out = []
            for a, b in zip(starts, [*starts[1:], len(pdf)]):
                if b - a < 2:
                    continue
                linked = unit[a:b] @ unit[a:b].T >= threshold
                if i[a] != j[a]:
                    linked &= part[a:b, None] != part[None, a:b]
                np.fill_diagonal(linked, False)
                at = np.flatnonzero(linked.any(axis=1))
                if not len(at):
                    continue
                linked, here = linked[np.ix_(at, at)], at + a
                out.append(pd.DataFrame({
                    "node": node[here], "root": _roots(linked, node[here]),
                    "n": (linked & ~_met(filters, unit[here], code[a])) @ copies[here],
                }))
            if out:
                yield pd.concat(out)

    met = dealt.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(verify, "node long, root long, n long")
    # A node meets its links in several filters; one row per (node, root) stays.
    return met.groupBy("node", "root").agg(F.sum("n").alias("n"))


def _roots(linked: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Smallest node reachable within the block."""
    label, big = node.copy(), np.iinfo(np.int64).max
    while True:
        after = np.minimum(label, np.where(linked, label[None, :], big).min(axis=1))
        if (after == label).all():
            return label
        label = after


def _met(filters: Filters, unit: np.ndarray, code: int) -> np.ndarray:
    """Which pairs share a filter below ``code``, and so were counted there."""
    row, found = filters.decode(unit)
    below = found < code
    row, found = row[below], found[below]
    if not len(row):
        return np.zeros((len(unit), len(unit)), bool)
    ids, column = np.unique(found, return_inverse=True)
    exceeds = np.zeros((len(unit), len(ids)), np.float32)
    exceeds[row, column] = 1
    return exceeds @ exceeds.T > 0

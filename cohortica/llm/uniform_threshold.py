"""Exact top-k search by inner product in three phases with a uniform threshold (Cao & Wang 2004)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortica.llm.common import Written, read, scoped

# Rows of a block and queries of a chunk that one task holds together, packed; scores are held for a slice of queries.
BLOCK_ROWS, CHUNK_ROWS, SLICE = 8192, 8192, 128
LONG = (-(1 << 63), (1 << 63) - 1)


def scaled(vectors, factor: float) -> np.ndarray:
    """floor(factor * x) of stacked vectors, as whole doubles; what passes the doubles is cut to the largest."""
    v = np.stack([np.asarray(x, np.float64) for x in vectors])
    big = np.finfo(np.float64).max
    with np.errstate(over="ignore"):
        return np.floor(np.clip(factor * v, -big, big))


def packed(values: np.ndarray) -> tuple[str, bytes]:
    """Whole numbers in the smallest type that holds them."""
    most = np.abs(values).max(initial=0)
    kind = next((k for k, top in (("<i1", 127), ("<i2", 32767), ("<i4", 2 ** 31 - 1)) if most <= top), "<f8")
    return kind, values.astype(kind).tobytes()


def unpacked(row, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and values of a packed block or chunk."""
    ids = np.frombuffer(row["ids"], "<i8")
    return ids, np.frombuffer(row["vals"], row["kind"]).reshape(len(ids), dims)


def exact_type(q: np.ndarray, x: np.ndarray):
    """A type in which all inner products and their parts are exact; None where only Python's integers are."""
    most = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(x.astype(np.float64)).max(initial=0)) * max(1, q.shape[1])
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else None


def own_pairs(asked: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) places of equal ids."""
    order = np.argsort(ids, kind="stable")
    a, b = (np.searchsorted(ids[order], asked, side=s) for s in ("left", "right"))
    q = np.repeat(np.arange(len(asked)), b - a)
    return q, order[np.concatenate([np.arange(s, e) for s, e in zip(a, b)]).astype(int)] if len(q) else q


class Lists:
    """The score lists of a block for a slice of queries: one list per block of columns, whose sum is the score."""

    def __init__(self, q: np.ndarray, x: np.ndarray, asked: np.ndarray, ids: np.ndarray, lists: int, kind):
        cuts = np.unique(np.linspace(0, q.shape[1], lists + 1).astype(int))
        self.parts = [q[:, a:b].astype(kind) @ x[:, a:b].astype(kind).T for a, b in zip(cuts[:-1], cuts[1:])] or [np.zeros((len(q), len(x)))]
        rows, cols = own_pairs(asked, ids)
        for p in self.parts:
            p[rows, cols] = -np.inf

    def at(self, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        """Whole scores of some entries."""
        return sum(p[rows, cols].astype(np.float64) for p in self.parts)


def first_lists(q, x, asked, ids, k: int, lists: int):
    """Per query of a slice: ids and scores of its best entries among the heads of all lists, and the highest score that a
    list may still hold beyond its head (None: the heads are all there is)."""
    kind = exact_type(q, x)
    if kind is None:
        totals = [[int(v) for v in row] for row in q.astype(np.float64).astype(object)]
        columns = [[int(v) for v in row] for row in x.astype(np.float64).astype(object)]
        for own, name in zip(totals, asked):
            scores = sorted((-sum(a * b for a, b in zip(own, c)), int(i)) for c, i in zip(columns, ids) if i != name)[:k]
            yield [i for _, i in scores], [min(max(-s, LONG[0]), LONG[1]) for s, _ in scores], None
        return
    held = Lists(q, x, asked, ids, lists, kind)
    rest = None
    if len(ids) > k:
        heads, lows = [], []
        for p in held.parts:
            top = np.argpartition(p, len(ids) - k, axis=1)[:, len(ids) - k:]
            heads.append(top)
            lows.append(np.take_along_axis(p, top, axis=1).min(axis=1))
        cand, rest = np.sort(np.concatenate(heads, axis=1), axis=1), np.max(lows, axis=0)
    else:
        cand = np.tile(np.arange(len(ids)), (len(q), 1))
    total = held.at(np.repeat(np.arange(len(q)), cand.shape[1]), cand.ravel()).reshape(cand.shape)
    total[:, 1:][cand[:, 1:] == cand[:, :-1]] = -np.inf
    names = ids[cand]
    order = np.lexsort((names, -total), axis=1)[:, :k]
    names, total = np.take_along_axis(names, order, axis=1), np.take_along_axis(total, order, axis=1)
    for n, (i, s) in enumerate(zip(names, total)):
        live = np.isfinite(s)
        low = None if rest is None or not np.isfinite(rest[n]) else int(rest[n])
        yield i[live].tolist(), s[live].astype(np.int64).tolist(), low


def sufficient(q, x, asked, ids, cutoff: np.ndarray, k: int, lists: int):
    """Per query of a slice: the best entries at or above its cutoff.

    An entry below ``cutoff / lists`` in every list has a score below the cutoff; all others are collected and
    their scores resolved."""
    held = Lists(q, x, asked, ids, lists, exact_type(q, x))
    share = (cutoff / len(held.parts))[:, None]
    live = np.logical_or.reduce([p >= share for p in held.parts])
    rows, cols = np.nonzero(live)
    score = held.at(rows, cols)
    keep = score >= cutoff[rows]
    rows, names, score = rows[keep], ids[cols[keep]], score[keep]
    order = np.lexsort((names, -score, rows))
    rows, names, score = rows[order], names[order], score[order].astype(np.int64)
    starts = np.searchsorted(rows, np.arange(len(q) + 1))
    for a, b in zip(starts[:-1], starts[1:]):
        yield names[a:min(b, a + k)].tolist(), score[a:min(b, a + k)].tolist()


@scoped
def top(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", query_modulus: int = 20, k: int = 20,
    factor: float = 64.0, lists: int = 2,
) -> DataFrame:
    """The ``k`` rows of largest integer inner product for each row whose id is divisible by ``query_modulus``, exactly.

    Columns query_id, rank, vec_id, score (long), ties to the smaller id; vectors count as floor(``factor`` * x). Rows
    are packed in blocks. Each block holds ``lists`` score lists of a query, one per block of columns.
    First the heads of all lists are gathered, with their scores: the k-th best of a query is its cutoff, below which no
    answer lies. The cutoff goes back to those blocks whose lists reach ``cutoff / lists`` beyond their heads; they
    collect all entries that do, resolve their scores and return the best ``k``. So what is exchanged after the first
    phase follows the answers, not the rows, and no group grows with copies: a block has a fixed number of rows.

    Rows without an id and vectors that are null or hold null or non-finite components take no part; zero vectors do.
    Vectors of unlike length never meet. A query never meets rows of its own id; other repeated rows are candidates of
    their own. Rows that repeat a query's id ask once, with the vector of the smallest hash (ties: the smaller vector).
    Scores beyond a long are cut to its range. An empty table gives no rows."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(False)))

    def pack(number: str):
        def one(own: pd.DataFrame) -> pd.DataFrame:
            own, dims = own.sort_values("id"), int(own["dims"].iloc[0])
            kind, vals = packed(scaled(own["v"], factor)) if dims else ("<i1", b"")
            return pd.DataFrame({"dims": [dims], number: own[number].iloc[:1], "ids": [own["id"].to_numpy("<i8").tobytes()], "kind": [kind], "vals": [vals]})

        return one

    asked = rows.where(F.col("id") % query_modulus == 0).groupBy("id").agg(F.min(F.struct(F.xxhash64("v").alias("h"), "v")).alias("q"))
    asked = asked.select("id", F.col("q.v").alias("v"), F.size("q.v").alias("dims"))
    n, n_asked = rows.agg(F.count("*"), F.count_if(F.col("id") % query_modulus == 0)).first()
    n_blocks, n_chunks = max(1, -(-n // BLOCK_ROWS)), max(1, -(-n_asked // CHUNK_ROWS))
    # Rows are dealt by their number, so copies spread like any others.
    dealt = rows.withColumn("dims", F.size("v")).withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_blocks)).cast("int"))
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(n_chunks)).cast("int"))
    body = "ids binary, kind string, vals binary"
    queries = Written(asked.groupBy("dims", "chunk").applyInPandas(pack("chunk"), f"dims int, chunk int, {body}"), "top-queries")
    blocks = Written(dealt.groupBy("dims", "block").applyInPandas(pack("block"), f"dims int, block int, {body}"), "top-blocks")
    each_chunk, each_block = (F.explode(F.sequence(F.lit(0), F.lit(m - 1))) for m in (n_chunks, n_blocks))
    x, q = blocks.df.withColumn("chunk", each_chunk), queries.df.withColumn("block", each_block)
    keys = ["dims", "block", "chunk"]

    def heads(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(x) and len(q):
            dims, block, chunk = (int(x[c].iloc[0]) for c in keys)
            (ids, vx), (names, vq) = unpacked(x.iloc[0], dims), unpacked(q.iloc[0], dims)
            for s in range(0, len(names), SLICE):
                found = first_lists(vq[s:s + SLICE], vx, names[s:s + SLICE], ids, k, lists)
                out += [(dims, block, chunk, s + n, int(names[s + n]), *f) for n, f in enumerate(found)]
        return pd.DataFrame(out, columns=[*keys, "place", "id", "ids", "scores", "low"]).astype({"low": "Int64"})

    first = Written(
        x.groupBy(*keys).cogroup(q.groupBy(*keys))
        .applyInPandas(heads, "dims int, block int, chunk int, place int, id long, ids array<long>, scores array<long>, low long"), "top-heads")

    best = Window.partitionBy("id").orderBy(F.desc("score"), "vec_id")
    entry = F.explode(F.arrays_zip(F.col("ids").alias("vec_id"), F.col("scores").alias("score"))).alias("e")
    flat = lambda f: f.select("id", entry).select("id", "e.vec_id", "e.score").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    cutoffs = flat(first.df).groupBy("id").agg(F.min("score").alias("cutoff"), F.count("*").alias("n")).where(F.col("n") == k).select("id", "cutoff")
    # A list whose head ends below its share of the cutoff has nothing more to give.
    open_lists = first.df.select(*keys, "place", "id", "low").join(cutoffs, "id")
    open_lists = open_lists.where(F.col("low") * F.least(F.greatest("dims", F.lit(1)), F.lit(lists)) >= F.col("cutoff"))
    visits = Written(open_lists.groupBy(*keys).agg(F.collect_list(F.struct("place", "cutoff")).alias("visit")), "top-visits")  # a chunk of queries at most

    def collect(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(x) and len(q):
            dims, block, chunk = (int(x[c].iloc[0]) for c in keys)
            (ids, vx), (names, vq) = unpacked(x.iloc[0], dims), unpacked(q.iloc[0], dims)
            visit = sorted((v["place"], v["cutoff"]) for v in q["visit"].iloc[0])
            place, cutoff = np.array([p for p, _ in visit]), np.array([c for _, c in visit], np.float64)
            for s in range(0, len(place), SLICE):
                at = place[s:s + SLICE]
                found = sufficient(vq[at], vx, names[at], ids, cutoff[s:s + SLICE], k, lists)
                out += [(dims, block, chunk, int(names[p]), *f) for p, f in zip(at, found)]
        return pd.DataFrame(out, columns=[*keys, "id", "ids", "scores"])

    x = x.join(read(visits).select(*keys), keys, "left_semi")
    q = q.join(read(visits), keys)
    second = x.groupBy(*keys).cogroup(q.groupBy(*keys)).applyInPandas(collect, "dims int, block int, chunk int, id long, ids array<long>, scores array<long>")
    # Where a block was visited, what it returned stands for its heads.
    visited = visits.df.select(*keys, F.explode("visit.place").alias("place"))
    settled = first.df.join(visited, [*keys, "place"], "left_anti")
    found = flat(settled.select("id", "ids", "scores").union(second.select("id", "ids", "scores")))
    return found.select(F.col("id").alias("query_id"), "rank", "vec_id", "score")

"""Nearest neighbours by an adaptive dimension scan over inverted lists."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortica.llm.cap_filters import usable
from cohortica.llm.common import Written, read, scoped

# Rows of a list and queries that one task holds together, packed; larger lists are cut into such blocks.
BLOCK_ROWS = 4096
QUERY_ROWS = 1024


class Index:
    """Centroids and rotation. The squared distance in the lifted space (one more component, so that all rows have
    the norm ``radius``) falls as the inner product rises, so nearest by distance is largest by product."""

    def __init__(self, sample: np.ndarray, radius: float, n_lists: int, seed: int = 11, rounds: int = 8):
        rng = np.random.RandomState(seed)
        self.radius, self.dims = radius, sample.shape[1] + 1
        self.rotation = np.linalg.qr(rng.normal(size=(self.dims, self.dims)))[0]
        lifted = self.lift(sample)
        centres = lifted[rng.permutation(len(lifted))[:n_lists]].copy()
        for _ in range(rounds):
            near = self._near(lifted, centres, 1)[:, 0]
            for c in range(len(centres)):
                own = lifted[near == c]
                if len(own):
                    centres[c] = own.mean(axis=0)
        self.centres = centres

    def lift(self, v: np.ndarray) -> np.ndarray:
        last = np.sqrt(np.maximum(0.0, self.radius ** 2 - (v * v).sum(axis=1)))
        return np.hstack([v, last[:, None]]) @ self.rotation

    def lift_query(self, q: np.ndarray) -> np.ndarray:
        return np.hstack([q, np.zeros((len(q), 1))]) @ self.rotation

    @staticmethod
    def away(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
        """Squared distances."""
        return (points * points).sum(axis=1)[:, None] + (centres * centres).sum(axis=1)[None, :] - 2 * points @ centres.T

    def _near(self, points: np.ndarray, centres: np.ndarray, k: int) -> np.ndarray:
        return np.argsort(self.away(points, centres), axis=1, kind="stable")[:, :k]

    def lists(self, points: np.ndarray, k: int) -> np.ndarray:
        return self._near(points, self.centres, min(k, len(self.centres)))


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed from the first component on, so equal vectors get equal scores."""
    total = np.zeros(len(q))
    for k in range(q.shape[1]):
        total += q[:, k] * x[:, k]
    return total


def scan(index: Index, q: np.ndarray, x: np.ndarray, bound: np.ndarray, step: int, epsilon: float):
    """(query, row) pairs that no test abandoned.

    After each block of ``step`` rotated columns the distance so far, scaled to all columns, is tested against the
    query's ``bound`` (squared): beyond ``(1 + epsilon / sqrt(columns so far))`` times it the pair goes."""
    lq, lx = index.lift_query(q), index.lift(x)
    dims = index.dims
    a, b = lq[:, :step], lx[:, :step]
    part = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T
    qi, xi = np.nonzero(part * dims / min(step, dims) <= (bound * (1 + epsilon / np.sqrt(min(step, dims))) ** 2)[:, None])
    part = part[qi, xi]
    for k in range(step, dims, step):
        if not len(qi):
            break
        for s in range(0, len(qi), 200_000):  # bounded scratch
            t = slice(s, s + 200_000)
            part[t] += ((lq[qi[t], k:k + step] - lx[xi[t], k:k + step]) ** 2).sum(axis=1)
        seen = min(k + step, dims)
        slack = (1 + epsilon / np.sqrt(seen)) ** 2 if seen < dims else 1 + 1e-9
        live = part * dims / seen <= bound[qi] * slack
        qi, xi, part = qi[live], xi[live], part[live]
    return qi, xi


@scoped
def nearest(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", query_modulus: int = 20, k: int = 20,
    probe: float = 0.85, max_lists: int = 4096, sample_rows: int = 16_384, step: int = 16, epsilon: float = 2.1,
) -> DataFrame:
    """The ``k`` rows of largest inner product for each row whose id is divisible by ``query_modulus``.

    Columns query_id, rank, vec_id, score (double, on the original vectors), ties to the smaller id. Centroids come
    from a sample of at most ``sample_rows`` rows (smallest hashes of the id); every row is in one list. A query scans
    its nearest list first, then the rest of the nearest ``probe`` share of lists under the bound found there, but for
    lists that lie beyond it as a whole. Lists and queries are packed in blocks and chunks of a fixed size; every block
    meets every chunk once and tells there which of its queries probe it, so no route carries a vector.

    Rows without an id and vectors that are null, empty, zero or hold null or non-finite components take no part, nor
    do vectors whose length is not that of most rows (ties: the shorter). A query never meets rows of its own id;
    other repeated rows are candidates of their own. Rows that repeat a query's id ask once, with the vector of the
    smallest hash (ties: the smaller vector). An empty table gives no rows."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    kinds = rows.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n"), F.max(norm).alias("radius")).orderBy(F.desc("n"), "dims").limit(1).collect()
    if not kinds:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims, n, radius = kinds[0]
    rows = rows.where(F.size("v") == dims)
    sample = rows.orderBy(F.xxhash64("id"), "v").limit(sample_rows).select("v").toPandas()["v"]
    # Few rows make one list, so a query with fewer than k candidates finds them all.
    index = Index(np.stack(sample.to_numpy()), radius, int(min(max_lists, max(1, min(round(n ** 0.5), n // k)))))
    probes = max(1, round(probe * len(index.centres)))

    def assign(batches):
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(list=index.lists(index.lift(np.stack(pdf["v"].to_numpy())), 1)[:, 0])

    def route(batches):
        """The nearest list of each query, and the distance up to which lists are probed."""
        for pdf in batches:
            for s in range(0, len(pdf), 1024):
                part = pdf.iloc[s:s + 1024]
                away = index.away(index.lift_query(np.stack(part["v"].to_numpy())), index.centres)
                yield part.assign(home=away.argmin(axis=1), cut=np.partition(away, probes - 1, axis=1)[:, probes - 1])

    listed = Written(rows.withColumn("n", F.monotonically_increasing_id()).mapInPandas(assign, "id long, v array<double>, n long, list int"), "scan-rows")
    asked = rows.where(F.col("id") % query_modulus == 0).groupBy("id").agg(F.min(F.struct(F.xxhash64("v").alias("h"), "v")).alias("q"))
    queries = Written(asked.select("id", F.col("q.v").alias("v")).mapInPandas(route, "id long, v array<double>, home int, cut double"), "scan-queries")
    # A row per list: where its blocks begin, how many there are, and into how many chunks the queries at home there fall.
    sizes = listed.df.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks")).orderBy("list").collect()
    at_home = {r[0]: r[1] for r in queries.df.groupBy("home").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int")).collect()}
    firsts = np.cumsum([0, *(r["blocks"] for r in sizes)])
    shape = df.sparkSession.createDataFrame(
        [(r["list"], int(f), r["blocks"], at_home.get(r["list"], 0)) for r, f in zip(sizes, firsts)], "list int, first int, blocks int, chunks int")
    n_blocks, n_chunks = int(firsts[-1]), max(1, -(-queries.df.count() // QUERY_ROWS))

    # Rows are dealt by their number, so copies spread over the blocks of their list.
    dealt = listed.df.join(F.broadcast(shape), "list").withColumn("block", F.col("first") + F.pmod(F.xxhash64("n"), F.col("blocks")).cast("int"))
    blocks = Written(dealt.groupBy("list", "block").applyInPandas(_packed("list", "block"), "list int, block int, ids binary, vals binary, more binary"), "scan-blocks")
    chunk_of = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    span = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))

    own = queries.df.join(F.broadcast(shape.withColumnRenamed("list", "home")), "home").withColumn("chunk", chunk_of(F.col("chunks")))
    own = own.withColumn("more", F.lit(None).cast("double")).groupBy("home", "chunk").applyInPandas(_packed("home", "chunk"), "home int, chunk int, ids binary, vals binary, more binary")
    own = own.join(F.broadcast(shape.withColumnRenamed("list", "home")), "home").withColumn("block", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("blocks") - 1)))
    at = blocks.df.join(F.broadcast(shape.where("chunks > 0").select("list", "chunks")), "list").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    first = Written(_probe(at, own.select("block", "chunk", "ids", "vals", "more"), index, dims, k, step, epsilon), "scan-home")
    # The k-th best product of the first list bounds the scan of the others.
    best = Window.partitionBy("id").orderBy(F.desc("score"), "vec_id")
    bounds = first.df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).where(F.col("rank") == k).select("id", F.col("score").alias("low"))
    rest = queries.df.join(bounds, "id", "left").withColumn("chunk", chunk_of(F.lit(n_chunks)))
    rest = rest.withColumn("more", F.array("low", "cut", F.col("home").cast("double")))
    rest = Written(rest.groupBy("chunk").applyInPandas(_packed("chunk"), "chunk int, ids binary, vals binary, more binary"), "scan-chunks").df
    each = F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1)))
    others = _probe(read(blocks).withColumn("chunk", each), rest.withColumn("block", span), index, dims, k, step, epsilon)
    return (
        first.df.union(others).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select(F.col("id").alias("query_id"), "rank", "vec_id", "score")
    )


def _packed(*keys: str):
    """One row of a group: its keys, ids, vectors and, of queries, what bounds their scan."""

    def pack(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("id", kind="stable")
        more = np.stack(own["more"].to_numpy()).astype(np.float64).tobytes() if "more" in own and own["more"].notna().any() else None
        return pd.DataFrame({
            **{c: own[c].iloc[:1].to_numpy() for c in keys}, "ids": [own["id"].to_numpy(np.int64).tobytes()],
            "vals": [np.stack(own["v"].to_numpy()).astype(np.float64).tobytes()], "more": [more]})

    return pack


def _probe(blocks: DataFrame, chunks: DataFrame, index: Index, dims: int, k: int, step: int, epsilon: float) -> DataFrame:
    """The ``k`` best rows of each block for each query of a chunk that is to probe it: id, vec_id, score.

    ``more`` of a chunk holds for each query the bound on products (or NaN), the distance up to which it probes lists and its
    nearest list, which is done. A list whose nearest point lies beyond the bound is not scanned."""
    empty = pd.DataFrame({"id": np.array([], np.int64), "vec_id": np.array([], np.int64), "score": np.array([], float)})

    def search(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(asked):
            return empty
        ix, iq = (np.frombuffer(f["ids"].iloc[0], np.int64) for f in (own, asked))
        vx, vq = (np.frombuffer(f["vals"].iloc[0]).reshape(-1, dims) for f in (own, asked))
        bound = np.full(len(iq), np.inf)
        if asked["more"].iloc[0] is not None:
            low, cut, home = np.frombuffer(asked["more"].iloc[0]).reshape(-1, 3).T
            here, centre = int(own["list"].iloc[0]), index.centres[own["list"].iloc[0]][None, :]
            away = index.away(index.lift_query(vq), centre)[:, 0]
            bound = np.where(np.isnan(low), np.inf, (vq * vq).sum(axis=1) + index.radius ** 2 - 2 * low)
            reach = np.sqrt(max(0.0, index.away(index.lift(vx), centre).max()))
            near = np.sqrt(np.maximum(away, 0)) - reach <= np.sqrt(np.maximum(bound, 0)) + 1e-9
            go = np.flatnonzero((home != here) & (away <= cut) & near)
            iq, vq, bound = iq[go], vq[go], bound[go]
        out = [empty]
        for s in range(0, len(vq), 64):
            qi, xi = scan(index, vq[s:s + 64], vx, np.maximum(bound[s:s + 64], 0) + 1e-12, step, epsilon)
            qi = qi + s
            live = iq[qi] != ix[xi]
            qi, xi = qi[live], xi[live]
            score = np.concatenate([products(vq[qi[t:t + 100_000]], vx[xi[t:t + 100_000]]) for t in range(0, len(qi), 100_000)] or [np.zeros(0)])
            order = np.lexsort((ix[xi], -score, qi))
            qi, xi, score = qi[order], xi[order], score[order]
            first = np.searchsorted(qi, qi, side="left")
            keep = np.arange(len(qi)) - first < k
            out.append(pd.DataFrame({"id": iq[qi[keep]], "vec_id": ix[xi[keep]], "score": score[keep]}))
        return pd.concat(out)

    keys = ["block", "chunk"]
    return blocks.groupBy(*keys).cogroup(chunks.groupBy(*keys)).applyInPandas(search, "id long, vec_id long, score double")

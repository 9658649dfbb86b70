"""Shingle sets, inverted lists as packed columns, and exact linking of what meets in a list."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.llm.cap_filters import _roots
from cohortica.llm.common import Written, components, runs

# Postings a task packs at a time, and postings a bucket is meant to hold in a reducing task.
PACK, BUCKET = 300_000, 1_500_000
# Lists up to this size are paired member by member; longer ones meet in blocks, and no pair of theirs is listed.
SHORT_LIST, BLOCK_ROWS = 24, 512
BLOOM_BITS = 1 << 25
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(z: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        z = (z ^ (z >> np.uint64(30))) * M2
        z = (z ^ (z >> np.uint64(27))) * M3
        return z ^ (z >> np.uint64(31))


class Shingler:
    """Hashes of words (runs of anything but ASCII white space, A-Z lower-cased) and of their shingles.

    Works on the bytes of an Arrow column, some hundred kilobytes at a time, without a Python object per text or word."""

    CHUNK = 1 << 19

    def __init__(self, width: int = 5, seed: int = 17, fold: bool = True):
        self.width = width
        letters = np.arange(256, dtype=np.uint8)
        if fold:
            letters[65:91] += 32
        # A value per byte, upper and lower case alike; white space is told by its own table.
        self.values = np.random.RandomState(seed).randint(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)[letters] * np.uint64(2) + np.uint64(1)
        self.blank = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
        self._powers(self.CHUNK + 1)

    def _powers(self, n: int) -> None:
        """Powers of an odd factor and of its inverse modulo 2^64: a stretch of a running sum, moved to its start."""
        factor, inverse = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
        with np.errstate(over="ignore"):
            self.power, self.inverse = (
                np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, f, np.uint64)]) for f in (factor, inverse))

    def words(self, column, hashed: bool = True):
        """Per chunk of an Arrow string column: texts' first words (and the end), word hashes, the bytes of the chunk,
        where its texts begin in them (and the end), and where words start and end."""
        buffers, n = column.buffers(), len(column)
        if not n:
            return
        offsets = np.frombuffer(buffers[1], np.int64 if str(column.type) == "large_string" else np.int32, n + 1 + column.offset)[column.offset:].astype(np.int64)
        data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
        at = 0
        while at < n:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + self.CHUNK, side="right")) - 1)
            own, bounds = data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
            firsts, hashes, starts, ends = self._chunk(own, bounds, hashed)
            yield firsts, hashes, own, bounds, starts, ends
            at = end

    def _chunk(self, data: np.ndarray, bounds: np.ndarray, hashed: bool):
        if len(data) >= len(self.power):
            self._powers(2 * len(data))
        inside = ~self.blank[data]
        begin, stop = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        stop[:-1] &= ~inside[1:]
        cuts = bounds[(bounds > 0) & (bounds < len(data))]
        begin[cuts] = inside[cuts]
        stop[cuts - 1] = inside[cuts - 1]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        return np.searchsorted(starts, bounds), self.hashed(data, starts, ends) if hashed else None, starts, ends

    def hashed(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of stretches of a chunk of bytes."""
        with np.errstate(over="ignore"):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(self.values[data] * self.power[:len(data)], out=sums[1:])
            return mix((sums[ends] - sums[starts]) * self.inverse[starts])

    def rolled(self, words: np.ndarray) -> np.ndarray:
        """The hash of every run of ``width`` words."""
        n = len(words) - self.width + 1
        if n <= 0:
            return words[:0]
        with np.errstate(over="ignore"):
            total = words[:n] * M1
            for k in range(1, self.width):
                total += words[k:n + k]
                total *= M1
            return mix(total + np.uint64(self.width))

    def short(self, words: np.ndarray) -> np.ndarray:
        """The one shingle of fewer words than ``width``."""
        with np.errstate(over="ignore"):
            total = np.uint64(0)
            for w in words:
                total = (total + w) * M1
            return mix(np.array([total + np.uint64(len(words))]))

    def sets(self, column):
        """The sorted set of shingle hashes of each text: fewer words than a shingle are one shingle, no words none."""
        for firsts, words, *_ in self.words(column):
            rolled = self.rolled(words)
            for a, b in zip(firsts[:-1], firsts[1:]):
                if b - a >= self.width:
                    own = np.sort(rolled[a:b - self.width + 1])
                    yield own[np.r_[True, own[1:] != own[:-1]]]
                else:
                    yield self.short(words[a:b]) if b > a else words[:0]


def identity(values: np.ndarray) -> int:
    """A 64-bit name for a sorted set, as a signed number."""
    import xxhash

    n = xxhash.xxh3_64_intdigest(values.tobytes(), seed=len(values))
    return n - (1 << 64) if n >> 63 else n


def bucket_of(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each key and the 32 bits that name it there. Keys that agree in both meet in one list, which only adds candidates."""
    z = mix(keys + M1)
    return ((z >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32), (z & np.uint64(0xFFFFFFFF)).astype(np.uint32)


class Packer:
    """Collects columns of postings and packs them by bucket: one row per bucket, a binary cell per column."""

    def __init__(self, buckets: int, kinds: list):
        self.buckets, self.kinds, self.held, self.count = buckets, kinds, [], 0

    def add(self, keys: np.ndarray, *columns) -> None:
        self.held.append((keys, *[c if isinstance(c, np.ndarray) else np.full(len(keys), c, k) for c, k in zip(columns, self.kinds)]))
        self.count += len(keys)

    def full(self) -> bool:
        return self.count >= PACK

    def pack(self):
        """(bucket, cells) for all that is held."""
        if not self.held:
            return
        keys, *columns = (np.concatenate(c) for c in zip(*self.held))
        self.held, self.count = [], 0
        bucket, name = bucket_of(keys, self.buckets)
        order = np.argsort(bucket.astype(np.uint16) if self.buckets <= 1 << 16 else bucket, kind="stable")  # short numbers sort faster
        bucket, columns = bucket[order], [name[order], *[c[order].astype(k) for c, k in zip(columns, self.kinds)]]
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        for a, b in zip(starts, [*starts[1:], len(bucket)]):
            yield int(bucket[a]), [c[a:b].tobytes() for c in columns]


def repeated(key: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Places of the first posting of each (key, item), of keys with two items or more."""
    # Most keys stand once. They leave first: only postings that share their key's last bits with another are sorted.
    last = (key & ((1 << (4 * len(key)).bit_length()) - 1)).astype(np.int64)
    order = np.flatnonzero(np.bincount(last)[last] > 1)
    order = order[np.lexsort((item[order], key[order]))]
    k, i = key[order], item[order]
    new_key = np.r_[True, k[1:] != k[:-1]] if len(k) else np.zeros(0, bool)
    new = new_key | np.r_[True, i[1:] != i[:-1]] if len(k) else new_key
    order, k, new_key = order[new], k[new], new_key[new]
    if not len(order):
        return order
    starts = np.flatnonzero(new_key)
    sizes = np.diff(np.r_[starts, len(k)])
    return order[np.repeat(sizes, sizes) > 1]


def bloom(items: DataFrame) -> np.ndarray:
    """A filter of ``BLOOM_BITS`` bits over the column ``item``, with the row's ``id`` (a text) if there is one: its size
    never grows. Once full it keeps everything."""
    chunk, with_id = 1 << 17, "id" in items.columns

    def bits(batches):
        held = {}
        for pdf in batches:
            named = pdf["item"].to_numpy()
            if with_id:
                named = named_by(named, pdf["id"])
            at = np.unique(bloom_places(named).ravel())
            home = at // chunk
            starts = np.flatnonzero(np.r_[True, home[1:] != home[:-1]]) if len(at) else at
            for a, b in zip(starts, [*starts[1:], len(at)]):
                own = held.setdefault(int(home[a]), np.zeros(chunk // 8, np.uint8))
                here = at[a:b] % chunk
                np.bitwise_or.at(own, here >> 3, (1 << (here & 7)).astype(np.uint8))
        if held:
            yield pd.DataFrame({"chunk": list(held), "bits": [b.tobytes() for b in held.values()]})

    def either(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "bits": [np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in pdf["bits"]]).tobytes()]})

    out = np.zeros(BLOOM_BITS // 8, np.uint8)
    for c, b in items.select("item", *["id"] * with_id).mapInPandas(bits, "chunk int, bits binary").groupBy("chunk").applyInPandas(either, "chunk int, bits binary").collect():
        out[c * chunk // 8:(c + 1) * chunk // 8] = np.frombuffer(b, np.uint8)
    return out


def named_by(items: np.ndarray, ids) -> np.ndarray:
    """One name for an item and the id of a row that holds it."""
    import xxhash

    return items ^ np.array([xxhash.xxh64_intdigest("" if i is None else i) >> 1 for i in ids], np.int64)


def bloom_places(items: np.ndarray) -> np.ndarray:
    z = mix(items.astype(np.int64).view(np.uint64) + M1)
    return np.stack([(z >> np.uint64(s)) & np.uint64(BLOOM_BITS - 1) for s in (0, 19, 38)], axis=1).astype(np.int64)


def in_bloom(filter_bits: np.ndarray, items: np.ndarray) -> np.ndarray:
    at = bloom_places(items)
    return ((filter_bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


def similar(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Of ``pairs`` (a, b) those whose sets reach ``threshold`` hundredths of their union, exactly."""

    def verify(batches):
        for batch in batches:
            a, b, sa, sb = (batch.column(k) for k in range(4))
            keep = []
            for x, y in zip(sa, sb):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                inter = int((both[1:] == both[:-1]).sum())
                keep.append(100 * inter >= threshold * (len(x) + len(y) - inter))
            import pyarrow as pa

            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    own = pairs.join(sets.select(F.col("item").alias("a"), F.col("tokens").alias("ta")), "a")
    own = own.join(sets.select(F.col("item").alias("b"), F.col("tokens").alias("tb")), "b").select("a", "b", "ta", "tb")
    return own.mapInArrow(verify, "a long, b long")


def sizes_fit(threshold: int, a: str, b: str):
    return (F.least(a, b) * 100 >= F.greatest(a, b) * threshold)


def parity(values: np.ndarray) -> bytes:
    """A bitmap of about one bit per element: whether an odd number of elements falls on each place."""
    places = 1 << max(6, (len(values) - 1).bit_length())
    odd = np.bincount((values & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def sieve(pairs: DataFrame, bitmaps: DataFrame, threshold: int) -> DataFrame:
    """``pairs`` (a, b) without those whose bitmaps (item, n, bitmap) prove them too unlike.

    Each place where two bitmaps differ holds an element that only one set has, so the sets differ in at least that
    many. The longer bitmap folds onto the shorter one."""

    def live(batches):
        import pyarrow as pa

        for batch in batches:
            keep = []
            for n, m, x, y in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4, 5))):
                x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                while len(x) != len(y):
                    if len(x) > len(y):
                        x = x[: len(x) // 2] ^ x[len(x) // 2:]
                    else:
                        y = y[: len(y) // 2] ^ y[len(y) // 2:]
                inter = (n + m - int(np.bitwise_count(x ^ y).sum())) // 2
                keep.append(100 * inter >= threshold * (n + m - inter))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda c: bitmaps.select(F.col("item").alias(c), F.col("n").alias(f"n{c}"), F.col("bitmap").alias(f"m{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ma", "mb").mapInArrow(live, "a long, b long")


def connect(lists: DataFrame, stars: DataFrame, fetch, threshold: int, name: str, sieved=None, most_odd: int = 64, slack: float = 1.0) -> Written:
    """Components of all items linked by similarity, among those that share a list.

    ``lists`` (key, item, n, and if known bits): every two linked items share a key. ``stars`` (a, b): pairs to try first,
    linear in the lists. ``fetch`` gives the sets (item, tokens) of at least the items of a frame, or is a written table of
    all; ``sieved`` drops pairs that cannot be similar, and so do bits (parities of the set on at most 64 places) that differ
    on more than ``most_odd``. An ``n`` may be too large by the factor ``slack``.
    Items already connected need no further test; so after the stars only lists that still span several components
    are searched: short ones pair by pair, long ones in blocks whose pairs are never listed."""

    given = fetch if isinstance(fetch, Written) else None

    def verified(pairs: DataFrame, step: str) -> Written:
        left = Written(sieved(pairs) if sieved else pairs, f"{name}-{step}-pairs")
        sets = given or Written(fetch(left.df.select(F.col("a").alias("item")).union(left.df.select("b")).distinct()), f"{name}-{step}-sets")
        linked = Written(similar(left.df, sets.df, threshold), f"{name}-{step}-links")
        left.drop()
        if not given:
            sets.drop()
        return linked

    if "bits" not in lists.columns:
        lists = lists.withColumn("bits", F.lit(0).cast("long"))
    first = verified(stars, "star")
    known = components(first.df, f"{name}-first")
    placed = lists.join(known.df.withColumnRenamed("node", "item"), "item", "left").withColumn("component", F.coalesce("component", "item"))
    spread = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("size")).where("x < y")
    open_lists = Written(placed.join(spread.select("key", "size"), "key").select("key", "item", "n", "bits", "component", "size"), f"{name}-open")

    def pair(batches):
        for pdf, _ in runs(batches, ["key"]):
            key, item, n, bits, comp = (pdf[c].to_numpy() for c in ("key", "item", "n", "bits", "component"))
            out = []
            for d in range(1, SHORT_LIST):  # rows of a key stand together: all its pairs are so many rows apart
                i = np.flatnonzero(key[d:] == key[:-d])
                if not len(i):
                    break
                j = i + d
                live = (comp[i] != comp[j]) & (np.minimum(n[i], n[j]) * (100 * slack) >= np.maximum(n[i], n[j]) * threshold)
                odd = np.bitwise_count((bits[i] ^ bits[j]).view(np.uint64))
                live &= (odd <= most_odd) & (odd * (100.0 + threshold) <= (n[i] + n[j]) * (100 - threshold))
                i, j = i[live], j[live]
                out.append(np.stack([np.minimum(item[i], item[j]), np.maximum(item[i], item[j])], axis=1))
            if out and sum(map(len, out)):
                yield pd.DataFrame(np.unique(np.concatenate(out), axis=0), columns=["a", "b"])

    short = open_lists.df.where(F.col("size") <= SHORT_LIST).repartition("key").sortWithinPartitions("key")
    pairs = short.select("key", "item", "n", "bits", "component").mapInPandas(pair, "a long, b long").distinct()
    long = (
        open_lists.df.where(F.col("size") > SHORT_LIST).withColumn("parts", F.ceil(F.col("size") / BLOCK_ROWS).cast("int"))
        .withColumn("part", F.pmod(F.xxhash64("item"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "item", "component")
    )
    held = given or Written(fetch(long.select("item").distinct()), f"{name}-block-sets")
    long = long.join(held.df, "item")
    keys = ["key", "i", "j"]

    def block(batches):
        for pdf, starts in runs(batches, keys):
            for a, b in zip(starts, [*starts[1:], len(pdf)]):
                own = pdf.iloc[a:b]
                linked = _linked(own["tokens"].to_numpy(), threshold)
                if own["i"].iloc[0] != own["j"].iloc[0]:
                    part = own["part"].to_numpy()
                    linked &= part[:, None] != part[None, :]
                at = np.flatnonzero(linked.any(axis=1))
                if len(at):
                    item = own["item"].to_numpy()[at]
                    yield pd.DataFrame({"a": item, "b": _roots(linked[np.ix_(at, at)], item)}).query("a != b")

    met = long.repartition(*keys).sortWithinPartitions(*keys).select(*keys, "part", "item", "tokens").mapInPandas(block, "a long, b long")
    second, third = verified(pairs, "short"), Written(met.distinct(), f"{name}-long-links")
    known_links = known.df.select(F.col("node").alias("a"), F.col("component").alias("b"))
    both = components(known_links.union(second.df).union(third.df), f"{name}-components")
    for w in (known, open_lists, third, second, first, *[held] * (not given)):
        w.drop()
    return both


def _linked(sets, threshold: int) -> np.ndarray:
    """Which of the given sets are similar, from products of their incidence, some thousand tokens at a time."""
    tokens = [np.frombuffer(s, np.uint64) for s in sets]
    size = np.array([len(t) for t in tokens])
    row = np.repeat(np.arange(len(tokens)), size)
    _, column, count = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    shared = count > 1
    place = np.cumsum(shared) - 1
    live = shared[column]
    row, column = row[live], place[column[live]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    inter = np.zeros((len(tokens), len(tokens)), np.float32)
    for a in range(0, int(shared.sum()), 4096):
        s, e = np.searchsorted(column, [a, a + 4096])
        incidence = np.zeros((len(tokens), 4096), np.float32)
        incidence[row[s:e], column[s:e] - a] = 1
        inter += incidence @ incidence.T
    union = size[:, None] + size[None, :] - inter
    linked = (100 * inter.astype(np.float64) >= threshold * union) & (inter > 0)
    np.fill_diagonal(linked, False)
    return linked

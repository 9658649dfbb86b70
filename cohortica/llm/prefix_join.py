"""Set-similarity join of documents by grouped prefixes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.llm.common import Recent, Written, scoped, slices
from cohortica.llm.postings import BUCKET, Packer, Shingler, bloom, bucket_of, connect, identity, in_bloom, mix, named_by, parity, repeated, sieve, sizes_fit

# Places of the frequency sketch that orders shingles: one byte each, sent to every task. Fixed, whatever the input.
SKETCH = 1 << 24


def _sketch_places(values: np.ndarray) -> np.ndarray:
    return (mix(values ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(SKETCH - 1)).astype(np.int64)


def _buckets(chars: int, share: float) -> int:
    """Buckets of about ``BUCKET`` postings, from the size of the texts (six characters a word)."""
    return max(256, -(-int(chars / 6 * share) // BUCKET))


def frequency_sketch(texts: DataFrame, buckets: int, width: int) -> np.ndarray:
    """Levels (log2 of the number of documents, 2 at least) of the most frequent shingles, hashed into ``SKETCH`` places.

    All shingles of all documents are counted. As many levels are kept, from the top, as fit three quarters of the places;
    the rest have level 0. The levels only order shingles, so whatever they are the join stays exact."""

    def count(batches):
        import pyarrow as pa

        shingler, held = Shingler(width), []

        def flush():
            values, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            deal = Packer(buckets, ["<u4"])
            deal.add(values, n)
            rows = list(deal.pack())
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1][0] for r in rows]), pa.array([r[1][1] for r in rows])], names=["bucket", "keys", "counts"])

        size = 0
        for batch in batches:
            for own in shingler.sets(batch.column(0)):
                if len(own):
                    held.append(own)
                    size += len(own)
                if size > 600_000:
                    yield flush()
                    size = 0
        if size:
            yield flush()

    def levels(batches):
        import pyarrow as pa

        def found(bucket, cells):
            keys, counts = (np.concatenate([np.frombuffer(c, "<u4") for c in column]) for column in zip(*cells))
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            total = np.add.reduceat(counts[order].astype(np.int64), starts)
            often = total >= 2
            names, level = keys[starts][often], np.log2(total[often]).astype(np.int64)
            each = np.unique(level).tolist()
            own = [names[level == v] for v in each]
            return pa.RecordBatch.from_arrays([
                pa.array([bucket] * len(each), pa.int32()), pa.array(each, pa.int32()), pa.array([len(x) for x in own], pa.int64()),
                pa.array([x.tobytes() for x in own], pa.binary())], names=["bucket", "level", "n", "keys"])

        now, held = None, []
        for batch in batches:
            for bucket, *cells in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != now and held:
                    yield found(now, held)
                    held = []
                now = bucket
                held.append(cells)
        if held:
            yield found(now, held)

    counted = texts.mapInArrow(count, "bucket int, keys binary, counts binary")
    often = Written(counted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(levels, "bucket int, level int, n long, keys binary"), "prefix-levels")
    sketch, room, lowest = np.zeros(SKETCH, np.uint8), SKETCH * 3 // 4, 99
    for level, n in often.df.groupBy("level").agg(F.sum("n")).orderBy(F.desc("level")).collect():  # at most 64 rows
        if n > room:
            break
        room, lowest = room - n, level
    # At most as many shingles as there is room for, a partition at a time.
    for bucket, level, keys in often.df.where(F.col("level") >= lowest).select("bucket", "level", "keys").toLocalIterator():
        at = _key_places(bucket, np.frombuffer(keys, "<u4"))
        sketch[at] = np.maximum(sketch[at], level)
    often.drop()
    return sketch


def _key_places(bucket, names: np.ndarray) -> np.ndarray:
    """Place in the sketch of a shingle known by its bucket and name there."""
    return _sketch_places(np.asarray(bucket).astype(np.uint64) << np.uint64(32) | names.astype(np.uint64))


def ordered(values: np.ndarray, sketch: np.ndarray, buckets: int) -> np.ndarray:
    """The shingles of a set from rare to frequent: level first, then the hash. One order for all documents."""
    bucket, name = bucket_of(values, buckets)
    level = sketch[_key_places(bucket, name)]
    return np.sort(level.astype(np.uint64) << np.uint64(56) | values >> np.uint64(8))


def prefix_length(n: int, threshold: int) -> int:
    """Two sets of at least ``n`` elements that reach the threshold share one of so many first elements."""
    return n - -(-threshold * n // 100) + 1


@scoped
def join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 75, width: int = 5) -> DataFrame:
    """Links between documents whose sets of ``width``-word shingles reach ``threshold`` hundredths of their union.

    One row per input row: id, n_shingles, component_id (smallest id reachable by links). Documents of equal sets are
    one item; items of equal prefix and size are one group. Groups meet in the lists of their prefix shingles, size
    filters pairs, members are verified on their whole sets. Sets are of 64-bit hashes of shingles.

    Null or empty texts, and texts without words, have empty sets and link with nothing. Rows without an id count for
    links and keep a null component_id unless a linked row has an id. Repeated rows are equal sets, so they link."""
    kind = dict(df.dtypes)[id_col]
    rows = df.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text"))
    chars = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = _buckets(int(chars), 0.3)
    sketch = frequency_sketch(rows.select("text"), buckets, width)

    def post(batches):
        import pyarrow as pa

        shingler, packer, seen = Shingler(width), Packer(buckets, ["<i8", "<i4", "<i4"]), Recent()
        names = ["bucket", "id", "item", "group", "n", "bitmap", "keys", "groups", "sizes", "places"]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 5]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        for batch in slices(batches, 2048):
            out = []
            for k, (i, own) in enumerate(zip(batch.column(0).to_pylist(), shingler.sets(batch.column(1)))):
                if not len(own):
                    out.append((k % buckets, i, None, None, 0, *[None] * 5))
                    continue
                item, n = identity(own), len(own)
                first = ordered(own, sketch, buckets)[:prefix_length(n, threshold)]
                group = identity(np.append(first, np.uint64(n)))
                out.append(((item ^ k) % buckets, i, item, group, n, parity(own), *[None] * 4))
                if seen.new(group):  # copies within a task add nothing to the lists
                    packer.add(first, group, n, np.arange(len(first)))
                if packer.full():
                    yield batch_of([(b, None, None, None, None, None, *cells) for b, cells in packer.pack()])
            yield batch_of(out)
        if packer.count:
            yield batch_of([(b, None, None, None, None, None, *cells) for b, cells in packer.pack()])

    def gather(batches):
        import pyarrow as pa

        names = ["id", "item", "group", "n", "bitmap", "key", "place"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int32()]
        held, bucket = [], None

        def lists():
            key, group, size, place = (np.concatenate([np.frombuffer(c[k], t) for c in held]) for k, t in enumerate(("<u4", "<i8", "<i4", "<i4")))
            at = repeated(key, group)
            if not len(at):
                return None
            nothing = [pa.nulls(len(at), t) for t in kinds[:2]]
            return pa.RecordBatch.from_arrays([*nothing, pa.array(group[at]), pa.array(size[at]), pa.nulls(len(at), kinds[4]), pa.array(bucket << 32 | key[at].astype(np.int64)), pa.array(place[at])], names=names)

        for batch in batches:
            documents = batch.filter(batch.column(6).is_null())
            if len(documents):
                yield pa.RecordBatch.from_arrays([*[documents.column(k) for k in (1, 2, 3, 4, 5)], pa.nulls(len(documents), kinds[5]), pa.nulls(len(documents), kinds[6])], names=names)
            packed = batch.filter(batch.column(6).is_valid())
            for b, *cells in zip(packed.column(0).to_pylist(), *(packed.column(k).to_pylist() for k in (6, 7, 8, 9))):
                if b != bucket and held:
                    out = lists()
                    held = []
                    if out:
                        yield out
                bucket = b
                held.append(cells)
        if held:
            out = lists()
            if out:
                yield out

    posted = rows.mapInArrow(post, "bucket int, id string, item long, group long, n int, bitmap binary, keys binary, groups binary, sizes binary, places binary")
    found = Written(
        posted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(gather, "id string, item long, group long, n int, bitmap binary, key long, place int"), "prefix-lists")
    documents = found.df.where("key IS NULL").select("id", "item", "group", "n", "bitmap")
    members = documents.where("item IS NOT NULL").groupBy("group", "item").agg(F.min("n").alias("n"))
    lists = found.df.where("key IS NOT NULL").select("key", "group", "n", "place")
    # A group of several members is a list of its own.
    heads = members.groupBy("group").agg(F.min("item").alias("head"), F.count("*").alias("members"))
    shared = members.join(heads.where("members > 1"), "group")
    # The pivot of a list: the group with the fewest rarer shingles, the most central of near copies.
    pivots = lists.groupBy("key").agg(F.min(F.struct("place", "group", "n")).alias("p")).select("key", F.col("p.group").alias("pivot"), F.col("p.n").alias("pn"))
    spokes = lists.join(pivots, "key").where("group <> pivot").where(sizes_fit(threshold, "n", "pn")).select("group", "pivot").distinct()
    head = heads.select("group", "head")
    stars = (
        spokes.join(head, "group").join(head.select(F.col("group").alias("pivot"), F.col("head").alias("other")), "pivot")
        .select(F.col("head").alias("a"), F.col("other").alias("b"))
        .union(shared.where("item <> head").select(F.col("item").alias("a"), F.col("head").alias("b"))).distinct()
    )
    items = Written(
        lists.join(members.select("group", "item"), "group").select("key", "item", "n")
        .union(shared.select(F.col("group").alias("key"), "item", "n")), "prefix-items")
    # Each set and bitmap is taken from one of its documents.
    homes = documents.where("item IS NOT NULL").groupBy("item").agg(F.min("id").alias("id"))
    bitmaps = Written(
        documents.join(items.df.select("item").distinct(), "item", "left_semi").groupBy("item")
        .agg(F.min("n").alias("n"), F.min("bitmap").alias("bitmap")), "prefix-bitmaps")
    linked = connect(
        items.df, stars, lambda wanted: token_sets(rows, bloom(wanted.join(homes, "item")), width), threshold, "prefix",
        lambda pairs: sieve(pairs, bitmaps.df, threshold))
    items.drop()
    bitmaps.drop()
    own = documents.select(F.col("id").cast(kind).alias("id"), "item", "n")
    lows = own.where("item IS NOT NULL").groupBy("item").agg(F.min("id").alias("low")).join(linked.df.withColumnRenamed("node", "item"), "item", "left")
    lows = lows.withColumn("component", F.coalesce("component", "item"))
    least = lows.groupBy("component").agg(F.min("low").alias("component_id"))
    named = lows.join(least, "component").select("item", "component_id")
    return own.join(named, "item", "left").select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def token_sets(rows: DataFrame, wanted: np.ndarray, width: int) -> DataFrame:
    """(item, tokens): the sets of the items that the filter lets through, once each."""

    def pick(batches):
        import pyarrow as pa

        shingler, seen = Shingler(width), Recent()
        for batch in slices(batches):
            own = [*shingler.sets(batch.column(1))]
            names = np.array([identity(x) if len(x) else 0 for x in own], np.int64)
            live = in_bloom(wanted, named_by(names, batch.column(0).to_pylist()))
            items, sets = [], []
            for k in np.flatnonzero(live):
                if len(own[k]) and seen.new(int(names[k])):
                    items.append(names[k])
                    sets.append(own[k].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(sets, pa.binary())], names=["item", "tokens"])

    return rows.mapInArrow(pick, "item long, tokens binary").dropDuplicates(["item"])


def survivors(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``df`` without the rows whose component holds a smaller id: one document of each group stays.

    Of repeated rows of one id all stay or go together; rows without an id stay."""
    linked = join(df, id_col, text_col, **options)
    gone = linked.where(F.col(id_col) > F.col("component_id")).select(id_col).distinct()
    return df.join(gone, id_col, "left_anti")

"""Passages that repeat across documents, by MinHash banding of paragraphs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.llm.common import Recent, Written, scoped
from cohortica.llm.postings import BUCKET, M1, M2, M3, SHORT_LIST, Packer, Shingler, bloom, connect, in_bloom, mix, repeated

# Sizes of sets fall into classes, told in a byte: exact up to 20, then within a factor.
SLACK = 1.05
# Kinds of rows that lists leave: members of open lists, pairs of items to try, marks of two texts or more.
LIST, PAIR, MARK = range(3)


def size_edges() -> np.ndarray:
    """The smallest size of each class; the last class holds all larger ones."""
    edges = [1]
    while len(edges) < 256:
        edges.append(max(edges[-1] + 1, int(np.ceil(edges[-1] * SLACK))))
    return np.array(edges, np.int64)


def tune(threshold: float, recall: float = 0.995, noise: float = 0.2, false_share: float = 0.1) -> tuple[int, int]:
    """(bands, rows): the fewest bands that let pairs at ``threshold`` meet with probability ``recall`` and pairs at
    ``noise`` with at most ``false_share``; if none do, the most selective of those that reach the recall."""
    found = []
    for rows in range(1, 9):
        bands = next(b for b in range(1, 100_000) if 1 - (1 - threshold ** rows) ** b >= recall)
        found.append((bands, rows, 1 - (1 - noise ** rows) ** bands))
    fit = [f for f in found if f[2] <= false_share] or [min(found, key=lambda f: f[2])]
    return min(fit)[:2]


class Paragraphs:
    """Cuts texts into units and signs them.

    Units that are compared by similarity: the texts' own paragraphs (lines, and blocks between blank lines) of
    ``least`` words or more, as long as they are, and windows of ``length`` words that begin where the text itself says
    so: at each word whose pair with the next word has the smallest hash among the ``reach`` words on either side.

    Units that are compared exactly: every window of ``length`` words, and own paragraphs of ``least`` to ``length - 1``
    words. Windows have a mark: of the runs of ``gram`` words in a window the one of the smallest hash. So equal windows
    have equal marks, and neighbours mostly share theirs."""

    def __init__(self, length: int = 20, reach: int = 6, width: int = 5, bands: int = 7, rows: int = 2, least: int = 10,
                 gram: int = 12, seed: int = 23):
        self.length, self.reach, self.bands, self.rows, self.least, self.gram = length, reach, bands, rows, least, min(gram, length)
        self.shingler, self.width, self.whole, self.part = Shingler(width), width, Shingler(length), Shingler(self.gram)
        rng = np.random.RandomState(seed)
        self.seeds = rng.randint(1, 1 << 62, bands * rows, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)

    def begins(self, words: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Words at which a paragraph begins; ``text`` numbers the text of each word."""
        if len(words) < self.length:
            return np.zeros(0, np.int64)
        with np.errstate(over="ignore"):
            value = mix(words[:-1] * M1 + words[1:])
        own = text[:-1]
        least = own == text[1:]
        for k in range(1, self.reach + 1):
            near = own[k:] == own[:-k]
            less = value[k:] < value[:-k]
            least[:-k] &= ~(near & less)
            least[k:] &= ~near | less
        at = np.flatnonzero(least)
        at = at[at + self.length <= len(words)]
        return at[text[at] == text[at + self.length - 1]]

    def own(self, data: np.ndarray, firsts: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and end of the texts' own paragraphs: lines, and blocks of several lines between blank ones."""
        breaks = np.searchsorted(np.flatnonzero(data == 10), starts, side="right")
        apart = np.r_[0, np.diff(breaks)] if len(starts) else breaks
        found = []
        for least in (1, 2):
            edge = np.unique(np.r_[firsts, np.flatnonzero(apart >= least)])
            found.append(np.stack([edge[:-1], edge[1:]], axis=1))
        both = np.unique(np.concatenate(found), axis=0)
        both = both[both[:, 1] - both[:, 0] >= max(self.least, self.width)]
        return both[:, 0], both[:, 1]

    def items(self, shingles: np.ndarray, at: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """64 bits that name the bag of shingles of each unit."""
        if not len(at):
            return np.zeros(0, np.int64)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(shingles) + 1, np.uint64)
            np.cumsum(mix(shingles ^ M2), out=sums[1:])
            return mix(sums[stop - self.width + 1] - sums[at]).view(np.int64)

    def chunks(self, column):
        """(text of each unit, its first word, its end, items, shingle hashes, rest of the chunk) per chunk of a column."""
        done = 0
        for firsts, words, data, bounds, starts, ends in self.shingler.words(column):
            text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
            at = self.begins(words, text)
            own, stop = self.own(data, firsts, starts)
            at, stop = np.r_[at, own], np.r_[at + self.length, stop]
            order = np.lexsort((stop, at))
            at, stop = at[order], stop[order]
            new = np.r_[True, (at[1:] != at[:-1]) | (stop[1:] != stop[:-1])] if len(at) else np.zeros(0, bool)
            at, stop = at[new], stop[new]
            shingles = self.shingler.rolled(words)
            yield done + text[at] if len(at) else at, at, stop, self.items(shingles, at, stop), shingles, (firsts, text, words, data, bounds, starts, ends, done)
            done += len(firsts) - 1

    def keys(self, shingles: np.ndarray, at: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """A key per unit and band: the smallest of each row's hashes over the shingles of the unit."""
        out, edges = [], np.stack([at, stop - self.width + 1], axis=1).ravel()
        low = np.full(len(shingles) + 1, ~np.uint64(0))
        hashed, moved = low[:-1], np.empty(len(shingles), np.uint64)
        with np.errstate(over="ignore"):
            for b in range(self.bands):
                key = np.full(len(at), b + 1, np.uint64)
                for seed in self.seeds[b * self.rows:(b + 1) * self.rows]:
                    np.multiply(shingles, seed, out=hashed)  # as mix() does, in place
                    for shift, factor in ((30, M2), (27, M3), (31, None)):
                        np.right_shift(hashed, np.uint64(shift), out=moved)
                        np.bitwise_xor(hashed, moved, out=hashed)
                        if factor is not None:
                            np.multiply(hashed, factor, out=hashed)
                    key = mix(key * M1 + np.minimum.reduceat(low, edges)[::2])
                out.append(key)
        return np.stack(out, axis=1)

    def lowest(self, words: np.ndarray, text: np.ndarray):
        """(hash of each run of ``gram`` words, the smallest of each window of ``length`` words, which windows lie in one text)."""
        value, n, count = self.part.rolled(words), self.length - self.gram + 1, max(0, len(words) - self.length + 1)
        if not count:
            return value, value[:0], np.zeros(0, bool)
        low, step = value, 1
        while step * 2 <= n:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        return value, np.minimum(low[:count], low[n - step:][:count]), text[:count] == text[self.length - 1:]

    def marks(self, words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, name) of the marks of all windows of ``length`` words."""
        value, low, inside = self.lowest(words, text)
        chosen = np.zeros(len(value), bool)
        for k in range(self.length - self.gram + 1):
            chosen[k:k + len(low)] |= inside & (value[k:k + len(low)] == low)
        at = np.flatnonzero(chosen)
        return at, value[at].view(np.int64)

    def windows(self, words: np.ndarray, text: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """First words of the windows of ``length`` words whose mark passes the filter."""
        _, low, inside = self.lowest(words, text)
        at = np.flatnonzero(inside)
        mark = low[at]
        new = np.r_[True, mark[1:] != mark[:-1]] if len(at) else inside  # neighbours mostly share their mark
        live = in_bloom(wanted, mark[new].view(np.int64)) if len(at) else inside
        return at[live[np.cumsum(new) - 1]] if len(at) else at


def bags(shingles: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct shingles of units one after another, where each begins, and how many it has."""
    sizes = end - at
    unit = np.repeat(np.arange(len(at)), sizes)
    values = shingles[np.arange(len(unit)) + np.repeat(at - (np.cumsum(sizes) - sizes), sizes)]
    order = np.lexsort((values, unit))
    unit, values = unit[order], values[order]
    new = np.r_[True, (unit[1:] != unit[:-1]) | (values[1:] != values[:-1])] if len(unit) else np.zeros(0, bool)
    unit, values = unit[new], values[new]
    starts = np.searchsorted(unit, np.arange(len(at)))
    return values, starts, np.diff(np.r_[starts, len(unit)])


def sketches(shingles: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many distinct shingles each unit has, and their parities on 16 places.

    Parities of units without a shingle twice are differences of running ones; the few others are sorted."""
    order = np.argsort(shingles)
    value = shingles[order]
    same = np.flatnonzero(value[1:] == value[:-1])
    twin = np.unique(np.r_[same, same + 1])
    twin = twin[np.lexsort((order[twin], value[twin]))]
    before = np.full(len(shingles) + 1, -1, np.int64)  # the place before where a shingle stands too
    again = value[twin][1:] == value[twin][:-1]
    before[order[twin][1:][again]] = order[twin][:-1][again]
    odd = np.zeros(len(shingles) + 1, np.uint64)
    np.bitwise_xor.accumulate(np.uint64(1) << (shingles >> np.uint64(60)), out=odd[1:])
    n, odd = end - at, odd[end] ^ odd[at]
    twice = np.flatnonzero(np.maximum.reduceat(before, np.stack([at, end], axis=1).ravel())[::2] >= at)
    for s in range(0, len(twice), 20_000):  # bounded scratch
        own = twice[s:s + 20_000]
        values, starts, n[own] = bags(shingles, at[own], end[own])
        odd[own] = np.bitwise_xor.reduceat(np.uint64(1) << (values >> np.uint64(60)), starts)
    return n, odd


def like(n, odd, m, other, threshold: int) -> np.ndarray:
    """Whether sets of at most ``n`` and ``m`` elements (at least that by ``SLACK``) can be similar: their sizes fit, and
    as each place where parities differ holds an element of one set only, few do."""
    fit = np.minimum(n, m) * (100 * SLACK) >= np.maximum(n, m) * float(threshold)
    return fit & (np.bitwise_count(odd ^ other) * (100.0 + threshold) <= (n + m) * float(100 - threshold))


def list_pairs(key: np.ndarray, n: np.ndarray, odd: np.ndarray, threshold: int):
    """Places of pairs within short lists (rows of one key stand together) that can be similar, in arrays (i, j), i < j."""
    for d in range(1, SHORT_LIST):
        i = np.flatnonzero(key[d:] == key[:-d])
        if not len(i):
            break
        i = i[like(n[i], odd[i], n[i + d], odd[i + d], threshold)]
        yield i, i + d


def tried(key: np.ndarray, item: np.ndarray, n: np.ndarray, odd: np.ndarray, threshold: int):
    """What lists (rows of one key stand together) leave to test: pairs (item, star) of a list's members with its first
    one, and the rows of lists in which other pairs can be similar too.

    Members of short lists that can be similar to no other leave first."""
    def sizes(key):
        edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        each = np.diff(np.r_[edge, len(key)])
        return np.repeat(edge, each), np.repeat(each, each)

    live = sizes(key)[1] > SHORT_LIST
    short = np.flatnonzero(~live)
    for pair in list_pairs(key[short], n[short], odd[short], threshold):
        for side in pair:
            live[short[side]] = True
    live = np.flatnonzero(live)
    key, n, odd = key[live], n[live], odd[live]
    first, size = sizes(key)
    more = size > SHORT_LIST
    short = np.flatnonzero(~more)
    for i, _ in list_pairs(key[short], n[short], odd[short], threshold):
        beyond = short[i][first[short[i]] != short[i]]
        more[first[beyond]] = True
    star = np.flatnonzero(like(n, odd, n[first], odd[first], threshold) & (first != np.arange(len(first))))
    return item[live[star]], item[live[first[star]]], live[more[first]]


def cover(start: np.ndarray, end: np.ndarray) -> list[int]:
    """Of spans sorted by start, longer ones first, few that cover the same stretches."""
    own = np.flatnonzero(np.r_[True, end[1:] > np.maximum.accumulate(end)[:-1]])  # those in no earlier one
    start, end, chosen, k = start[own], end[own], [], 0
    while k < len(own):
        chosen.append(int(own[k]))
        k = max(k + 1, int(np.searchsorted(start, end[k], side="left")) - 1)
    return chosen


def few(text: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Places of the first two texts of each item: more of them add nothing."""
    order = np.lexsort((text, item))
    i, t = item[order], text[order]
    new = np.r_[True, (i[1:] != i[:-1]) | (t[1:] != t[:-1])]
    order, i = order[new], i[new]
    return order[np.r_[True, True, i[2:] != i[:-2]][:len(i)]]


@scoped
def repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 75, length: int = 20,
            reach: int = 6, width: int = 5, least: int = 10) -> DataFrame:
    """Passages that repeat across documents, exactly or with ``threshold`` hundredths of their shingles.

    Exactly: every window of ``length`` words that two documents hold, and every own paragraph (line, or block between
    blank lines) of ``least`` to ``length - 1`` words. Windows are compared at each word, so rows together cover a
    repeated passage of ``length`` words or more from its first word to its last, wherever lines break.
    Nearly: own paragraphs of ``least`` words or more, as wholes, and windows that begin at content-defined words.

    One row per stretch: id, start, end (code points of the text, end exclusive), component_id (the smallest
    id among the documents of its component) and removed (true unless this is that document, so the stretch can go). A
    stretch is ``length`` words, or a shorter own paragraph; longer passages have several that overlap or follow
    one another. Exact stretches form a component with the documents that hold the same words.

    Shorter texts and paragraphs have no rows; what repeats only within one id is not reported, so repeated rows of an
    id alone are no repeats. Rows without an id are left out."""
    kind = dict(df.dtypes)[id_col]
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).where("id IS NOT NULL")
    # Documents by numbers in the order of their ids.
    numbers = None
    if kind in ("tinyint", "smallint", "int", "bigint"):
        rows = rows.select(F.col("id").cast("long").alias("id"), "text")
    else:
        numbers = Written(rows.select("id").distinct().orderBy("id").withColumn("number", F.monotonically_increasing_id()), "paragraph-ids")
        rows = Written(rows.join(numbers.df, "id").select(F.col("number").alias("id"), "text"), "paragraph-rows").df
    chars = int(rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0])
    bands, band_rows = tune(threshold / 100)
    buckets = max(256, -(-int(chars / 6 / (reach * 2) * (bands + 1) * 1.5) // BUCKET))
    # Plain values only: each task builds its own cutter.
    setting = dict(length=length, reach=reach, width=width, bands=bands, rows=band_rows, least=least)

    def post(batches):
        import pyarrow as pa

        cut, lists, exact, seen = Paragraphs(**setting), Packer(buckets, ["<i8", "u1", "<u2"]), Packer(buckets, ["<i8"]), Recent()
        names, kinds, edges = ["bucket", "keys", "items", "odds", "marks"], [pa.int32(), *[pa.binary()] * 4], size_edges()

        def packed():
            # The last byte of a key's name gives way to the class of the size.
            rows = [(b, (np.frombuffer(key, "<u4") & 0xFFFFFF00 | np.frombuffer(size, "u1")).astype("<u4").tobytes(), item, odd, None)
                    for b, (key, item, size, odd) in lists.pack()]
            rows += [(b, None, None, None, cells[1]) for b, cells in exact.pack()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for _, at, stop, items, shingles, (_, text, words, *_) in cut.chunks(batch.column(1)):
                new = seen.fresh(items)
                if len(new):
                    own, end = at[new], stop[new] - width + 1
                    n, odd = sketches(shingles, own, end)
                    size = np.searchsorted(edges, n, side="right") - 1
                    lists.add(cut.keys(shingles, own, stop[new]).ravel(), *(np.repeat(c, bands) for c in (items[new], size, odd)))
                first, mark = cut.marks(words, text)
                if len(mark):
                    mark = mark[few(text[first], mark)]
                    exact.add(mark.view(np.uint64), mark)
                if lists.full() or exact.full():
                    yield packed()
        if lists.count or exact.count:
            yield packed()

    def gather(batches):
        import pyarrow as pa

        held, bucket, most = {False: [], True: []}, None, np.r_[size_edges()[1:] - 1, 1 << 40]

        def out():
            made = []
            if held[False]:
                key, item, odd = (np.concatenate([np.frombuffer(c[k], t) for c in held[False]]) for k, t in enumerate(("<u4", "<i8", "<u2")))
                at = repeated(key >> 8, item)
                key, item, n, odd = key[at] >> 8, item[at], most[key[at] & 255], odd[at]
                a, b, left = tried(key, item, n, odd, threshold)
                made += [(0, a, 0, 0, b, PAIR), (bucket << 32 | key[left].astype(np.int64), item[left], n[left], odd[left], 0, LIST)]
            if held[True]:
                mark = np.sort(np.concatenate([np.frombuffer(c[3], "<i8") for c in held[True]]))
                made.append((0, np.unique(mark[1:][mark[1:] == mark[:-1]]), 0, 0, 0, MARK))
            made = [np.concatenate([np.broadcast_to(np.asarray(m[k], np.int64), len(m[1])) for m in made]) for k in range(6)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in made], names=["key", "item", "n", "bits", "star", "kind"])

        for batch in batches:
            for b, *cells in zip(*(c.to_pylist() for c in batch.columns)):
                if b != bucket and bucket is not None:
                    yield out()
                    held = {False: [], True: []}
                bucket = b
                held[cells[3] is not None].append(cells)
        if bucket is not None:
            yield out()

    posted = rows.mapInArrow(post, "bucket int, keys binary, items binary, odds binary, marks binary")
    met = posted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(gather, "key long, item long, n long, bits long, star long, kind long")
    found = Written(met, "paragraph-lists", by=("kind",))
    lists, pairs, marks = (found.df.where(F.col("kind") == kind) for kind in (LIST, PAIR, MARK))
    same = _same(rows, bloom(marks.select("item")), chars, setting)
    wanted = bloom(pairs.select(F.explode(F.array("item", "star")).alias("item")).union(lists.select("item")))

    def tokens(batches):
        """(item, tokens) of each unit that the filter lets through, once a task."""
        import pyarrow as pa

        cut, seen = Paragraphs(**setting), Recent()
        for batch in batches:
            for _, at, stop, items, shingles, _ in cut.chunks(batch.column(0)):
                live = np.flatnonzero(in_bloom(wanted, items)) if len(at) else at
                live = live[seen.fresh(items[live])]
                for s in range(0, len(live), 20_000):  # bounded scratch
                    own = live[s:s + 20_000]
                    values, starts, sizes = bags(shingles, at[own], stop[own] - width + 1)
                    told = [values[a:a + n].tobytes() for a, n in zip(starts.tolist(), sizes.tolist())]
                    yield pa.RecordBatch.from_arrays([pa.array(items[own]), pa.array(told, pa.binary())], names=["item", "tokens"])

    made = rows.select("text").mapInArrow(tokens, "item long, tokens binary")
    sets = Written(made.groupBy("item").agg(F.first("tokens").alias("tokens")), "paragraph-sets")
    stars = pairs.select(F.col("item").alias("a"), F.col("star").alias("b")).distinct()
    linked = connect(lists.drop("star", "kind"), stars, sets, threshold, "paragraph", slack=SLACK)
    found.drop()
    sets.drop()
    members = linked.df.select(F.col("node").alias("item"), "component")

    def place(wanted):
        def find(batches):
            import pyarrow as pa

            cut, tag = Paragraphs(**setting), _tags()
            for batch in batches:
                ids, tags = batch.column(0), tag(len(batch))
                for text, at, stop, items, _, (*_, data, bounds, starts, ends, _) in cut.chunks(batch.column(1)):
                    live = np.flatnonzero(in_bloom(wanted, items)) if len(at) else at
                    if not len(live):
                        continue
                    # Longer units as stretches of ``length`` words; the last ends where the unit does.
                    parts = np.maximum(1, -(-(stop[live] - at[live]) // length))
                    part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
                    live = np.repeat(live, parts)
                    first = np.maximum(at[live], np.minimum(at[live] + part * length, stop[live] - length))
                    last = np.minimum(first + length, stop[live]) - 1
                    begin, end = _points(data, bounds, starts[first], ends[last])
                    yield pa.RecordBatch.from_arrays([
                        ids.take(pa.array(text[live])), pa.array(tags[text[live]]), pa.array(items[live]), pa.array(begin), pa.array(end),
                    ], names=["id", "tag", "item", "start", "end"])
        return find

    placed = rows.mapInArrow(place(bloom(members.select("item"))), "id long, tag long, item long, start long, end long")
    spots = Written(placed.join(members, "item").select("id", "tag", "start", "end", "component"), "paragraph-spots")
    across = spots.df.groupBy("component").agg(F.min("id").alias("component_id"), F.max("id").alias("last")).where("component_id < last")
    near = spots.df.join(across, "component").select("id", "tag", "start", "end", "component_id")
    all_spots = near.union(same).dropDuplicates().select("id", "start", "end", "component_id", (F.col("id") > F.col("component_id")).alias("removed"))
    if numbers is None:
        named = all_spots.withColumns({c: F.col(c).cast(kind) for c in ("id", "component_id")})
    else:
        side = lambda c: numbers.df.select(F.col("number").alias(c), F.col("id").alias(f"{c}_named"))
        named = all_spots.join(side("id"), "id").join(side("component_id"), "component_id")
        named = named.select(F.col("id_named").alias("id"), "start", "end", F.col("component_id_named").alias("component_id"), "removed")
    return named.withColumnRenamed("id", id_col)


def _tags():
    """Numbers for the rows of a task, so that rows of one id stay apart."""
    from pyspark import TaskContext

    context, done = TaskContext.get(), 0
    base = (context.partitionId() if context else 0) << 40

    def tag(n: int) -> np.ndarray:
        nonlocal done
        done += n
        return base + np.arange(done - n, done, dtype=np.int64)

    return tag


def _points(data: np.ndarray, bounds: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a chunk as code points counted from the beginning of each text."""
    more = np.flatnonzero((data & 0xC0) == 0x80)  # bytes that go on with a code point
    begin = bounds[np.searchsorted(bounds, starts, side="right") - 1]
    begin, starts, ends = (x - np.searchsorted(more, x) for x in (begin, starts, ends))
    return starts - begin, ends - begin


def _same(rows: DataFrame, wanted: np.ndarray, chars: int, setting: dict) -> DataFrame:
    """(id, tag, start, end, component_id) of what repeats exactly.

    ``wanted`` is a filter of the marks of two texts or more. Windows whose mark passes, and short own paragraphs,
    meet by their words; those of two documents go back to their document, where few of them cover what all do."""
    buckets = max(256, -(-int(chars / 6) // (BUCKET // 2)))
    columns = ["<i8", "<i8", "<i8", "<u4", "<u4"]
    cells = [f"c{k}" for k in range(6)]
    schema = "bucket int, " + ", ".join(f"{c} binary" for c in cells)

    def batch_of(packed):
        import pyarrow as pa

        rows = [(b, *c) for b, c in packed]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if not k else pa.binary()) for k, c in enumerate(zip(*rows))], names=["bucket", *cells])

    def post(batches):
        cut, packer, tag = Paragraphs(**setting), Packer(buckets, columns), _tags()
        for batch in batches:
            ids, tags = batch.column(0).to_numpy(zero_copy_only=False), tag(len(batch))
            for firsts, words, data, bounds, starts, ends in cut.shingler.words(batch.column(1)):
                text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
                at = cut.windows(words, text, wanted)
                item = cut.whole.rolled(words)[at].view(np.int64) if len(at) else at
                own, stop = cut.own(data, firsts, starts)
                short = stop - own < cut.length
                own, stop = own[short], stop[short]
                more = cut.items(cut.shingler.rolled(words), own, stop)
                at, item, stop = np.r_[at, own], np.r_[item, more], np.r_[at + cut.length, stop]
                if len(at):
                    begin, end = _points(data, bounds, starts[at], ends[stop - 1])
                    packer.add(item.view(np.uint64), item, ids[text[at]], tags[text[at]], begin, end)
                ids, tags = ids[len(firsts) - 1:], tags[len(firsts) - 1:]
                if packer.full():
                    yield batch_of(packer.pack())
        if packer.count:
            yield batch_of(packer.pack())

    def by_bucket(finish):
        def run(batches):
            held, bucket = [], None
            for batch in batches:
                for b, *own in zip(*(c.to_pylist() for c in batch.columns)):
                    if b != bucket and held:
                        yield from finish(held)
                        held = []
                    bucket = b
                    held.append(own)
            if held:
                yield from finish(held)
        return run

    def arrays(held):
        return [np.concatenate([np.frombuffer(c[k + 1], t) for c in held]) for k, t in enumerate(columns)]

    def meet(held):
        item, doc, tag, start, end = arrays(held)
        held.clear()
        order = np.lexsort((doc, item))
        i, d = item[order], doc[order]
        starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
        sizes = np.diff(np.r_[starts, len(i)])
        low, high = d[starts], d[starts + sizes - 1]
        live = np.repeat(low < high, sizes)
        order, low = order[live], np.repeat(low, sizes)[live]
        if len(order):
            packer = Packer(buckets, columns)
            packer.add(doc[order].view(np.uint64), low, doc[order], tag[order], start[order], end[order])
            yield batch_of(packer.pack())

    def covered(held):
        import pyarrow as pa

        low, doc, tag, start, end = arrays(held)
        held.clear()
        order = np.lexsort((-end.astype(np.int64), start, low, tag, doc))
        low, doc, tag, start, end = (x[order] for x in (low, doc, tag, start, end))
        edge = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (low[1:] != low[:-1])])
        at = [a + k for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(doc)]) for k in cover(start[a:b], end[a:b])]
        kept = (x[at].astype(np.int64) for x in (doc, tag, start, end, low))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in kept], names=["id", "tag", "start", "end", "component_id"])

    met = rows.mapInArrow(post, schema).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(by_bucket(meet), schema)
    home = met.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(by_bucket(covered), "id long, tag long, start long, end long, component_id long")
    return Written(home, "paragraph-same").df

"""Token ids in binary shards, reached by key through a minimal perfect hash index.

File formats (all numbers little-endian).

Shard ``shard-NNNNNN.bin``: magic ``IDSHARD1``, u64 rows, u64 ids, u64 width; then the ids of all rows, ``width`` bytes
each (2 if the vocabulary has at most 65,536 ids, else 4); then rows + 1 offsets (u64, in ids). Rows stand in ascending
key order, shards follow one another in that order.

Index ``index-NNNNNN.bin``: magic ``IDINDEX1``, u64 keys, u64 levels; the number of bits of each level (u64); the bits
of all levels, packed (padded to 64); one rank (u64) per 512 bits; then one slot per key, of 32 bytes: u32
fingerprint, u32 first shard, u64 first row, u32 last shard, u32 zero, u64 last row (inclusive).
"""

from __future__ import annotations

import os
import re

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortica.llm.common import Written, runs
from cohortica.llm.postings import Shingler
from cohortica.workspace import fresh_path

SHARD_MAGIC, INDEX_MAGIC = b"IDSHARD1", b"IDINDEX1"
SLOT = np.dtype([("mark", "<u4"), ("shard", "<u4"), ("row", "<u8"), ("last_shard", "<u4"), ("zero", "<u4"), ("last_row", "<u8")])
# Chunks that a task remembers; the memory is emptied beyond that.
MEMORY = 1_000_000


def open_store(path: str):
    """(file system, path within it) for any store that Arrow reaches; plain paths are local."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def write_file(path: str, parts) -> None:
    """Write under a name of this attempt, then rename: a repeated task replaces the file by an equal one."""
    store, at = open_store(path)
    store.create_dir(os.path.dirname(at), recursive=True)
    context = TaskContext.get()
    draft = f"{at}.{context.taskAttemptId() if context else 0}.tmp"
    with store.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
    store.move(draft, at)


def mix(keys: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of each key, another one for each level."""
    with np.errstate(over="ignore"):
        z = keys + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash by levels: keys alone at their place of a level get it, the others go on to the next.

    A key's number is the count of taken places before its own."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, ranks: np.ndarray):
        self.sizes, self.bits, self.ranks = sizes, bits, ranks
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.uint64)

    @staticmethod
    def build(keys: np.ndarray, room: float = 2.0) -> "PerfectHash":
        """``keys``: distinct u64."""
        sizes, levels, left = [], [], keys
        while len(left):
            size = int(max(64, -(-len(left) * room // 64) * 64))
            place = (mix(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[place]]
            if len(sizes) > 200:
                raise ValueError("keys are not distinct")
        bits = np.concatenate(levels) if levels else np.zeros(0, bool)
        bits = np.concatenate([bits, np.zeros(-len(bits) % 512, bool)])
        counts = bits.reshape(-1, 512).sum(axis=1)
        ranks = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else np.zeros(0)
        return PerfectHash(np.array(sizes, np.uint64), np.packbits(bits, bitorder="little"), ranks.astype(np.uint64))

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for some of the keys that were never given (others get any number)."""
        found, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = (mix(keys[left], level) % size + self.starts[level]).astype(np.int64)
            hit = (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            found[left[hit]] = self._rank(at[hit])
            left = left[~hit]
        return found

    def _rank(self, at: np.ndarray) -> np.ndarray:
        block = at >> 9
        words = self.bits.reshape(-1, 64)[block]  # 64 bytes hold the 512 bits of a rank
        before = np.arange(64)[None, :] < ((at >> 3) & 63)[:, None]
        ones = np.bitwise_count(words)
        within = (ones * before).sum(axis=1)
        own = words[np.arange(len(at)), (at >> 3) & 63] & ((1 << (at & 7).astype(np.uint16)) - 1).astype(np.uint8)
        return self.ranks[block].astype(np.int64) + within + np.bitwise_count(own)


def index_bytes(keys: np.ndarray, marks: np.ndarray, shard, row, last_shard, last_row) -> list[bytes]:
    table = PerfectHash.build(keys)
    slots = np.zeros(len(keys), SLOT)
    at = table.lookup(keys)
    for name, values in (("mark", marks), ("shard", shard), ("row", row), ("last_shard", last_shard), ("last_row", last_row)):
        slots[name][at] = values
    head = np.array([len(keys), len(table.sizes)], "<u8").tobytes()
    return [INDEX_MAGIC, head, table.sizes.astype("<u8").tobytes(), table.bits.tobytes(), table.ranks.astype("<u8").tobytes(), slots.tobytes()]


class IndexFile:
    """One index file; holds a bounded number of keys, so it is read whole."""

    def __init__(self, path: str):
        store, at = open_store(path)
        with store.open_input_file(at) as f:
            data = f.read()
        if data[:8] != INDEX_MAGIC:
            raise ValueError(f"{path} is no index")
        n, levels = (int(x) for x in np.frombuffer(data, "<u8", 2, 8))
        sizes = np.frombuffer(data, "<u8", levels, 24)
        at, bits = 24 + 8 * levels, -(-int(sizes.sum()) // 512) * 512
        packed = np.frombuffer(data, np.uint8, bits // 8, at)
        ranks = np.frombuffer(data, "<u8", bits // 512, at + bits // 8)
        self.slots = np.frombuffer(data, SLOT, n, at + bits // 8 + bits // 64)
        self.table = PerfectHash(sizes, packed, ranks)

    def find(self, keys: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which keys are held, their slots): the stored fingerprint turns others away."""
        at = self.table.lookup(keys)
        known = at >= 0
        known[known] = self.slots["mark"][at[known]] == marks[known]
        return known, self.slots[at[known]]


class ShardFile:
    """Random access to one shard: the header and any stretch of rows."""

    HEAD = 32

    def __init__(self, path: str):
        store, at = open_store(path)
        self.file = store.open_input_file(at)
        head = self.file.read_at(self.HEAD, 0)
        if head[:8] != SHARD_MAGIC:
            raise ValueError(f"{path} is no shard")
        self.rows, self.ids, self.width = (int(x) for x in np.frombuffer(head, "<u8", 3, 8))

    def offsets(self, first: int, last: int) -> np.ndarray:
        """Offsets of rows first to last and of the row after."""
        return np.frombuffer(self.file.read_at(8 * (last - first + 2), self.HEAD + self.width * self.ids + 8 * first), "<u8").astype(np.int64)

    def payload(self, start: int, end: int) -> np.ndarray:
        """Ids as u32."""
        data = self.file.read_at(self.width * (end - start), self.HEAD + self.width * start)
        return np.frombuffer(data, f"<u{self.width}").astype("<u4")

    def close(self) -> None:
        self.file.close()


class ChunkEncoder:
    """Ids of whole texts by the tokenizers library.

    The tokenizer drops white space and never joins across it, and it parts letters from marks. So texts are cut at ASCII
    white space and before the ASCII marks that end a chunk after a letter; each distinct piece (named by a 64-bit hash)
    is encoded once while it is remembered."""

    # No apostrophe, which may begin a suffix, and no bracket of a special token.
    MARKS = b"!#$%&*+,./:;=?@|~-"

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.cutter = Tokenizer.from_file(path), Shingler(fold=False)
        self.cutter.CHUNK = 1 << 21
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.mark = np.isin(np.arange(256), np.frombuffer(self.MARKS, np.uint8))
        self.letter = np.array([chr(c).isalpha() and c < 128 for c in range(256)])
        # Letters that neither normal form nor case folding can join with others.
        self.plain = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
        self._forget()

    def _forget(self) -> None:
        """Numbers of known pieces by hash; ids of all of them in one array, with starts and sizes by number."""
        self.numbers = {}
        self.ids, self.starts, self.sizes = np.zeros(1 << 16, f"<u{self.width}"), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.used = 0

    def encode(self, column, end_id: int):
        """(ids per text with the end id, all those ids) for stretches of an Arrow string column, in order."""
        for firsts, _, data, _, starts, ends in self.cutter.words(column, hashed=False):
            if len(self.numbers) > MEMORY or self.used > 8 * MEMORY:
                self._forget()
            firsts, words, starts, ends = self._without_marks(firsts, data, starts, ends)
            distinct, first, place = np.unique(words, return_index=True, return_inverse=True)
            get = self.numbers.get
            number = np.array([get(h, -1) for h in distinct.tolist()], np.int64)
            new = np.flatnonzero(number < 0)
            if len(new):
                at, raw = first[new], data.tobytes()
                number[new] = self._learn(distinct[new], [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts[at].tolist(), ends[at].tolist())])
            own = number[place]
            size = self.sizes[own]
            total = np.r_[0, np.cumsum(size)]
            source = np.repeat(self.starts[own] - total[:-1], size) + np.arange(total[-1])
            bounds = total[firsts]  # ids before each text
            texts = len(firsts) - 1
            out = np.full(total[-1] + texts, end_id, self.ids.dtype)
            out[np.arange(total[-1]) + np.repeat(np.arange(texts), np.diff(bounds))] = self.ids[source]
            yield np.diff(bounds) + 1, out

    def _without_marks(self, firsts, data, starts, ends):
        """The chunks with marks that end them after a letter cut off, as pieces of their own."""
        if not len(starts):
            return firsts, np.zeros(0, np.uint64), starts, ends
        last = np.maximum.accumulate(np.where(self.mark[data], -1, np.arange(len(data))))[ends - 1]
        cut = (last >= starts) & (last < ends - 1)
        cut[cut] = self.letter[data[last[cut]]]
        piece = np.repeat(np.arange(len(starts)), 1 + cut)
        tail = np.r_[False, piece[1:] == piece[:-1]]
        head = np.r_[tail[1:], False]
        begin, stop = starts[piece], ends[piece]
        begin[tail], stop[head] = last[piece[tail]] + 1, last[piece[head]] + 1
        return np.r_[0, np.cumsum(1 + cut)][firsts], self.cutter.hashed(data, begin, stop), begin, stop

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> np.ndarray:
        """Numbers for new pieces. Words of plain letters go many to a text: the library tells which word an id is of."""
        plain = np.array([self.plain(c) is not None for c in pieces])
        number, known = np.zeros(len(pieces), np.int64), len(self.numbers)
        order = np.r_[np.flatnonzero(plain), np.flatnonzero(~plain)]
        number[order] = known + np.arange(len(pieces))
        ids, sizes, words = [], [], [pieces[k] for k in order[: plain.sum()]]
        for s in range(0, len(words), 4000):
            e = self.tokenizer.encode(" ".join(words[s:s + 4000]), add_special_tokens=False)
            ids.append(np.array(e.ids, self.ids.dtype))
            sizes.append(np.bincount(_ranks(np.array(e.word_ids))))
            if len(sizes[-1]) != len(words[s:s + 4000]):
                raise ValueError("the tokenizer does not keep words apart")
        rest = [pieces[k] for k in order[plain.sum():]]
        for s in range(0, len(rest), 20_000):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(rest[s:s + 20_000], add_special_tokens=False)]
            ids.append(np.array([i for own in found for i in own], self.ids.dtype))
            sizes.append(np.array([len(own) for own in found], np.int64))
        sizes = np.concatenate(sizes)
        need = self.used + int(sizes.sum())
        while len(self.ids) < need:
            self.ids = np.r_[self.ids, np.zeros_like(self.ids)]
        while len(self.starts) < known + len(pieces):
            self.starts, self.sizes = (np.r_[x, np.zeros_like(x)] for x in (self.starts, self.sizes))
        own = slice(known, known + len(pieces))
        self.ids[self.used:need] = np.concatenate(ids)
        self.starts[own], self.sizes[own] = self.used + np.cumsum(sizes) - sizes, sizes
        self.used = need
        self.numbers.update(zip(hashes.tolist(), number.tolist()))
        return number


def _ranks(sorted_values: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... for each run of equal values."""
    return np.cumsum(np.r_[False, sorted_values[1:] != sorted_values[:-1]])


def write_shards(df: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 1, shard_chars: int = 64_000_000, index_keys: int = 100_000) -> DataFrame:
    """Encode every whole text, write shards and index files into ``folder``, return the manifest.

    Rows are ordered by key (null first), equal keys by a hash of the text. Null texts count as empty; each row ends
    with ``end_id``. The manifest has a row per shard: shard, rows, ids, base (ids of all shards before). It is also
    written to ``folder``/manifest, with the number of index files."""
    spark = df.sparkSession
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("key"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    size, n = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0)), F.count("*")).first()
    shards, indexes = max(1, -(-int(size) // shard_chars)), max(1, -(-n // index_keys))
    ordered = rows.withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange(shards, F.asc_nulls_first("key"), "tie").sortWithinPartitions(F.asc_nulls_first("key"), "tie").select("key", "text")

    def write(batches):
        import pyarrow as pa

        shard, encoder = TaskContext.get().partitionId(), ChunkEncoder(tokenizer)
        payload, sizes, row = [], [np.zeros(1, np.int64)], 0
        for batch in batches:
            at = 0
            for own, ids in encoder.encode(batch.column(1), end_id):
                payload.append(ids.tobytes())
                sizes.append(own)
                keys = batch.column(0).slice(at, len(own))
                at += len(own)
                yield pa.RecordBatch.from_arrays([keys, pa.array(np.full(len(own), shard, np.int32)), pa.array(row + np.arange(len(own))), pa.array(own)], names=["key", "shard", "row", "n"])
                row += len(own)
        offsets = np.cumsum(np.concatenate(sizes))
        head = np.array([len(offsets) - 1, offsets[-1], encoder.width], "<u8").tobytes()
        write_file(f"{folder}/shard-{shard:06d}.bin", [SHARD_MAGIC, head, *payload, offsets.astype("<u8").tobytes()])

    entries = Written(ordered.mapInArrow(write, "key long, shard int, row long, n long"), "id-entries")
    mark = F.xxhash64(F.lit(1), "key").bitwiseAND(0xFFFFFFFF)
    extents = (
        entries.df.groupBy("key").agg(F.min(F.struct("shard", "row")).alias("a"), F.max(F.struct("shard", "row")).alias("b"))
        .select(*_hashes(indexes), mark.alias("mark"), "a.shard", "a.row", F.col("b.shard").alias("last_shard"), F.col("b.row").alias("last_row"))
    )

    def build(batches):
        for pdf, starts in runs(batches, ["index"]):
            for s, e in zip(starts, [*starts[1:], len(pdf)]):
                own = pdf.iloc[s:e]
                write_file(f"{folder}/index-{own['index'].iloc[0]:06d}.bin", index_bytes(
                    own["hash"].to_numpy().astype(np.uint64), *(own[c].to_numpy() for c in ("mark", "shard", "row", "last_shard", "last_row"))))
                yield pd.DataFrame({"index": own["index"].iloc[:1], "keys": [e - s]})

    extents.repartition("index").sortWithinPartitions("index").mapInPandas(build, "index int, keys long").agg(F.sum("keys")).collect()
    totals = entries.df.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("n").alias("ids"))
    # One row per shard of bounded size; the window holds these totals only.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0))).withColumn("indexes", F.lit(indexes)).write.parquet(f"{folder}/manifest")
    entries.drop()
    return spark.read.parquet(f"{folder}/manifest")


def _hashes(indexes: int):
    """Hash and index file of a key. The hash maps distinct numbers to distinct values; null has an index file of its own."""
    h = F.xxhash64("key")
    return [h.alias("hash"), F.when(F.col("key").isNull(), F.lit(indexes)).otherwise(F.pmod(F.shiftright(h, 7), F.lit(indexes))).cast("int").alias("index")]


def read_rows(keys: DataFrame, folder: str, id_col: str = "doc_id") -> DataFrame:
    """Rows of the given keys, read from the files: key, shard, row, start, n_tokens, ids (bytes of u32).

    ``keys`` are looked up in the index files of their hashes, then read from the shards they name. Keys that the
    files do not hold give no rows; repeated keys are looked up once; a key that several rows share gives them all."""
    spark = keys.sparkSession
    manifest = spark.read.parquet(f"{folder}/manifest").select("shard", "rows", "base", "indexes")
    top = manifest.agg(F.max("indexes")).first()[0]
    empty = "key long, shard int, row long, start long, n_tokens long, ids binary"
    if top is None:
        return spark.createDataFrame([], empty).withColumnRenamed("key", id_col)
    asked = keys.select(F.col(f"`{id_col}`").cast("long").alias("key")).distinct()
    asked = asked.select("key", *_hashes(top), F.xxhash64(F.lit(1), "key").bitwiseAND(0xFFFFFFFF).alias("mark"))

    def find(batches):
        held = (None, None)
        for pdf in batches:
            for i, own in pdf.groupby("index", sort=False):
                if held[0] != i:
                    path = f"{folder}/index-{i:06d}.bin"
                    store, at = open_store(path)
                    held = (i, IndexFile(path) if store.get_file_info(at).is_file else None)
                if held[1] is None:
                    continue
                known, slots = held[1].find(own["hash"].to_numpy().astype(np.uint64), own["mark"].to_numpy().astype(np.uint32))
                if known.any():
                    yield pd.DataFrame({"key": own["key"].to_numpy()[known], "index": i, **{c: slots[c].astype(np.int64) for c in ("shard", "row", "last_shard", "last_row")}})

    text = asked.withColumn("key", F.col("key").cast("string"))
    extents = text.repartition("index").sortWithinPartitions("index").mapInPandas(
        find, "key string, index int, shard long, row long, last_shard long, last_row long").withColumn("key", F.col("key").cast("long"))
    spread = extents.withColumn("at", F.explode(F.sequence("shard", "last_shard"))).select(
        "key", F.col("at").cast("int").alias("shard"), F.when(F.col("at") == F.col("shard"), F.col("row")).otherwise(F.lit(0)).alias("first"),
        F.when(F.col("at") == F.col("last_shard"), F.col("last_row")).alias("last"))
    placed = spread.join(manifest.select("shard", "rows", "base"), "shard").select(
        "key", "shard", "first", F.coalesce("last", F.col("rows") - 1).alias("last"), "base").repartition("shard").sortWithinPartitions("shard", "first")

    def read(batches):
        import pyarrow as pa

        held, name = None, None
        for batch in batches:
            key, shard, first, last, base = (batch.column(c).to_pylist() for c in range(5))
            out, size = [], 0
            for k, s, a, b, low in zip(key, shard, first, last, base):
                if name != s:
                    if held:
                        held.close()
                    held, name = ShardFile(f"{folder}/shard-{s:06d}.bin"), s
                for c in range(a, b + 1, 4096):  # a key of many rows is read in stretches
                    offsets = held.offsets(c, min(b, c + 4095))
                    data = held.payload(offsets[0], offsets[-1])
                    for i in range(len(offsets) - 1):
                        own = data[offsets[i] - offsets[0]:offsets[i + 1] - offsets[0]]
                        out.append((k, s, c + i, low + int(offsets[i]), len(own), own.tobytes()))
                        size += 4 * len(own)
                    if size > 8_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=names)
                        out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=names)
        if held:
            held.close()

    names = ["key", "shard", "row", "start", "n_tokens", "ids"]
    import pyarrow as pa

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return placed.mapInArrow(read, empty).withColumnRenamed("key", id_col)


def round_trip(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all rows of ``df`` to a new folder, then read every key back: id, start, n_tokens, ids_crc32 per row."""
    folder = fresh_path(df.sparkSession, "id-files")
    write_shards(df, tokenizer, folder, id_col, text_col)
    return read_rows(df, folder, id_col).select(id_col, "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

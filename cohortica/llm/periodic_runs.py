"""Periodic runs of words by seeds on diagonals, extended once each."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortica.llm.common import slices

BLANKS = "[\\x20\\x09-\\x0D]+"
# Words of several texts that are searched together; a longer text is searched alone.
WORDS = 200_000
NOT_SEEN = np.int64(-1)


def words_of(text: Column) -> Column:
    """The words of a text (runs of anything but ASCII white space); none of a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def paired(a: np.ndarray, shift: int, b: np.ndarray) -> np.ndarray:
    """Names of the joined grams a[i] b[i + shift] that occur twice or more, by value; ``NOT_SEEN`` for the others."""
    out = np.full(len(a), NOT_SEEN)
    n = len(a) - shift
    if n <= 0:
        return out
    live = np.flatnonzero((a[:n] != NOT_SEEN) & (b[shift:] != NOT_SEEN))
    # Names are below the number of words, so the pair fits 64 bits.
    out[live] = again(a[live] * np.int64(len(a) + 1) + b[live + shift])
    return out


def again(keys: np.ndarray) -> np.ndarray:
    """A small name for each key that occurs twice or more, ``NOT_SEEN`` for the others."""
    if not len(keys):
        return keys
    _, name, count = np.unique(keys, return_inverse=True, return_counts=True)
    return np.where(count[name] > 1, name, NOT_SEEN)


def agreement(w: np.ndarray, i: int, lag: int, step: int, stop: int) -> int:
    """How many places from ``i`` on, in the direction of ``step``, hold the same word ``lag`` later; ``stop`` is the first
    place beyond the text. Looks ahead in growing stretches."""
    found, size = 0, 16
    while True:
        left = (stop - i) * step - found
        if left <= 0:
            return found
        at = i + step * (found + np.arange(min(size, left)))
        differs = np.flatnonzero(w[at] != w[at + lag])
        if len(differs):
            return found + int(differs[0])
        found += len(at)
        size *= 4


def find_runs(w: np.ndarray, bounds: np.ndarray, least: int = 6, times: int = 4) -> np.ndarray:
    """(start, length, period) of all runs in texts that stand one after another: ``w`` names words, text k holds
    ``bounds[k]:bounds[k + 1]``, and no word has one name in two texts. Sorted by start, then period.

    A run of period q repeats at least ``(times - 1) * q`` words (and ``least - q``) one period later: that is the
    guaranteed overlap. Periods are searched in classes from p to 2p - 1, with seeds of the smallest overlap of any
    period from p on, at least 2p words for three times. Such a seed is no shorter than the period, so (Fine and Wilf) its next
    occurrence in the run lies exactly one period on: it is enough to pair each occurrence with the next, and the lag
    of a pair whose stretch is long enough is its smallest period. Only seeds that repeat are named, from shorter
    seeds that repeat. Each lag remembers how far it is covered: seeds within an earlier extension are not extended."""
    assert times >= 3, "seeds are as long as the period from three times on"
    out, p, longest = [], 1, int(np.diff(bounds).max(initial=0))
    half, names = 1, again(w)
    while max(least, times * p) <= longest:
        size = min(max(least - q, (times - 1) * q) for q in range(p, p + least + 1))
        while 2 * half < size:
            half, names = 2 * half, paired(names, half, names)
        gram = paired(names, size - half, names) if size > half else names
        live = np.flatnonzero(gram != NOT_SEEN)
        if not len(live):
            break
        live = live[np.argsort(gram[live], kind="stable")]
        lag = np.diff(live)
        seed = (gram[live][1:] == gram[live][:-1]) & (lag >= p) & (lag < 2 * p)
        seeds, lag = live[:-1][seed], lag[seed]
        order = np.lexsort((seeds, lag))
        seeds, lag = seeds[order], lag[order]
        text, ends = np.searchsorted(bounds, seeds, side="right") - 1, np.searchsorted(lag, lag, side="right")
        k = 0
        while k < len(seeds):
            i, q = int(seeds[k]), int(lag[k])
            first, stop = int(bounds[text[k]]), int(bounds[text[k] + 1])
            back = agreement(w, i - 1, q, -1, first - 1)
            covered = i + size + agreement(w, i + size, q, 1, stop - q)
            if covered + q - (i - back) >= max(least, times * q):
                out.append((i - back, covered + q - (i - back), q))
            # Seeds of this lag before the first place that differs lie in the stretch just found.
            k = max(k + 1, k + int(np.searchsorted(seeds[k:ends[k]], covered)))
        p *= 2
    found = np.array(out, np.int64).reshape(-1, 3)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def search(texts: list, least: int, times: int):
    """Per text its words and its runs, with starts counted from its first word; some ``WORDS`` words at a time."""
    held, size = [], 0

    def flush():
        bounds = np.cumsum([0, *map(len, held)])
        flat = np.empty(bounds[-1], object)
        flat[:] = [w for words in held for w in words]
        w = pd.factorize(flat)[0].astype(np.int64) + np.repeat(np.arange(len(held)), np.diff(bounds)) * (len(flat) + 1)
        found = find_runs(w, bounds, least, times)
        cuts = np.searchsorted(found[:, 0], bounds)
        for k, words in enumerate(held):
            yield words, found[cuts[k]:cuts[k + 1]] - np.array([bounds[k], 0, 0])

    for text in texts:
        words = (text or "").encode().split()
        if held and size + len(words) > WORDS:
            yield from flush()
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield from flush()


def collapse(words: list, runs: np.ndarray) -> str:
    """The words without those that a run holds after its first period, joined by a space."""
    if len(runs):
        gone = np.zeros(len(words), bool)
        for start, length, period in runs:
            gone[start + period:start + length] = True
        words = [words[k] for k in np.flatnonzero(~gone)]
    return b" ".join(words).decode()


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """Stretches of words that repeat with a period, and each text without the repetitions.

    One row per input row: id, n_words, runs (array of start, length, period; by start, then period) and collapsed. A run
    is a stretch of at least ``least`` words and ``times`` times its smallest period that no neighbouring word extends.
    ``collapsed`` holds the words that no run has after its first period, joined by one space. Texts are searched where they
    are read, whole: nothing is shuffled.

    A null or empty text and one of blanks alone has no words, no runs and an empty ``collapsed``. Repeated rows and rows
    without an id are texts of their own. An empty table gives no rows."""
    kind = dict(df.dtypes)[id_col]
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def find(batches):
        import pyarrow as pa

        runs_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in slices(batches, 1024):
            n_words, runs, collapsed = [], [], []
            for words, found in search(batch.column(1).to_pylist(), least, times):
                n_words.append(len(words))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in found.tolist()])
                collapsed.append(collapse(words, found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(runs, runs_type), pa.array(collapsed, pa.string())],
                names=["id", "n_words", "runs", "collapsed"])

    out = rows.mapInArrow(find, f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return out.withColumnRenamed("id", id_col)


def looped(text: Column, id_column: Column) -> Column:
    """The text, of every tenth id (by crc32) with a period: from some word on it repeats the words there."""
    words, h = words_of(text), F.crc32(id_column.cast("string").cast("binary"))
    n, g = F.size(words), F.floor(h / 10).cast("long")
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    unit = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    changed = F.concat(F.slice(words, F.lit(1), a), F.slice(unit, F.lit(1), n - a))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(changed, " ")).otherwise(text)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the longest run (ties: the smallest start, then period) and digests of what ``periodic_runs`` returns."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    hashed = lambda c: F.sha2(c.cast("binary"), 256)
    return found.withColumn("best", best).select(
        id_col, F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.n").alias("length"),
        (-F.col("best.q")).alias("period"), F.floor(F.expr("1000 * best.n div -best.q")).cast("long").alias("exponent_milli"),
        hashed(F.array_join(lines, "")).alias("runs_sha256"), hashed(F.col("collapsed")).alias("collapsed_sha256"))

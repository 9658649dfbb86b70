"""Quality of a text by pairwise ranking of preferred documents."""

from __future__ import annotations

import string

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.llm.common import Written

MARKS = string.punctuation


def features(text: str | None) -> np.ndarray:
    """Shares of kinds of bytes, words and lines over a whole text; zeros for a null or empty text."""
    data = (text or "").encode("utf-8", "replace")
    out = np.zeros(len(NAMES))
    if not data:
        return out
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size, words, lines = len(data), data.split(), data.split(b"\n")
    upper, lower, digits = counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum()
    marks = counts[[ord(c) for c in MARKS]]
    n = max(1, len(words))
    out[:12] = (
        np.log1p(len(words)), np.log1p(size / n), upper / max(1, upper + lower), digits / size,
        (marks.sum() - counts[ord(".")] - counts[ord(",")]) / size, (counts[ord(".")] + counts[ord(",")]) / size,
        counts[128:].sum() / size, counts[:32].sum() / size, len({*words}) / n, sum(map(bytes.__eq__, words, words[1:])) / n,
        len({*lines}) / len(lines), np.log1p(len(lines)) / 5,
    )
    out[12:] = np.minimum(1.0, 20 * marks / size)
    return out


NAMES = ("words", "word_size", "upper", "digits", "marks", "stops", "beyond_ascii", "control", "distinct", "repeats",
         "distinct_lines", "lines", *(f"mark_{ord(c)}" for c in MARKS))


class Ranker:
    """Weights of standardised features; the score crosses ``cut`` at the raw value ``threshold``."""

    def __init__(self, mean, scale, weights, threshold: float, cut: float = 0.3):
        self.mean, self.scale, self.weights, self.threshold, self.cut = mean, scale, weights, threshold, cut

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (np.clip((x - self.mean) / self.scale, -8, 8) * self.weights).sum(axis=1)  # the same in any batch

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.raw(x) - self.threshold + np.log(self.cut / (1 - self.cut))
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


# Cells of the grid of scores on which pairs meet, of the coarser one for the curvature, and of a digit of the quantile.
GRID, COARSE, DIGIT = 8_192, 512, 11


def kernel(cells: int, width: float) -> np.ndarray:
    """sigmoid(-x) for differences x of cells of a grid, from the lowest to the highest."""
    return 1 / (1 + np.exp(np.clip(width * np.arange(-cells, cells + 1), -50, 50)))


def against(count: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """For each cell the sum over all cells of their count times the shape at (cell - other)."""
    n = len(count)
    size = 1 << (3 * n).bit_length()
    return np.fft.irfft(np.fft.rfft(count, size) * np.fft.rfft(shape, size), size)[n - 1:2 * n - 1]


def ordinal(value: np.ndarray) -> np.ndarray:
    """Doubles as unsigned numbers of the same order."""
    bits = (value + 0.0).view(np.int64)
    return np.where(bits < 0, ~bits, bits ^ np.int64(-1 << 63)).view(np.uint64)


def learn(total, dims: int, bad_share: float | tuple[int, int], rounds: int = 40, ridge: float = 1e-3, cut: float = 0.3) -> Ranker | None:
    """Bradley-Terry scores: P(a before b) = sigmoid(score a - score b), over all pairs of a preferred and another row, by
    Newton's method. ``total(f)`` adds up f(labels, features) over blocks of all rows; None unless both labels occur.

    A round takes two passes: rows are counted on a grid of scores, shared between the two nearest cells, where every pair
    meets by a convolution; then each row adds its features by how it stands to all rows of the other label. The threshold is the
    ``bad_share`` quantile (a share, or the numbers of both labels, bad first) of the scores of all rows, weighted so that the
    labels have these shares; it is found digit by digit and exact."""
    told = total(lambda y, x: np.r_[(y == 0).sum(), (y == 1).sum(), x.sum(axis=0)])
    if told is None or not told[:2].all():
        return None
    n_bad, n_good = map(int, told[:2])
    # Rounded, so that the order in which blocks are added leaves no trace.
    mean = np.round(told[2:] / (n_bad + n_good), 12)
    scale = np.round(np.sqrt(total(lambda y, x: ((x - mean) ** 2).sum(axis=0)) / (n_bad + n_good)), 12)
    scale[scale < 1e-9] = 1.0

    def standard(x):
        return np.clip((x - mean) / scale, -8, 8)

    def tally(w, low, width):
        def count(y, x):
            at = ((standard(x) * w).sum(axis=1) - low) / width
            cell = np.minimum(at.astype(np.int64), GRID - 2)
            place = np.r_[cell, cell + 1] + GRID * np.r_[y, y]
            return np.bincount(place, np.r_[cell + 1 - at, at - cell], 2 * GRID)
        return total(count).reshape(2, GRID) / np.array([[n_bad], [n_good]])

    def slopes(w, low, width, lost, bend):
        def add(y, x):
            z = standard(x)
            at = ((z * w).sum(axis=1) - low) / width
            cell = np.minimum(at.astype(np.int64), GRID - 2)
            part = at - cell
            pull = lost[y, cell] * (1 - part) + lost[y, cell + 1] * part
            curve = bend[y, cell] * (1 - part) + bend[y, cell + 1] * part
            held = np.zeros((2, COARSE, dims))
            np.add.at(held, (y, cell * COARSE // GRID), z)
            out = []
            for k in (0, 1):
                own = z[y == k]
                out += [pull[y == k] @ own, ((own * curve[y == k, None]).T @ own).ravel()]
            return np.concatenate([*out, held.ravel()])
        return total(add)

    w, before, step = np.zeros(dims), (np.inf, None), None
    for _ in range(rounds):
        reach = max(1.0, 8 * np.abs(w).sum() * 1.001)
        low, width = -reach, 2 * reach / (GRID - 1)
        count = tally(w, low, width)
        shape = kernel(GRID - 1, width)
        # How far the preferred row of each pair is from being ahead of the other one.
        loss = float(count[1] @ against(count[0], np.logaddexp(0, -width * np.arange(1 - GRID, GRID)))) + ridge / 2 * float(w @ w)
        if loss > before[0] + 1e-9 and np.abs(step).max() > 1e-7:
            w, step = before[1] + step / 2, step / 2  # too far
            continue
        lost = np.stack([against(count[1], shape[::-1]), against(count[0], shape)])
        bent = shape * (1 - shape)
        told = slopes(w, low, width, lost, np.stack([against(count[1], bent), against(count[0], bent)]))
        sums, held = told[:2 * (dims + dims * dims)].reshape(2, -1), told[2 * (dims + dims * dims):].reshape(2, COARSE, dims)
        gradient = sums[0, :dims] / n_bad - sums[1, :dims] / n_good + ridge * w
        flat = kernel(COARSE - 1, width * GRID / COARSE)
        near = flat * (1 - flat)
        met = np.stack([against(held[0, :, k], near) for k in range(dims)], axis=1)
        cross = held[1].T @ met / (float(n_bad) * n_good)
        curvature = (sums[0, dims:] / n_bad + sums[1, dims:] / n_good).reshape(dims, dims) - cross - cross.T
        # The cross term comes from the coarser grid: what rounding takes from the curvature is given back.
        values, vectors = np.linalg.eigh(curvature)
        step = -vectors @ ((vectors.T @ gradient) / (np.maximum(values, 0) + ridge))
        before, w = (loss, w), w + step
        if np.abs(step).max() < 1e-7:
            break
    w = np.round(w, 6)
    ranker = Ranker(mean, scale, w, 0.0, cut)

    # Least value at which the weighted share of rows reaches bad_share, in whole numbers; its bits from the first to the last.
    bad, all_ = bad_share if isinstance(bad_share, tuple) else bad_share.as_integer_ratio()
    done, below, found = 0, [0, 0], 0
    while done < 64:
        bits = min(DIGIT, 64 - done)

        def digits(y, x, done=done, bits=bits, found=found):
            name = ordinal(ranker.raw(x))
            live = (name >> np.uint64(64 - done)) == np.uint64(found) if done else np.ones(len(y), bool)
            digit = (name[live] >> np.uint64(64 - done - bits)).astype(np.int64) & ((1 << bits) - 1)
            return np.bincount(digit + (y[live].astype(np.int64) << bits), minlength=2 << bits)

        upto = np.cumsum(total(digits).reshape(2, -1).astype(np.int64), axis=1)
        reached = [bad * n_good * (below[0] + int(b)) + (all_ - bad) * n_bad * (below[1] + int(g)) >= bad * n_bad * n_good for b, g in upto.T]
        digit = reached.index(True) if True in reached else int(np.flatnonzero(np.diff(np.r_[0, upto.sum(axis=0)]))[-1])
        if digit:
            below = [below[0] + int(upto[0, digit - 1]), below[1] + int(upto[1, digit - 1])]
        done, found = done + bits, found << bits | digit
    name = np.array([found], np.uint64).view(np.int64)
    ranker.threshold = float(np.where(name < 0, name ^ np.int64(-1 << 63), ~name).view(np.float64)[0])
    return ranker


def fit(good: np.ndarray, bad: np.ndarray, bad_share: float, rounds: int = 40, ridge: float = 1e-3, cut: float = 0.3) -> Ranker | None:
    """``learn`` from rows that are at hand."""
    y, x = np.repeat([1, 0], [len(good), len(bad)]), np.concatenate([good, bad])
    return learn(lambda f: np.asarray(f(y, x), float), x.shape[1], bad_share, rounds, ridge, cut)


def train(texts: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Ranker | None:
    """A ranker from all documents labelled 1 (preferred) and 0. The share of label 0 is counted over all labels. None
    unless both labels occur among the documents.

    Rows of ``labels`` without id or label are left out; of repeated ids with unlike labels the larger counts. Features are
    written once; each pass adds up sums of a fixed size on the executors."""
    known = (
        labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
        .groupBy("id").agg(F.max("label").cast("int").alias("label"))
    )
    kind = dict(texts.dtypes)[id_col]

    def describe(batches):
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "x": [features(t) for t in pdf["text"]]})

    rows = texts.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text")).where("id IS NOT NULL")
    described = rows.mapInPandas(describe, "id string, x array<double>").select(F.col("id").cast(kind).alias("id"), "x")
    table = Written(described.join(known, "id").select("label", "x"), "ranking-features")
    dims, pieces = len(NAMES), 16

    def total(f):
        def part(batches):
            import pyarrow as pa

            sums = None
            for batch in batches:
                if batch.num_rows:
                    y, x = batch.column(0).to_numpy(), batch.column(1).flatten().to_numpy().reshape(-1, dims)
                    sums = f(y, x) + (0 if sums is None else sums)
            if sums is not None:
                cells = [c.tobytes() for c in np.array_split(sums.astype(float), pieces)]
                yield pa.RecordBatch.from_arrays([pa.array(range(pieces), pa.int32()), pa.array(cells, pa.binary())], names=["piece", "sums"])

        def add(pdf):
            return pd.DataFrame({"piece": pdf["piece"].iloc[:1], "sums": [sum(np.frombuffer(c) for c in pdf["sums"]).tobytes()]})

        found = table.df.mapInArrow(part, "piece int, sums binary").groupBy("piece").applyInPandas(add, "piece int, sums binary").collect()
        return np.concatenate([np.frombuffer(r["sums"]) for r in sorted(found, key=lambda r: r["piece"])]) if found else None

    try:
        counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
        return learn(total, dims, (counts.get(0, 0), sum(counts.values())))
    finally:
        table.drop()


def score(df: DataFrame, ranker: Ranker | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) of every whole text, one row per input row: the score is in 0 to 1, predicted is 1 from
    the ranker's cut on. Null texts count as empty. Without a ranker all scores are 0.5."""
    kind = dict(df.dtypes)[id_col]
    cut = ranker.cut if ranker else 0.3

    def apply(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            s = ranker.score(np.stack([features(t) for t in pdf["text"]])) if ranker else np.full(len(pdf), 0.5)
            yield pd.DataFrame({"id": pdf["id"].to_numpy(), "score": s, "predicted": (s >= cut).astype(np.int32)})

    rows = df.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text"))
    out = rows.mapInPandas(apply, "id string, score double, predicted int")
    return out.select(F.col("id").cast(kind).alias(id_col), "score", "predicted")

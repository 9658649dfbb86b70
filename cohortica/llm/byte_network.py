"""Language of a text by a convolutional network over bytes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortica.llm.common import slices

WIDTHS = (2, 3, 4)
WINDOW = 128
# Neighbouring windows share the bytes that a filter may span, so no stretch of text falls between two of them.
STEP = WINDOW - max(WIDTHS) + 1
UNKNOWN = "und"


def windows(data: bytes) -> np.ndarray:
    """All windows of a text, one row each; the last is filled with zero bytes."""
    n = max(1, -(-(len(data) - (WINDOW - STEP)) // STEP))
    full = np.zeros((n - 1) * STEP + WINDOW, np.uint8)
    full[:len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(full, WINDOW)[::STEP]


class Network:
    """Filters of several widths over one-hot bytes, the largest response of each in a window, a softmax layer."""

    def __init__(self, labels: list[str], filters: int = 8, seed: int = 3):
        rng = np.random.RandomState(seed)
        self.labels, self.filters = labels, filters
        self.tables = [rng.normal(0, 0.3, (w, 256, filters)).astype(np.float32) for w in WIDTHS]
        self.biases = [np.zeros(filters, np.float32) for _ in WIDTHS]
        self.out = rng.normal(0, 0.1, (filters * len(WIDTHS), len(labels))).astype(np.float32)
        self.out_bias = np.zeros(len(labels), np.float32)

    def _responses(self, x: np.ndarray):
        for table, bias, w in zip(self.tables, self.biases, WIDTHS):
            span = x.shape[1] - w + 1
            yield sum(table[k][x[:, k:k + span]] for k in range(w)) + bias

    def fit(self, x: np.ndarray, y: np.ndarray, rounds: int = 6, batch: int = 128, rate: float = 0.01, seed: int = 4) -> None:
        """Adam on the mean cross entropy. Only the place of the largest response passes a gradient back."""
        rng = np.random.RandomState(seed)
        values = [*self.tables, *self.biases, self.out, self.out_bias]
        first, second, t = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
        for _ in range(rounds):
            order = rng.permutation(len(x))
            for s in range(0, len(x), batch):
                rows = order[s:s + batch]
                own, at, peaks = x[rows], [], []
                for r in self._responses(own):
                    at.append(r.argmax(axis=1))
                    peaks.append(np.take_along_axis(r, at[-1][:, None, :], 1)[:, 0])
                pooled = np.concatenate(peaks, axis=1)
                active = np.maximum(pooled, 0)
                p = self._softmax(active @ self.out + self.out_bias)
                p[np.arange(len(rows)), y[rows]] -= 1
                p /= len(rows)
                back = (p @ self.out.T) * (pooled > 0)
                grads = []
                for k, w in enumerate(WIDTHS):
                    g, part = np.zeros_like(self.tables[k]), back[:, k * self.filters:(k + 1) * self.filters]
                    for j in range(w):
                        byte = np.take_along_axis(own, at[k] + j, 1)
                        np.add.at(g[j], (byte, np.arange(self.filters)[None, :]), part)
                    grads.append(g)
                grads += [back[:, k * self.filters:(k + 1) * self.filters].sum(axis=0) for k in range(len(WIDTHS))]
                grads += [active.T @ p, p.sum(axis=0)]
                t += 1
                for v, g, a, b in zip(values, grads, first, second):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    v -= rate * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.999 ** t)) + 1e-8)

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def compiled(self):
        """The filters as tables over pairs of bytes: two lookups a position give the responses of all widths."""
        a2, a3, a4 = self.tables
        pair = lambda t, k: (t[k][:, None, :] + t[k + 1][None, :, :]).reshape(65536, -1)
        ahead = np.concatenate([pair(a2, 0) + self.biases[0], pair(a3, 0) + self.biases[1], pair(a4, 0) + self.biases[2]], axis=1)
        behind = np.concatenate([np.repeat(a3[2][:, None, :], 256, axis=1).reshape(65536, -1), pair(a4, 2)], axis=1)
        return np.ascontiguousarray(ahead, np.float32), np.ascontiguousarray(behind, np.float32)

    def predict(self, x: np.ndarray, compiled) -> np.ndarray:
        """Probabilities of the labels for each window."""
        (ahead, behind), f = compiled, self.filters
        pairs = x[:, :-1].astype(np.int32) << 8 | x[:, 1:]
        out = np.empty((len(x), len(self.labels)), np.float32)
        for s in range(0, len(x), 256):  # stays in the processor's caches
            p = pairs[s:s + 256]
            r = ahead[p]
            r[:, :-2, f:] += behind[p[:, 2:]]
            # The last places hold whole filters only for the shorter widths.
            peaks = np.concatenate([
                r[:, :, :f].max(axis=1),
                np.maximum(r[:, :-2, f:2 * f].max(axis=1), (r[:, -2, f:2 * f] + self.tables[1][2][x[s:s + 256, -1]])),
                r[:, :-2, 2 * f:].max(axis=1),
            ], axis=1)
            out[s:s + 256] = self._softmax(np.maximum(peaks, 0) @ self.out + self.out_bias)
        return out


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", per_label: int = 1024,
          per_text: int = 12, filters: int = 8, rounds: int = 6) -> Network | None:
    """A network fitted in numpy on a bounded sample: of each label the ``per_label`` texts of smallest id hash, and of
    each of these up to ``per_text`` windows spread over the whole text. None if no text has a label.

    Rows without a label or text are left out. The softmax has one output per distinct label."""
    rows = df.where(F.col(f"`{label_col}`").isNotNull() & (F.length(F.col(f"`{text_col}`")) > 0)).select(
        F.col(f"`{label_col}`").alias("label"), F.xxhash64(F.col(f"`{id_col}`").cast("string")).alias("order"), F.col(f"`{text_col}`").alias("text"))
    # Chosen by label and hash alone, so the ranking carries no texts; ties of the hash are taken together.
    last = (
        rows.select("label", "order").withColumn("rank", F.row_number().over(Window.partitionBy("label").orderBy("order")))
        .where(F.col("rank") <= per_label).groupBy("label").agg(F.max("order").alias("last"))
    )
    bounds = {r["label"]: r["last"] for r in last.collect()}  # one row per label
    if not bounds:
        return None
    chosen = F.lit(False)
    for label, bound in bounds.items():
        chosen = chosen | ((F.col("label") == label) & (F.col("order") <= bound))

    def cut(batches):
        for pdf in batches:
            labels, cuts = [], []
            for label, text in zip(pdf["label"], pdf["text"]):
                w = windows(text.encode("utf-8", "replace"))
                for k in np.unique(np.linspace(0, len(w) - 1, min(per_text, len(w))).astype(int)):
                    labels.append(label)
                    cuts.append(w[k].tobytes())
            yield pd.DataFrame({"label": labels, "window": cuts})

    sample = rows.where(chosen).select("label", "text").mapInPandas(cut, "label string, window binary")
    bound = 2 * per_label * per_text * len(bounds)  # only repeated ids could pass it
    sample = sample.limit(bound).toPandas().sort_values(["label", "window"], kind="stable")
    labels = sorted(bounds)
    network = Network(labels, filters)
    x = np.frombuffer(b"".join(sample["window"]), np.uint8).reshape(-1, WINDOW)
    network.fit(x, np.searchsorted(labels, sample["label"].to_numpy().astype(str)), rounds)
    return network


def predict(df: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text", keep: tuple = ()) -> DataFrame:
    """(id, ``keep`` columns, lang_pred, score) of every whole text, one row per input row.

    The score is the mean probability of the label over all windows, weighted by their bytes. Texts that are null or
    have no letter, and all texts if there is no network, are ``und`` with score 0."""
    # Columns travel under names of their own, so that any names may be kept.
    names = ["id", *[f"kept{k}" for k in range(len(keep))]]
    through = df.select(F.col(f"`{id_col}`").cast("string").alias("id"), *[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names[1:])], F.col(f"`{text_col}`").alias("text"))
    kind = dict(df.dtypes)[id_col]

    def classify(batches):
        import regex

        letter, compiled = regex.compile(r"\p{L}"), network.compiled() if network else None
        for batch in slices(batches):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            label, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            held, size = [], 0
            for k, text in enumerate(texts):
                if network and text and letter.search(text):
                    data = text.encode("utf-8", "replace")
                    held.append((k, windows(data), len(data)))
                    size += len(held[-1][1])
                if held and (size > 8192 or k == len(texts) - 1):
                    _score(network, compiled, held, label, score)
                    held, size = [], 0
            if held:
                _score(network, compiled, held, label, score)
            import pyarrow as pa

            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(label, pa.string()), pa.array(score, pa.float64())], names=[*names, "lang_pred", "score"])

    schema = through.select(*names, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    out = through.mapInArrow(classify, schema)
    return out.select(F.col("id").cast(kind).alias(id_col), *[F.col(n).alias(c) for n, c in zip(names[1:], keep)], "lang_pred", "score")


def _score(network: Network, compiled, held, label, score) -> None:
    p = network.predict(np.concatenate([w for _, w, _ in held]), compiled)
    at = 0
    for k, w, size in held:
        weight = np.full(len(w), STEP, float)
        weight[-1] = max(1, size - STEP * (len(w) - 1))
        mean = weight @ p[at:at + len(w)] / weight.sum()
        at += len(w)
        best = int(mean.argmax())
        label[k], score[k] = network.labels[best], float(min(1.0, mean[best]))


def accepted(df: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text", least: float = 0.3) -> DataFrame:
    """``df`` without the texts that are ``und`` or whose score is under ``least``; without a network all texts with a
    letter stay. Columns may have any names."""
    if network is None:
        return df.where(F.col(f"`{text_col}`").rlike(r"\p{L}"))
    names = [f"kept{k}" for k in range(len(df.columns))]
    # Every column passes through the scoring, so no join is needed to find the rows again.
    renamed = df.toDF(*names)
    place = dict(zip(df.columns, names))
    scored = predict(renamed, network, place[id_col], place[text_col], tuple(names))
    scored = scored.toDF("scored_id", *names, "lang_pred", "lang_score")
    return scored.where((F.col("lang_pred") != UNKNOWN) & (F.col("lang_score") >= least)).select(*names).toDF(*df.columns)

"""Piece encoding by a table of last tokens per prefix, and decoding."""

from __future__ import annotations

import hashlib
import heapq
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.llm.common import slices

SPACE = "▁"
# Segments remembered by a task; the memory is emptied beyond that.
MEMORY = 200_000


class Vocabulary:
    """Pieces, ranks and final merges of a merge-type model, read once on the driver and sent to the tasks."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        kinds = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in range(size)]
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.scores = [model.get_score(i) for i in range(size)]
        self.ids = {p: i for i, p in enumerate(self.pieces) if not kinds[i]}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        # Better scores merge first; pieces of equal score have equal rank.
        order = {s: r for r, s in enumerate(sorted({self.scores[i] for i in self.ids.values()}, reverse=True))}
        self.rank = {i: order[self.scores[i]] for i in self.ids.values()}
        # The two tokens whose merge makes a token last; tokens that merging never makes are left out.
        self.split, self.odd = {}, set()
        for piece, i in self.ids.items():
            if len(piece) == 1 or set(piece) == {SPACE}:
                continue
            parts = self.merge(piece, stop=i)
            if parts is None:
                self.odd.add(i)
                continue
            self.split[i] = parts
            # The table needs parts made before the whole.
            if any(len(self.pieces[p]) > 1 and self.rank[p] >= self.rank[i] for p in parts):
                raise ValueError(f"piece {piece!r} is ranked before its parts")
        # Pairs of characters that no piece has side by side never merge: texts may be cut there.
        beside = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        letters = {c for p in self.ids for c in p if c.isascii() and c.isalpha() or "À" <= c <= "ÿ" and c.isalpha()}
        self.letters = "".join(sorted(letters))
        self.marks = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and not any(a + c in beside for a in letters))

    def merge(self, text: str, stop: int | None = None):
        """Ids of ``text`` (known characters) by merging the best pair, leftmost first. With ``stop``, the two tokens
        whose merge makes that id over all of ``text``, or None."""
        parts = [self.ids[c] for c in text]
        left, right = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        heap, gone = [], [False] * len(parts)

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < len(parts):
                i = self.ids.get(self.pieces[parts[a]] + self.pieces[parts[b]])
                if i is not None:
                    heapq.heappush(heap, (self.rank[i], a, b, parts[a], parts[b], i))

        for k in range(len(parts) - 1):
            offer(k, k + 1)
        last = None
        while heap:
            _, a, b, x, y, i = heapq.heappop(heap)
            if gone[a] or gone[b] or parts[a] != x or parts[b] != y or right[a] != b:
                continue
            last = (x, y, i)
            parts[a], gone[b], right[a] = i, True, right[b]
            if right[b] < len(parts):
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        out = [p for p, g in zip(parts, gone) if not g]
        if stop is None:
            return out
        return last[:2] if len(out) == 1 and out[0] == stop and last else None


class Encoder:
    """Encodes segment by segment and remembers segments seen."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        v = self.vocabulary = vocabulary
        self.automaton = ahocorasick.Automaton()
        for piece, i in v.ids.items():
            if i not in v.odd and (len(piece) == 1 or set(piece) != {SPACE}):
                self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.join = {}
        for piece, i in v.ids.items():
            for k in range(1, len(piece)):
                a, b = v.ids.get(piece[:k]), v.ids.get(piece[k:])
                if a is not None and b is not None:
                    self.join[a << 20 | b] = v.rank[i]
        self.fits: dict[int, bool] = {}
        self.seen: dict[str, tuple[int, str, str]] = {}
        letters, marks = re.escape(v.letters), re.escape(v.marks)
        first = f"{SPACE}?[{letters}]+(?=[{marks}])|" if marks else ""
        self.cut = re.compile(f"{first}{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
        self.known = {p for p in v.ids if len(p) == 1}

    def compatible(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` stay side by side when their joint text is merged.

        Goes back in time: while the two tokens at the border could merge with each other before the merge that
        ended their state, they are not compatible; else the later made of the two falls apart."""
        key = a << 20 | b
        known = self.fits.get(key)
        if known is not None:
            return known
        v, join = self.vocabulary, self.join
        rank, split = v.rank, v.split
        limit, tie_goes_first, ok, x, y = 1 << 40, False, True, a, b
        while True:
            made = join.get(x << 20 | y)
            if made is not None and (made < limit or made == limit and tie_goes_first):
                ok = False
                break
            px, py = split.get(x), split.get(y)
            if px is None and py is None:
                break
            if py is None or px is not None and rank[x] > rank[y]:
                limit, tie_goes_first, x = rank[x], False, px[1]
            else:
                limit, tie_goes_first, y = rank[y], True, py[0]
        if len(self.fits) > 2 * MEMORY:
            self.fits.clear()
        self.fits[key] = ok
        return ok

    def _known(self, text: str) -> list[int]:
        """Ids of a text of known characters with at most one leading space mark.

        ``last[i]`` is the one token that can end the encoding of the first i characters: a match that ends there and
        is compatible with the token that ends the prefix before it. The ids follow from the end back."""
        if len(text) == 1:
            return [self.vocabulary.ids[text]]
        n = len(text)
        last, size = [-1] * (n + 1), [0] * (n + 1)
        fits, compatible = self.fits, self.compatible
        for end, (length, token) in self.automaton.iter(text):
            i = end + 1
            if last[i] >= 0:
                continue
            j = i - length
            if j:
                before = last[j]
                ok = fits.get(before << 20 | token)
                if not (compatible(before, token) if ok is None else ok):
                    continue
            last[i], size[i] = token, length
        out, i = [], n
        while i:
            out.append(last[i])
            i -= size[i]
        return out[::-1]

    def ids(self, segment: str) -> list[int]:
        v = self.vocabulary
        out: list[int] = []
        marks = len(segment) - len(segment.lstrip(SPACE))
        rest = segment[marks - 1:] if marks else segment
        if self.known.issuperset(rest):
            out = self._known(rest) if rest else []
        else:
            for part in re.split(f"([^{re.escape(''.join(self.known & set(rest)))}])", rest) if self.known & set(rest) else rest:
                if self.known.issuperset(part):
                    out += self._known(part) if part else []
                else:  # unknown characters become bytes and part the text
                    out += [v.bytes[x] for x in part.encode("utf-8", "replace")]
        if marks > 1:
            # Runs of space marks merge last of all; the mark before the word joins them if the word leaves it.
            alone = out[0] == v.ids[SPACE]
            out = v.merge(SPACE * (marks - 1 + alone)) + out[alone:]
        return out

    def entry(self, segment: str) -> tuple[int, str, str]:
        ids = self.ids(segment)
        text = self.text(ids)
        # Kept once where decoding gives the segment back.
        made = (len(ids), "".join([f",{i}" for i in ids]), segment if text == segment else text)
        if len(segment) <= 48:
            if len(self.seen) >= MEMORY:
                self.seen.clear()
            self.seen[segment] = made
        return made

    def text(self, ids: list[int]) -> str:
        """Pieces of ``ids`` put together, bytes read as UTF-8, space marks kept."""
        v, out, raw = self.vocabulary, [], bytearray()
        for i in ids:
            p = v.pieces[i]
            if len(p) == 6 and p.startswith("<0x") and v.bytes.get(int(p[3:5], 16)) == i:
                raw.append(int(p[3:5], 16))
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(p)
        return "".join([*out, raw.decode("utf-8", "replace")])

    def segments(self, text: str) -> list[str]:
        return self.cut.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for s in self.segments(text) for i in self.ids(s)]

    def decode(self, ids: list[int]) -> str:
        return self.text(ids).removeprefix(SPACE).replace(SPACE, " ")

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, the ids joined by commas, and the text decoded from them."""
        seen, entry = self.seen, self.entry
        found = [seen.get(s) or entry(s) for s in self.segments(text)]
        if not found:
            return 0, "", ""
        n, ids, texts = zip(*found)
        return sum(n), "".join(ids)[1:], "".join(texts).removeprefix(SPACE).replace(SPACE, " ")


def _rows(df: DataFrame, id_col: str, value_col: str, model: str, work, schema: str) -> DataFrame:
    """``work`` (encoder, values) of some hundred rows at a time gives Arrow columns; the id passes through as text."""
    vocabulary, kind = Vocabulary(model), dict(df.dtypes)[id_col]
    rows = df.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{value_col}`").alias("value"))
    names = ["id", *[c.split()[0] for c in schema.split(", ")]]

    def make(batches):
        import pyarrow as pa

        encoder = Encoder(vocabulary)
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), *work(encoder, part.column(1).to_pylist())], names=names)

    made = rows.mapInArrow(make, f"id string, {schema}")
    return made.select(F.col("id").cast(kind).alias(id_col), *names[1:])


def _lists(values: list[np.ndarray]):
    import pyarrow as pa

    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *values]).astype(np.int32)))


def encode(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): every whole text as ids of ``model``, one row per input row; null and empty texts give no ids."""

    def work(encoder, texts):
        return [_lists([np.array(encoder.encode(t or ""), np.int32) for t in texts])]

    return _rows(df, id_col, text_col, model, work, "ids array<int>")


def decode(df: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) from ids; null ids give an empty text."""

    def work(encoder, lists):
        import pyarrow as pa

        return [pa.array(["" if ids is None else encoder.decode(ids) for ids in lists], pa.string())]

    return _rows(df, id_col, ids_col, model, work, "text string")


def digests(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every whole text, encoded and decoded again; ``with_ids`` adds ids.

    One row per input row; null and empty texts have no ids and the digests of empty texts."""

    def work(encoder, texts):
        import pyarrow as pa

        counts, digests_, decoded, ids_ = [], [], [], []
        for t in texts:
            n, ids, text = encoder.digest(t or "")
            counts.append(n)
            digests_.append(hashlib.sha256(ids.encode()).hexdigest())
            decoded.append(hashlib.sha256(text.encode("utf-8", "replace")).hexdigest())
            if with_ids:
                ids_.append(np.fromstring(ids, np.int32, sep=",") if ids else np.zeros(0, np.int32))
        out = [pa.array(counts, pa.int64()), pa.array(digests_, pa.string()), pa.array(decoded, pa.string())]
        return [*out, _lists(ids_)] if with_ids else out

    return _rows(df, id_col, text_col, model, work, "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)

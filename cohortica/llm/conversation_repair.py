"""Cheapest repair of conversations' structure by block tables of cost vectors (the method of the Four Russians)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.llm.common import Written, scoped, slices

BLANKS = " \t\n\x0b\f\r"
DELETE, REROLE, INSERT, CUT = 4, 3, 3, 3
# States of a repaired conversation: nothing yet, after the system turn, after a user's, after an assistant's.
FOLLOWS = (2, 2, 3, 2)  # state after an inserted or rerolled turn
KEEPS = {0: {0: 1}, 1: {0: 2, 1: 2, 3: 2}, 2: {2: 3}, 3: {}}  # role class (s, u, a, other) to states before and after
AT_END, END_LETTERS = (0, 2 * INSERT, INSERT, 0), ("", "II", "I", "")
SYMBOLS = 9  # a row to delete, or a role class with a whole or cut text
BLOCK = 4
NAMES = {2: "user", 3: "assistant"}
# A conversation of more rows or letters is repaired in segments of at most SEGMENT rows.
HOLD_ROWS, HOLD_CHARS, SEGMENT = 4096, 4_000_000, 4096


def symbol(initial: str, fault: int, duplicate: bool) -> int:
    """``fault``: 0 none, 1 cut, 2 blank."""
    if duplicate or fault == 2:
        return 0
    return 1 + 2 * ("sua".find(initial) if initial and initial in "sua" else 3) + fault


def before(sym: int, after: tuple) -> tuple:
    """Costs to the end from each state before a row, from those after it."""
    spent = []
    for s in range(4):
        ways = [DELETE + after[s]]
        if sym:
            role, cut = divmod(sym - 1, 2)
            ways.append(CUT * cut + REROLE + after[FOLLOWS[s]])
            if s in KEEPS[role]:
                ways.append(CUT * cut + after[KEEPS[role][s]])
        spent.append(min(ways))
    u, a = min(spent[2], INSERT + spent[3]), min(spent[3], INSERT + spent[2])
    return min(spent[0], INSERT + u), min(spent[1], INSERT + u), u, a


class Tables:
    """Transitions of normalised cost vectors, from the end of a conversation to its start.

    ``vectors`` lists all vectors of costs to the end that any rows lead to, with the least cost taken off: differences
    are bounded, so there are few. ``to[v, b]`` and ``plus[v, b]`` give for every block ``b`` of ``BLOCK`` symbols the
    vector before it and the cost taken off on the way."""

    def __init__(self):
        self.vectors, numbers, one = [AT_END], {AT_END: 0}, []
        for vector in self.vectors:  # grows while it is read
            row = []
            for sym in range(SYMBOLS):
                costs = before(sym, vector)
                low = min(costs)
                costs = tuple(c - low for c in costs)
                if costs not in numbers:
                    numbers[costs] = len(self.vectors)
                    self.vectors.append(costs)
                row.append((numbers[costs], low))
            one.append(row)
        self.step_to, self.step_plus = (np.array([[x[k] for x in row] for row in one], np.int32) for k in (0, 1))
        self.to, self.plus = self.step_to, self.step_plus
        for _ in range(BLOCK - 1):  # one more symbol in front; the first symbol of a block has the highest place
            longer = self.step_to[self.to]  # vector, block, symbol
            cost = self.plus[:, :, None] + self.step_plus[self.to]
            self.to, self.plus = (x.transpose(0, 2, 1).reshape(len(self.vectors), -1) for x in (longer, cost))
        self.moves, self.traced = {}, {}

    def blocks(self, symbols: list) -> tuple[list, list]:
        """The first symbols that fill no block, and the numbers of the blocks after them."""
        lead = len(symbols) % BLOCK
        rest = np.array(symbols[lead:], np.int64).reshape(-1, BLOCK)
        return symbols[:lead], (rest @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))).tolist()

    def sweep(self, symbols: list, vectors: np.ndarray):
        """From each vector after the rows: the vectors before them, and the costs taken off."""
        lead, blocks = self.blocks(symbols)
        cost = np.zeros(len(vectors), np.int64)
        for b in reversed(blocks):
            cost += self.plus[vectors, b]
            vectors = self.to[vectors, b]
        for sym in reversed(lead):
            cost += self.step_plus[vectors, sym]
            vectors = self.step_to[vectors, sym]
        return vectors, cost

    def move(self, vector: int, sym: int, state: int) -> tuple[str, int]:
        """The least letters among the cheapest edits up to and with a row, and the state after it. Each letter leads to one
        state, so taking the least first letter at every choice gives the least text."""
        key = (vector, sym, state)
        if key not in self.moves:
            after = self.vectors[vector]
            costs = before(sym, after)
            role, cut = divmod(sym - 1, 2)
            if DELETE + after[state] == costs[state]:
                found = "D", state
            elif INSERT + costs[FOLLOWS[state]] == costs[state]:
                letters, end = self.move(vector, sym, FOLLOWS[state])
                found = "I" + letters, end
            elif sym and state in KEEPS[role] and CUT * cut + after[KEEPS[role][state]] == costs[state]:
                found = "K", KEEPS[role][state]
            else:
                found = "R", FOLLOWS[state]
            self.moves[key] = found
        return self.moves[key]

    def trace_symbols(self, symbols, vector: int, state: int) -> tuple[str, int]:
        """Letters for a few rows from ``state``: the vectors are expanded backward, the edits chosen forward."""
        after = [vector]
        for sym in reversed(symbols[1:]):
            after.append(int(self.step_to[after[-1], sym]))
        letters = []
        for sym, v in zip(symbols, reversed(after)):
            found, state = self.move(v, sym, state)
            letters.append(found)
        return "".join(letters), state

    def trace(self, symbols: list, vector: int, state: int) -> tuple[str, int]:
        """The audit of rows from ``state``, with ``vector`` after them, and the state after them."""
        lead, blocks = self.blocks(symbols)
        bounds = [vector]
        for b in reversed(blocks):
            bounds.append(int(self.to[bounds[-1], b]))
        letters, state = self.trace_symbols(lead, bounds[-1], state) if lead else ("", state)
        out = [letters]
        for k, b in enumerate(blocks):
            key = (bounds[len(blocks) - 1 - k], b, state)
            if key not in self.traced:
                at = len(lead) + k * BLOCK
                self.traced[key] = self.trace_symbols(symbols[at:at + BLOCK], key[0], state)
            letters, state = self.traced[key]
            out.append(letters)
        return "".join(out), state


def repaired(audit: str, state: int, roles: list, texts: list) -> list:
    """The turns that an audit leaves, from ``state`` on."""
    out, k = [], 0
    for letter in audit:
        if letter == "I":
            state = FOLLOWS[state]
            out.append({"role": NAMES[state], "text": ""})
            continue
        if letter == "K":
            state = KEEPS["sua".find(roles[k][:1])][state]
            out.append({"role": roles[k], "text": texts[k]})
        elif letter == "R":
            state = FOLLOWS[state]
            out.append({"role": NAMES[state], "text": texts[k]})
        k += 1
    return out


def faults(flags: list, duplicates: list) -> tuple[int, int, int]:
    """How many rows are blank, duplicates and cut, each by its first fault."""
    blank = sum(f == 2 for f in flags)
    double = sum(d and f != 2 for f, d in zip(flags, duplicates))
    return blank, double, sum(f == 1 and not d for f, d in zip(flags, duplicates))


def illegal(initials: list) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def spread(turns: list) -> tuple:
    """(least, greatest, number of distinct) of sorted turns; nulls do not count."""
    known = [t for t in turns if t is not None]
    return (known[0], known[-1], 1 + sum(a != b for a, b in zip(known, known[1:]))) if known else (None, None, 0)


def missing(low, high, distinct: int) -> int:
    return 0 if low is None else min(high - low + 1 - distinct, (1 << 63) - 1)


REPORT = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
TURNS = "turns array<struct<role:string,text:string>>"
RAW = "place long, turn long, role string, text string, fault int"


class Repaired:
    """What ``repair`` gives: ``whole`` has a row per conversation with its repaired ``turns``, for those whose rows one
    task held; ``open_report`` and ``open_turns`` (by segment ``seg``) have the others."""

    def __init__(self, written: Written, kind: str, id_col: str):
        self.written, self.kind, self.id_col = written, kind, id_col
        self.whole = written.df.where("place IS NULL").drop("place", "turn", "role", "text", "fault")
        self.open_report, self.open_turns = _open(written.df.where("place IS NOT NULL").select("key", *[c.split()[0] for c in RAW.split(", ")]))

    def _named(self, df: DataFrame) -> DataFrame:
        own = F.when(F.col("key") == "", None).otherwise(F.expr("substring(key, 2)")).cast(self.kind)
        return df.select(own.alias(self.id_col), *[c for c in df.columns if c != "key"])

    def turns(self) -> DataFrame:
        """The repaired turns: id, position (from 0 within a segment), seg, role, text."""
        both = self.whole.select("key", F.lit(0).cast("long").alias("seg"), "turns").union(self.open_turns.select("key", "seg", "turns"))
        return self._named(both.select("key", "seg", F.posexplode("turns").alias("position", "t")).select("key", "seg", "position", "t.role", "t.text"))

    def report(self) -> DataFrame:
        """A row per conversation: faults, cost, audit and the digest of the repaired turns."""
        lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
        names = [c.split()[0] for c in REPORT.split(", ")]
        whole = self.whole.select(*names, F.sha2(lines.cast("binary"), 256).alias("repaired_sha256"))

        def digest(batches):
            """One digest runs through the segments of a conversation in order; a segment's text is held at a time."""
            import hashlib

            import pyarrow as pa

            now, state, audit, begun = None, None, [], False

            def close():
                return pa.RecordBatch.from_arrays([pa.array([now]), pa.array(["".join(audit)]), pa.array([state.hexdigest()])], names=["key", "audit", "repaired_sha256"])

            for batch in batches:
                for at in range(batch.num_rows):
                    key, piece, text, n = (batch.column(k)[at].as_py() for k in range(4))
                    if key != now:
                        if now is not None:
                            yield close()
                        now, state, audit, begun = key, hashlib.sha256(), [], False
                    if n:
                        state.update(("\n" * begun + text).encode())
                        begun = True
                    audit.append(piece)
            if now is not None:
                yield close()

        pieces = self.open_turns.select("key", "audit", lines.alias("text"), F.size("turns").alias("n"), "seg")
        joined = pieces.repartition("key").sortWithinPartitions("key", "seg").drop("seg").mapInArrow(digest, "key string, audit string, repaired_sha256 string")
        return self._named(whole.union(self.open_report.join(joined, "key").select(*names, "repaired_sha256")))


def repair(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> Repaired:
    """The cheapest edits that give each conversation the form: a system turn or none, then user and assistant in turn.

    A row is blank (no letter but ASCII white space), a duplicate (role and text seen earlier in the conversation) or
    truncated (its last letter ends no sentence); the first of these counts. Edits are K(eep), R(erole) to user or
    assistant for 3, D(elete) for 4, which blank rows and duplicates need, and I(nsert) an empty turn for 3; a truncated
    row that stays costs 3. Roles count by their first letter. Of the cheapest edits those whose letters are least in ASCII.

    Rows are dealt by ranges of conversation and turn and sorted; ties of a turn go by role, then text. A conversation that
    begins and ends within a task and has at most ``HOLD_ROWS`` rows is repaired there. All others, the first and last
    of each task among them, are cut into segments: each maps the possible cost vectors after it to those before it,
    conversations chain these maps, and segments trace their edits at once, so no group holds a long conversation.

    Null roles and texts count as one space; null turns come first; rows of a null id are a conversation of their own. Equal
    rows are duplicates of each other. An empty table gives no rows."""
    kind = dict(df.dtypes)[id_col]
    own = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    rows = df.select(
        F.coalesce(F.concat(F.lit("="), F.col(f"`{id_col}`").cast("string")), F.lit("")).alias("key"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"), own(role_col).alias("role"), own(text_col).alias("text"))
    core = F.rtrim(F.col("text"), F.lit(BLANKS))
    rows = rows.withColumn("fault", F.when(core == "", 2).when(F.right(core, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1))
    order = ["key", "turn", "role"]
    dealt = rows.repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")

    def scan(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        place, tables, made = TaskContext.get().partitionId() << 33, Tables(), []
        now, held, size, whole = None, [], 0, False
        names = [f.split()[0] for part in (REPORT, TURNS, RAW) for f in ([part] if part == TURNS else part.split(", "))]
        turn_type = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        kinds = [pa.string(), *[pa.int64()] * 6, pa.string(), turn_type, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32()]

        def batch_of(found):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)], names=names)

        def raw():
            nonlocal place, held, size
            found = [(now, *[None] * 8, place + k, *row) for k, row in enumerate(held)]
            place, held, size = place + len(held), [], 0
            return batch_of(found)

        def close():
            nonlocal held, size
            made.append((now, *_solve(tables, held), *[None] * 5))
            held, size = [], 0

        for batch in slices(batches, 1024):
            for key, *row in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if key != now:
                    if held:
                        if whole:
                            close()
                        else:
                            yield raw()
                    whole, now = now is not None, key
                held.append(row)
                size += len(row[2])
                if len(held) >= HOLD_ROWS or size >= HOLD_CHARS:
                    whole = False
                    yield raw()
            if len(made) >= 256:
                yield batch_of(made)
                made.clear()
        if held:
            yield raw()
        if made:
            yield batch_of(made)

    return Repaired(Written(dealt.select("key", "turn", "role", "text", "fault").mapInArrow(scan, f"{REPORT}, {TURNS}, {RAW}"), "repair-rows"), kind, id_col)


def _solve(tables: Tables, rows: list) -> tuple:
    """The report and the turns of one conversation of sorted (turn, role, text, fault)."""
    turns, roles, texts, flags = map(list, zip(*rows))
    seen, duplicates = set(), []
    for pair in zip(roles, texts):
        duplicates.append(pair in seen)
        seen.add(pair)
    initials = [r[:1] for r in roles]
    symbols = [symbol(*x) for x in zip(initials, flags, duplicates)]
    first, cost = tables.sweep(symbols, np.zeros(1, np.int64))
    audit, state = tables.trace(symbols, 0, 0)
    audit += END_LETTERS[state]
    return (missing(*spread(turns)), *faults(flags, duplicates), illegal(initials), int(cost[0]) + tables.vectors[first[0]][0], audit,
            repaired(audit, 0, roles, texts))


def _open(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Report (without audits) and turns by segment of the conversations that no task holds whole."""
    marks = raw.select("key", F.xxhash64(F.lit(1), "role", "text").alias("h1"), F.xxhash64(F.lit(2), "role", "text").alias("h2"), "place")
    firsts = marks.groupBy("key", "h1", "h2").agg(F.min("place").alias("first"))
    again = marks.join(firsts, ["key", "h1", "h2"]).where(F.col("place") > F.col("first")).select("key", "place", F.lit(True).alias("duplicate"))
    rows = raw.join(again, ["key", "place"], "left").withColumn("duplicate", F.coalesce("duplicate", F.lit(False)))
    rows = Written(rows.withColumn("seg", F.expr(f"place div {SEGMENT}")), "repair-open").df

    def symbols_of(pdf: pd.DataFrame) -> list:
        return [symbol(r[:1], int(f), bool(d)) for r, f, d in zip(pdf["role"], pdf["fault"], pdf["duplicate"])]

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, tables = pdf.sort_values("place"), Tables()
        to, plus = tables.sweep(symbols_of(pdf), np.arange(len(tables.vectors)))
        initials, turns = [r[:1] for r in pdf["role"]], [None if t == "" else int(t) for t in pdf["turn"]]
        low, high, distinct = spread(turns)
        return pd.DataFrame([(
            pdf["key"].iloc[0], int(pdf["seg"].iloc[0]), to.tolist(), plus.tolist(), *faults(pdf["fault"].tolist(), pdf["duplicate"].tolist()),
            illegal(initials), initials[0], initials[-1], "" if low is None else str(low), "" if low is None else str(high), distinct,
        )], columns=["key", "seg", "to", "plus", "blank", "duplicate", "truncated", "illegal", "head", "tail", "low", "high", "distinct"])

    # Turns pass as text: a column of longs with nulls would pass as doubles.
    plain = rows.select("key", "seg", "place", F.coalesce(F.col("turn").cast("string"), F.lit("")).alias("turn"), "role", "fault", "duplicate")
    parts = Written(plain.groupBy("key", "seg").applyInPandas(
        summarise, "key string, seg long, to array<int>, plus array<long>, blank long, duplicate long, truncated long, illegal long, head string, "
        "tail string, low string, high string, distinct long"), "repair-parts").df

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        """The vector after each segment, and the conversation's totals: a row per ``SEGMENT`` rows."""
        pdf, tables = pdf.sort_values("seg", ignore_index=True), Tables()
        after, vector, cost = [], 0, 0
        for to, plus in zip(reversed(pdf["to"].tolist()), reversed(pdf["plus"].tolist())):
            after.append(vector)
            cost += int(plus[vector])
            vector = int(to[vector])
        cost += tables.vectors[vector][0]
        known = pdf[pdf["low"] != ""]
        lows, highs = [int(x) for x in known["low"]], [int(x) for x in known["high"]]
        distinct = int(known["distinct"].sum()) - sum(a == b for a, b in zip(highs, lows[1:]))
        gaps = missing(lows[0], highs[-1], distinct) if lows else 0
        wrong = int(pdf["illegal"].sum()) + sum(illegal([a, b]) for a, b in zip(pdf["tail"], pdf["head"][1:]))
        out = pd.DataFrame({"key": pdf["key"], "seg": pdf["seg"], "vector": after[::-1], "first": pdf.index == 0, "last": pdf.index == len(pdf) - 1})
        for name, value in (("gaps", gaps), *((c, int(pdf[c].sum())) for c in ("blank", "duplicate", "truncated")), ("illegal", wrong), ("cost", cost)):
            out[name] = value
        return out

    chained = Written(parts.groupBy("key").applyInPandas(
        chain, "key string, seg long, vector int, first boolean, last boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"), "repair-chain").df

    def trace(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, tables = pdf.sort_values("place"), Tables()
        found = [tables.trace(symbols_of(pdf), int(pdf["vector"].iloc[0]), s) for s in range(4)]
        return pd.DataFrame([(pdf["key"].iloc[0], int(pdf["seg"].iloc[0]), [a for a, _ in found], [s for _, s in found])], columns=["key", "seg", "audits", "exits"])

    def enter(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, state, states = pdf.sort_values("seg", ignore_index=True), 0, []
        for exits in pdf["exits"]:
            states.append(state)
            state = int(exits[state])
        return pd.DataFrame({"key": pdf["key"], "seg": pdf["seg"], "state": states})

    def rewrite(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        audit, state = pdf["audit"].iloc[0], int(pdf["state"].iloc[0])
        if pdf["last"].iloc[0]:
            audit += END_LETTERS[int(pdf["exit"].iloc[0])]
        return pd.DataFrame([(pdf["key"].iloc[0], int(pdf["seg"].iloc[0]), audit, repaired(audit, state, pdf["role"].tolist(), pdf["text"].tolist()))], columns=["key", "seg", "audit", "turns"])

    traced = Written(
        rows.select("key", "seg", "place", "role", "fault", "duplicate").join(chained.select("key", "seg", "vector"), ["key", "seg"])
        .groupBy("key", "seg").applyInPandas(trace, "key string, seg long, audits array<string>, exits array<int>"), "repair-traces").df
    entered = traced.select("key", "seg", "exits").groupBy("key").applyInPandas(enter, "key string, seg long, state int")
    chosen = (
        traced.join(entered, ["key", "seg"]).join(chained.select("key", "seg", "last"), ["key", "seg"])
        .select("key", "seg", "state", F.expr("audits[state]").alias("audit"), F.expr("exits[state]").alias("exit"), "last"))
    turns = rows.select("key", "seg", "place", "role", "text").join(chosen, ["key", "seg"]).groupBy("key", "seg").applyInPandas(rewrite, f"key string, seg long, audit string, {TURNS}")
    report = chained.where("first").select("key", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return report, Written(turns, "repair-turns").df


def damaged(df: DataFrame) -> DataFrame:
    """Conversations with faults by a hash of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes out
    sentence ends, 3 repeats it, 4 sets the role user. Nulls count as one space, but for the id and the turn themselves."""
    own = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = df.select("conv_id", "turn", own("role").alias("role"), own("text").alias("text"))
    rows = rows.withColumn("d", F.crc32(F.concat(own("conv_id"), F.lit(":"), own("turn")).cast("binary")) % 20).where("d <> 0")
    text = F.when(F.col("d") == 1, "").when(F.col("d") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("d") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "d")
    return rows.union(rows.where("d = 3")).drop("d")


@scoped
def audit_report(df: DataFrame) -> DataFrame:
    """The repair of damaged conversations: a row for every conversation before the damage."""
    found = repair(damaged(df)).report()
    ids = df.select(F.col("conv_id").alias("own")).distinct()
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    out = ids.join(found, ids["own"].eqNullSafe(found["conv_id"]), "left")
    return out.select(
        F.col("own").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))

"""Periodic runs, exact top-k and conversation repair against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from cohortica.llm import conversation_repair, periodic_runs, queries, uniform_threshold

SF = "/root/testdata/sf0.01"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Periodic runs


def all_runs(w, least=6, times=4):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i - start + q
            smaller = any(all(w[k] == w[k + r] for k in range(start, start + n - r)) for r in range(1, q))
            if i > start and n >= max(least, times * q) and not smaller:
                out.append((start, n, q))
            i += i == start
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_runs(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found, gone = all_runs(w), set()
    for s, length, q in found:
        gone |= set(range(s + q, s + length))
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join("%d,%d,%d\n" % r for r in found)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


@pytest.mark.parametrize("least,times", [(6, 4), (1, 3), (20, 3), (9, 7)])
def test_runs_of_random_words(least, times):
    rng = random.Random(least)
    for _ in range(120):
        docs = []
        for _ in range(rng.randint(1, 4)):
            w = []
            while rng.random() < 0.8 and len(w) < 100:
                unit = [rng.choice("ab" if rng.random() < 0.5 else "abc") for _ in range(rng.randint(1, 9))]
                w += unit * rng.randint(1, 7)
                w = w[:len(w) - rng.randint(0, 3)]
            docs.append(" ".join(w))
        for text, (words, found) in zip(docs, periodic_runs.search(docs, least, times)):
            assert [w.decode() for w in words] == text.split()
            assert [tuple(r) for r in found.tolist()] == all_runs(text.split(), least, times)


def test_long_runs_cost_little():
    text = "w " * 300_000 + "x " + "a b c d e f g " * 40_000
    (_, found), = periodic_runs.search([text], 6, 4)
    assert found.tolist() == [[0, 300_000, 1], [300_001, 280_000, 7]]


def test_runs_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r[0]: tuple(r) for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    short = [(i, t) for i, t in docs if len((t or "").split()) < 400]
    assert len(short) > 500 and all(got[i] == plain_runs(i, t) for i, t in short)
    assert sum(r[1] > 0 for r in got.values()) > 50


def test_runs_of_odd_texts(spark):
    texts = [None, "", " \n\t", "x", "x " * 6, "X x X x x x x x", "é\x1c é\x1c é\x1c é\x1c é\x1c é\x1c", "a b " * 300, "1 2 3 " * 4, "1 2 3 " * 4]
    rows = [(k, t, "id", 1) for k, t in enumerate(texts)] + [(None, "y " * 9, "id", 1), (4, "x " * 6, "id", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, id string, runs int")
    out = periodic_runs.periodic_runs(df).collect()
    expected = []
    for i, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        found = all_runs(w)
        gone = {k for s, n, q in found for k in range(s + q, s + n)}
        expected.append((i is None, i or 0, len(w), found, " ".join(x for k, x in enumerate(w) if k not in gone)))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in out) == sorted(expected)
    assert periodic_runs.digests(periodic_runs.periodic_runs(df.limit(0))).count() == 0
    looped = df.select("doc_id", periodic_runs.looped(df["text"], df["doc_id"]).alias("text"))
    got = sorted(map(str, map(tuple, periodic_runs.digests(periodic_runs.periodic_runs(looped)).collect())))
    assert got == sorted(str(plain_runs(i, t)) for i, t, *_ in rows)


# Exact top-k


def plain_top(rows, k=20, factor=64):
    usable = [(i, [int(np.floor(factor * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, q in usable:
        if i % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i and len(v) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("lists", [1, 2, 5])
def test_top_with_small_blocks(spark, monkeypatch, lists):
    """Blocks of a few rows make both later phases work; a third of all rows are copies of one vector."""
    monkeypatch.setattr(uniform_threshold, "BLOCK_ROWS", 60)
    monkeypatch.setattr(uniform_threshold, "CHUNK_ROWS", 9)
    rng = np.random.RandomState(lists)
    rows = [(i, [float(x) for x in (np.arange(7) / 9 if i % 3 == 0 else rng.normal(size=7))]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = uniform_threshold.top(df, k=7, lists=lists)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect())) == plain_top(rows, 7)


def test_top_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.0, 0.0]), (20, [1.0, -1.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 0.0]), (4, [None, 1.0]), (None, [1.0, 1.0]), (5, [0.5, 0.5]), (5, [0.5, 0.5]),
            (6, []), (40, []), (60, [2.0]), (7, [-3.0]), (8, [0.01, -0.01]), (9, [1e7, 3.0]), (80, [1e7, -1e7])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, id string, score int")
    assert sorted(map(tuple, uniform_threshold.top(df).drop("id").collect())) == plain_top(rows)
    assert uniform_threshold.top(df.limit(0)).count() == 0
    wide = spark.createDataFrame([(0, [1e300]), (1, [1e300]), (2, [-1e308])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in uniform_threshold.top(wide).orderBy("rank").collect()] == [(0, 1, 1, (1 << 63) - 1), (0, 2, 2, -(1 << 63))]


# Conversations

NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}


def cheapest(rows):
    """(cost, audit) from each state, least first, row by row from the end."""
    best = {0: (0, ""), 3: (0, ""), 1: (6, "II"), 2: (3, "I")}
    for role, _, fault, double in reversed(rows):
        now, cut = {}, 3 if fault == 1 else 0
        for s in range(4):
            ways = [(best[s][0] + 4, "D" + best[s][1])]
            if fault != 2 and not double:
                ways.append((best[NEXT[s]][0] + 3 + cut, "R" + best[NEXT[s]][1]))
                if s in KEPT.get(role[:1], {}):
                    to = KEPT[role[:1]][s]
                    ways.append((best[to][0] + cut, "K" + best[to][1]))
            now[s] = min(ways)
        for _ in range(3):
            now = {s: min(now[s], (now[NEXT[s]][0] + 3, "I" + now[NEXT[s]][1])) for s in now}
        best = now
    return best[0]


def plain_repair(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, full, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        core = text.rstrip(" \t\n\x0b\f\r")
        fault, double = 2 if not core else int(core[-1] not in ".!?"), (role, text) in seen
        seen.add((role, text))
        full.append((role, text, fault, double))
        if fault == 2 or double or fault:
            counts[0 if fault == 2 else 1 if double else 2] += 1
    cost, audit = cheapest(full)
    out, k, s = [], 0, 0
    for letter in audit:
        if letter != "I":
            role, text, *_ = full[k]
            k += 1
        if letter == "K":
            s = KEPT[role[:1]][s]
            out.append(f"{role}:{text}")
        elif letter in "IR":
            s = NEXT[s]
            out.append(("user:" if s == 2 else "assistant:") + ("" if letter == "I" else text))
    assert k == len(full) and s in (0, 3)
    turns, initials = [t for t, *_ in rows if t is not None], [r[:1] for r, *_ in full]
    wrong = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts, wrong, cost, audit, sha("\n".join(out)))


def plain_damage(rows):
    for c, t, role, text in rows:
        name = ":".join(" " if x is None else str(x) for x in (c, t))
        d, role, text = zlib.crc32(name.encode()) % 20, " " if role is None else role, " " if text is None else text
        if d:
            text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
            yield from [(c, t, "user" if d == 4 else role, text)] * (1 + (d == 3))


def plain_report(rows):
    by = {c: [] for c, *_ in rows}
    for c, *row in plain_damage(rows):
        by[c].append(row)
    return {c: plain_repair(v) if v else (0,) * 6 + ("", sha("")) for c, v in by.items()}


def random_rows(rng, n, conv=7):
    return [(conv, k, rng.choice(["system", "user", "assistant", "tool", ""]), rng.choice(["a.", "b", " ", "c!", "d?", "e", "f."])) for k in range(n)]


def test_block_tables():
    tables, rng = conversation_repair.Tables(), random.Random(5)
    assert tables.to.shape == (len(tables.vectors), 9 ** 4) and len(tables.vectors) < 64
    for _ in range(1500):
        rows = [r[1:] for r in random_rows(rng, rng.randint(1, 15))]
        flags = [2 if not t.strip() else int(t[-1] not in ".!?") for _, _, t in rows]
        found = conversation_repair._solve(tables, [[*r, f] for r, f in zip(rows, flags)])
        assert (*found[:-1], sha("\n".join(f"{x['role']}:{x['text']}" for x in found[-1]))) == plain_repair(rows)


@pytest.mark.parametrize("hold,segment", [(4096, 4096), (3, 4)])
def test_repair(spark, monkeypatch, hold, segment):
    """With small limits nearly all conversations are chained from segments."""
    monkeypatch.setattr(conversation_repair, "HOLD_ROWS", hold)
    monkeypatch.setattr(conversation_repair, "SEGMENT", segment)
    df, rng = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text"), random.Random(9)
    rows = [tuple(r) for r in df.collect()] + [
        (None, None, None, None), (None, None, None, None), (None, 3, "user", "q."), (-1, None, "user", "x"), (-1, 5, "user", "x"), (-1, 1 << 61, None, "hm"), (-2, 1, "system", None)]
    rows += [(-3, rng.randrange(150), r, t + rng.choice("ab c.")) for _, _, r, t in random_rows(rng, 500)]
    df = spark.createDataFrame(rows, df.schema)
    got = conversation_repair.audit_report(df)
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == plain_report(rows)


def test_repair_keeps_turns_and_takes_no_rows(spark):
    rows = [("a", 1, "system", "s."), ("a", 2, "assistant", "hi."), ("b", None, None, None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id string, turn int, role string, text string, key string, cost int")
    found = conversation_repair.repair(df)
    assert sorted((r["conv_id"], r["position"], r["role"], r["text"]) for r in found.turns().collect()) == [
        ("a", 0, "system", "s."), ("a", 1, "user", ""), ("a", 2, "assistant", "hi.")]
    assert {r["conv_id"]: (r["cost"], r["audit"]) for r in found.report().collect()} == {"a": (3, "KIK"), "b": (4, "D")}
    assert conversation_repair.repair(df.limit(0)).report().count() == 0
    assert conversation_repair.audit_report(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0

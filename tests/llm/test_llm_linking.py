"""Vectors, documents and paragraphs that link, against plain Python."""

import collections
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortica.llm import adaptive_scan, cap_filters, paragraph_bands, postings, prefix_join
from cohortica.llm.common import components

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v int"


class Groups:
    def __init__(self):
        self.up = {}

    def find(self, a):
        self.up.setdefault(a, a)
        while self.up[a] != a:
            a = self.up[a]
        return a

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def test_components(spark):
    rng, edges = random.Random(1), [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    edges += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)] + [(1, 0), (0, 1)]
    groups = Groups()
    for a, b in edges:
        groups.join(a, b)
    rows = components(spark.createDataFrame(edges, "a long, b long")).df.collect()
    assert {r["node"]: r["component"] for r in rows} == {a: groups.find(a) for e in edges for a in e if e[0] != e[1]}
    assert components(spark.createDataFrame([], "a long, b long")).df.count() == 0


def vectors():
    rng = np.random.RandomState(2)
    rows, centre = [], rng.normal(size=16)
    for k in range(120):  # near copies of one vector, close to the threshold
        rows.append((k, (centre + 0.12 * rng.normal(size=16)).tolist(), 1))
    for k in range(120, 160):
        rows.append((k, centre.tolist(), 1 if k % 2 else 2))
    for k in range(160, 260):
        rows.append((k, rng.normal(size=16).tolist(), k % 3))
    rows += [(260, None, 1), (261, [0.0] * 16, 1), (262, [float("nan")] + [1.0] * 15, 1), (263, [float("inf")] + [1.0] * 15, 1),
             (264, centre.tolist(), None), (265, (centre * 1e-20).tolist(), 1), (266, centre.tolist()[:8], 1), (267, [], 1),
             (268, [None] + [1.0] * 15, 1), (None, centre.tolist(), 1), (120, centre.tolist(), 2)]
    return [(*r, "x", 5) for r in rows]


def brute_vectors(rows):
    ok, groups, links = [], Groups(), collections.Counter()
    for n, (i, v, label, *_) in enumerate(rows):
        if i is None:
            continue
        groups.find(i)
        if v and label is not None and None not in v:
            a = np.array(v, np.float32).astype(float)
            if np.isfinite(a).all() and a.any():
                a = a / np.abs(a).max()
                ok.append((n, i, a / np.sqrt((a * a).sum()), label))
    for x in range(len(ok)):
        for y in range(x):
            (n, i, a, la), (m, j, b, lb) = ok[x], ok[y]
            if la == lb and len(a) == len(b) and a @ b >= 0.98:
                links[n] += 1
                links[m] += 1
                groups.join(i, j)
    return sorted((i, links[n], groups.find(i)) for n, (i, *_) in enumerate(rows) if i is not None)


@pytest.mark.parametrize("block", [1024, 16])
def test_vector_links(spark, monkeypatch, block):
    monkeypatch.setattr(cap_filters, "BLOCK_ROWS", block)
    rows = vectors()
    out = cap_filters.link_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in out if r["vec_id"] is not None) == brute_vectors(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out if r["vec_id"] is not None)
    (lost,) = [r for r in out if r["vec_id"] is None]
    assert (lost["n_links"], lost["component_id"], lost["kept"]) == (0, None, True)


def test_vector_links_of_nothing(spark):
    assert cap_filters.link_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    out = cap_filters.link_vectors(spark.createDataFrame([(1, None, 1, "", 0)], SCHEMA)).collect()
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in out] == [(0, 1, True)]


def test_filters_find_pairs_at_the_threshold():
    rng, filters = np.random.RandomState(3), cap_filters.Filters(64, 50_000, 8, 6.0, 16.0)
    a = rng.normal(size=(500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    z = rng.normal(size=(500, 64))
    z -= (z * a).sum(axis=1, keepdims=True) * a
    b = 0.98 * a + np.sqrt(1 - 0.98 ** 2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    x, y = (set(zip(*(c.tolist() for c in filters.decode(v)))) for v in (a, b))
    assert len({r for r, _ in x & y}) >= 495
    # Decoding gives all directions that exceed, and only those.
    rotation, (first, second) = filters.codes[0]
    turned = a[0] @ rotation
    cut = filters.parts[0][1]
    total = (turned[:cut] @ first.T)[:, None] + (turned[cut:] @ second.T)[None, :]
    assert {i * filters.words + j for i, j in zip(*np.nonzero(total >= filters.alpha))} == {
        f for r, f in x if r == 0 and f < filters.words ** 2}


def nearest_rows():
    rng = np.random.RandomState(4)
    rows = [(k, rng.normal(size=12).tolist(), 0) for k in range(300)]
    rows += [(300 + k, rows[5][1], 0) for k in range(40)]
    rows += [(500, None, 0), (520, [0.0] * 12, 0), (540, [float("nan")] * 12, 0), (560, [1.0] * 3, 0), (None, [1.0] * 12, 0), (20, rows[20][1], 0)]
    return [(*r, "x", 5) for r in rows]


@pytest.mark.parametrize("block,chunk", [(4096, 512), (32, 4)])
def test_nearest(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(adaptive_scan, "BLOCK_ROWS", block)
    monkeypatch.setattr(adaptive_scan, "QUERY_ROWS", chunk)
    rows = nearest_rows()
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v, *_ in rows if i is not None and v and len(v) == 12 and np.isfinite(v).all() and any(v)]
    want = {}
    for i, q in ok:
        if i % 20 == 0:
            best = sorted((-float(sum(q * v)), j) for j, v in ok if j != i)[:20]
            want[i] = [(j, -s) for s, j in best]
    # All lists and no early end: exact.
    found = collections.defaultdict(list)
    out = adaptive_scan.nearest(spark.createDataFrame(rows, SCHEMA), probe=1.0, epsilon=100.0).orderBy("query_id", "rank").collect()
    for r in out:
        found[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(found[r["query_id"]])
    assert found.keys() == want.keys()
    for i in want:
        assert [j for j, _ in found[i]] == [j for j, _ in want[i]]
        assert np.allclose([s for _, s in found[i]], [s for _, s in want[i]])
    usual = adaptive_scan.nearest(spark.createDataFrame(rows, SCHEMA)).collect()
    hits = sum((r["vec_id"] in {j for j, _ in want[r["query_id"]]}) for r in usual)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_nearest_recall_on_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = df.toPandas()
    x, ids = np.stack(rows["embedding"]).astype(float), rows["vec_id"].to_numpy()
    out = adaptive_scan.nearest(df).toPandas()
    hits = total = 0
    for q, own in out.groupby("query_id"):
        s = x @ x[ids == q][0]
        best = [ids[k] for k in np.lexsort((ids, -s)) if ids[k] != q][:20]
        hits, total = hits + len({*best} & {*own["vec_id"]}), total + 20
    assert hits >= 0.9 * total and out["query_id"].nunique() == (ids % 20 == 0).sum()


@pytest.mark.parametrize("n", [2, 12, 19, 21])
def test_nearest_finds_all_of_few(spark, n):
    rng = np.random.RandomState(n)
    rows = [(20 * k, rng.normal(size=6).tolist(), 0, "", 0) for k in range(n)]
    out = adaptive_scan.nearest(spark.createDataFrame(rows, SCHEMA))
    assert out.count() == n * min(20, n - 1)


def test_nearest_of_few(spark):
    assert adaptive_scan.nearest(spark.createDataFrame([], SCHEMA)).count() == 0
    out = adaptive_scan.nearest(spark.createDataFrame([(0, [1.0, 0.0], 0, "", 0), (1, [1.0, 1.0], 0, "", 0), (40, [0.5, 0.5], 0, "", 0)], SCHEMA))
    assert [tuple(r) for r in out.orderBy("query_id", "rank").collect()] == [
        (0, 1, 1, 1.0), (0, 2, 40, 0.5), (40, 1, 1, 1.0), (40, 2, 0, 0.5)]


def shingles(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 6)))
    base, line, out = [word() for _ in range(90)], " ".join(word() for _ in range(12)), []
    for k in range(60):  # near copies with up to six edits: some link, some do not
        own = base[:]
        for _ in range(rng.randrange(7)):
            own[rng.randrange(90)] = word()
        out.append(" ".join(own))
    out += [" ".join(base)] * 15 + [" ".join(base).upper()]
    out += [f"{line} {' '.join(word() for _ in range(rng.randrange(4, 40)))}\n{line}" for _ in range(40)]
    out += [" ".join(word() for _ in range(rng.randrange(1, 8))) for _ in range(30)]
    out += [None, "", " \t\n", "a", "A", "a b", "É x", "é x", "one two three four", "one two three FOUR", "one two three four five"]
    out += [" ".join(word() for _ in range(4000))]
    out += [out[-1] + " more words at the end"]
    return [(k, t, "x", 1, 2) for k, t in enumerate(out)] + [(3, out[3], "x", 1, 2), (None, out[4], "x", 1, 2)]


DOCS = "doc_id long, text string, item string, n int, key int"


@pytest.mark.parametrize("short", [24, 2])
def test_prefix_join(spark, monkeypatch, short):
    monkeypatch.setattr(postings, "SHORT_LIST", short)
    monkeypatch.setattr(postings, "BLOCK_ROWS", 16 if short == 2 else 512)
    rows = texts()
    sets = [shingles(t) for _, t, *_ in rows]
    groups = Groups()
    for a in range(len(rows)):
        groups.find(a)
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                groups.join(a, b)
    least = collections.defaultdict(list)
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            least[groups.find(k)].append(i)
    want = sorted((str(i), len(sets[k]), min(least[groups.find(k)])) for k, (i, *_) in enumerate(rows))
    out = prefix_join.join(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in out) == want
    assert len({w[2] for w in want}) > 60  # some near copies stay apart


def test_prefix_join_of_nothing_and_survivors(spark):
    assert prefix_join.join(spark.createDataFrame([], DOCS)).count() == 0
    rows = texts()
    left = prefix_join.survivors(spark.createDataFrame(rows, DOCS))
    assert left.columns == ["doc_id", "text", "item", "n", "key"]
    linked = {r["doc_id"]: r["component_id"] for r in prefix_join.join(spark.createDataFrame(rows, DOCS)).collect() if r["doc_id"] is not None}
    assert {r["doc_id"] for r in left.collect()} == {None, *(i for i, c in linked.items() if i == c)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab C\n\t É\x0b\xa0", max_size=40)), max_size=8), st.integers(0, 3))
def test_shingler_counts_like_python(column, skip):
    import pyarrow as pa

    own = list(postings.Shingler().sets(pa.array(column, pa.string()).slice(min(skip, len(column)))))
    assert [len(s) for s in own] == [len(shingles(t)) for t in column[min(skip, len(column)):]]


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2 ** 64 - 1), min_size=1, max_size=80), st.sets(st.integers(0, 2 ** 64 - 1), min_size=1, max_size=80), st.integers(0, 80))
def test_bitmaps_never_drop_a_link(a, b, both):
    a = a | {*list(b)[:both]}
    x, y = (np.sort(np.array([*s], np.uint64)) for s in (a, b))
    p, q = (np.frombuffer(postings.parity(s), np.uint8) for s in (x, y))
    while len(p) != len(q):
        if len(p) > len(q):
            p = p[: len(p) // 2] ^ p[len(p) // 2:]
        else:
            q = q[: len(q) // 2] ^ q[len(q) // 2:]
    assert len(a ^ b) >= int(np.bitwise_count(p ^ q).sum())


def test_paragraph_tuning():
    bands, rows = paragraph_bands.tune(0.75)
    assert 1 - (1 - 0.75 ** rows) ** bands >= 0.995 and 1 - (1 - 0.2 ** rows) ** bands <= 0.3


def test_paragraphs(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(2, 8)))
    prose = lambda n: [word() for _ in range(n)]
    line, rows, planted = " ".join(prose(9)), [], set()
    for k in range(60):
        rows.append([k, " ".join(prose(rng.randrange(60, 300))) + "\n" + line])
    for n in range(12):  # passages of over 50 words in the middle of two texts, broken into lines differently
        passage = prose(rng.randrange(51, 80))
        for k, gap in ((2 * n, " "), (2 * n + 1, "\n")):
            own = rows[k][1].split(" ")
            at = rng.randrange(len(own))
            rows[k][1] = " ".join([*own[:at], gap.join(passage), *own[at:]])
            planted.add(k)
    edited = prose(200)
    rows += [[100, "É " + " ".join(edited)], [101, " ".join(edited[:50] + prose(1) + edited[51:])]]
    rows += [[102, None], [103, ""], [104, line], [105, " ".join(prose(3000))], [106, rows[30][1]], [30, rows[30][1]], [None, rows[31][1]]]
    planted |= {100, 101, 30, 106}
    out = paragraph_bands.repeats(spark.createDataFrame([(*r, "x", 1, 1) for r in rows], DOCS)).collect()
    assert {r["doc_id"] for r in out} == planted
    text = {}
    for i, t in rows:
        text.setdefault(i, t)
    held = collections.defaultdict(set)
    for r in out:
        own = text[r["doc_id"]][r["start"]:r["end"]]
        assert len(own.split()) == 20 and r["removed"] == (r["doc_id"] > r["component_id"])
        held[r["component_id"]].add(r["doc_id"])
    assert all(min(v) == c and len(v) > 1 for c, v in held.items())
    assert paragraph_bands.repeats(spark.createDataFrame([], DOCS)).count() == 0


@settings(deadline=None)
@given(st.integers(0, 2 ** 32 - 1), st.integers(1, 60), st.integers(0, 12), st.integers(50, 99))
def test_sketches_never_drop_a_link(seed, n, changed, threshold):
    rng = np.random.RandomState(seed)
    a = rng.randint(0, 1 << 62, n).astype(np.uint64)
    if n > 2:
        a[rng.randint(n)] = a[rng.randint(n)]  # shingles that come twice count once
    b = np.r_[a[min(changed, n - 1):], rng.randint(0, 1 << 62, changed).astype(np.uint64)]
    at = np.array([0, n, 0])
    end = np.array([n, n + len(b), n + len(b)])
    size, odd = paragraph_bands.sketches(np.r_[a, b], at, end)
    sets = [{*a.tolist()}, {*b.tolist()}, {*a.tolist(), *b.tolist()}]
    assert size.tolist() == [*map(len, sets)]
    assert all(int(o) == sum(1 << p for p, c in collections.Counter(v >> 60 for v in s).items() if c % 2) for s, o in zip(sets, odd))
    edges = paragraph_bands.size_edges()
    most = np.r_[edges[1:] - 1, 1 << 40][np.searchsorted(edges, size, side="right") - 1]
    if 100 * len(sets[0] & sets[1]) >= threshold * len(sets[0] | sets[1]):
        assert paragraph_bands.like(most[:1], odd[:1], most[1:2], odd[1:2], threshold).all()


def test_lists_leave_every_pair_that_can_be_similar():
    rng = np.random.RandomState(4)
    sizes = [1, 2, 3, 7, 20, 24, 25, 60] * 6
    key = np.repeat(np.arange(len(sizes)), sizes)
    item, n = np.arange(len(key)) * 10, rng.choice([16, 16, 17, 30], len(key))
    odd = (rng.choice([0, 0xFFFF, 0x5A5A], len(key)) ^ (1 << rng.randint(0, 16, len(key)))).astype(np.uint16)
    a, b, left = paragraph_bands.tried(key, item, n, odd, 75)
    stars, held, lost = {*zip(b.tolist(), a.tolist())}, set(left.tolist()), 0
    for k in range(len(sizes)):
        own = np.flatnonzero(key == k)
        for x in range(len(own)):
            for y in own[x + 1:]:
                if paragraph_bands.like(n[own[x]], odd[own[x]], n[y], odd[y], 75):
                    lost += (int(item[own[x]]), int(item[y])) not in stars and not {int(own[x]), int(y)} <= held
    assert lost == 0 and 0 < len(held) < len(key) and all(x < y for x, y in stars)


def test_texts_are_read_four_times(spark, tmp_path):
    """Once to count them; to post units, to post windows, for the sets of what met, and to place what is linked."""
    rng, told = random.Random(14), tmp_path / "reads"
    line = [" ".join(prose(rng, 30)) for _ in range(12)]
    rows = [(k, "\n".join([" ".join(prose(rng, 40)), line[k % 12], line[k % 12].replace("a", "b", k % 5)])) for k in range(120)]

    def read(batches):
        with open(told, "a") as f:
            f.write("x")
        yield from batches

    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).mapInPandas(read, "doc_id long, text string")
    assert paragraph_bands.repeats(df).count() > 120
    assert len(told.read_text()) <= 5


def prose(rng, n):
    return ["".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(3, 9))) for _ in range(n)]


def uncovered(out, rows, planted):
    """Planted (document, words) whose words the document's spans do not cover from first to last."""
    text, spans, missed = dict(rows), collections.defaultdict(list), []
    for r in out:
        spans[r["doc_id"]].append((r["start"], r["end"]))
    for k, words in planted:
        at = text[k].index(words)
        held = {p for a, b in spans[k] for p in range(a, b)}
        missed += [(k, words)] * any(p not in held and not text[k][p].isspace() for p in range(at, at + len(words)))
    return missed


def paragraph_rows(spark, rows):
    return paragraph_bands.repeats(spark.createDataFrame([(*r, "x", 1, 1) for r in rows], DOCS)).collect()


def test_short_passages_and_own_paragraphs_are_compared(spark):
    rng, rows, want = random.Random(8), [], set()

    def pair(a, b):
        want.update((len(rows), len(rows) + 1))
        rows.extend([(len(rows), a), (len(rows) + 1, b)])

    inside = lambda p: " ".join(prose(rng, 40) + p + prose(rng, 40))
    for n in (20, 21, 22, 25, 30) * 6:  # in unlike contexts
        passage = prose(rng, n)
        pair(inside(passage), inside(passage))
    for n in (20, 25, 30) * 4:  # whole texts
        passage = " ".join(prose(rng, n))
        pair(passage, passage)
    for n in (10, 13, 19) * 3:  # lines between unlike lines
        line = " ".join(prose(rng, n))
        pair(*("\n".join([" ".join(prose(rng, 30)), line, " ".join(prose(rng, 30))]) for _ in range(2)))
    for n in (40, 50, 80) * 4:  # lines, and blocks of lines, with one word changed
        line = prose(rng, n)
        other = [*line[:n // 2], *prose(rng, 1), *line[n // 2 + 1:]]
        pair(*("\n".join([" ".join(prose(rng, 30)), " ".join(own), " ".join(prose(rng, 30))]) for own in (line, other)))
        pair(*("\n\n".join([" ".join(prose(rng, 30)), "\n".join(own), " ".join(prose(rng, 30))]) for own in (line, other)))
    same = " ".join(["word"] * 30)
    pair(inside([same]), inside([same]))
    rows += [(k, inside([])) for k in range(len(rows), len(rows) + 20)]
    assert sorted({r["doc_id"] for r in paragraph_rows(spark, rows)} ^ want) == []


def test_edited_paragraphs_are_whole(spark):
    rng, rows, planted = random.Random(10), [], []
    for k in range(20):  # the changed words too
        line = prose(rng, 90)
        other = [*line[:30], *prose(rng, 1), *line[31:60], *prose(rng, 1), *line[61:]]
        for own in (line, other):
            planted.append((len(rows), " ".join(own)))
            rows.append((len(rows), "\n".join([" ".join(prose(rng, 30)), " ".join(own), " ".join(prose(rng, 30))])))
    assert uncovered(paragraph_rows(spark, rows), rows, planted) == []


@pytest.mark.parametrize("named", [False, True])
def test_spans_cover_whole_passages(spark, named):
    rng, rows, planted = random.Random(9), [], []
    for n in (20, 33, 51, 60, 74, 100) * 6:
        passage = " ".join(prose(rng, n))
        for _ in range(3):
            planted.append((len(rows), passage))
            rows.append((len(rows), "é " + " ".join([*prose(rng, 30), passage, *prose(rng, 30)])))
    longer = prose(rng, 90)  # the kept document holds less of it than the others share
    for a, b in ((30, 60), (5, 85), (0, 90)):
        planted.append((len(rows), " ".join(longer[max(a, 5):min(b, 85)])))
        rows.append((len(rows), " ".join(prose(rng, 30) + longer[a:b] + prose(rng, 30))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if named:
        df = df.withColumn("doc_id", F.format_string("d%05d", "doc_id"))
    out = [r.asDict() for r in paragraph_bands.repeats(df).collect()]
    if named:
        out = [r | {c: int(r[c][1:]) for c in ("doc_id", "component_id")} for r in out]
    assert uncovered(out, rows, planted) == []
    text, held = dict(rows), collections.defaultdict(set)
    for r in out:  # and nothing else: but for a word or two at its ends a span stands in the kept document too
        words = text[r["doc_id"]][r["start"]:r["end"]].split()
        assert " ".join(words[2:-2]) in text[r["component_id"]] and r["removed"] == (r["doc_id"] > r["component_id"])
        held[r["component_id"]].add(r["doc_id"])
    assert all(min(v) == c and len(v) > 1 for c, v in held.items())


def test_repeated_query_ids_ask_with_one_vector(spark):
    rng = np.random.RandomState(12)
    base, other = rng.normal(size=(900, 8)), rng.normal(size=(45, 4, 8))
    rows = [(k, base[k].tolist()) for k in range(900)] + [(20 * k, v.tolist()) for k in range(45) for v in other[k]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = [collections.defaultdict(list) for _ in range(2)]
    for held, given in zip(out, (df, df.orderBy("embedding").repartition(5))):
        for r in adaptive_scan.nearest(given, probe=1.0).orderBy("query_id", "rank").collect():
            held[r["query_id"]].append((r["vec_id"], r["score"]))
    assert out[0] == out[1] and len(out[0]) == 45
    hashes = {(r["vec_id"], tuple(r["embedding"])): r["h"] for r in df.select("*", F.xxhash64("embedding").alias("h")).collect()}
    for query, got in out[0].items():  # every score is that of the chosen vector
        _, chosen = min((h, v) for (i, v), h in hashes.items() if i == query)
        vectors = collections.defaultdict(list)
        for i, v in rows:
            vectors[i].append(float(np.dot(chosen, v)))
        assert len(got) == 20 and all(any(abs(score - s) < 1e-9 for s in vectors[i]) for i, score in got)


def test_buckets_of_filters_stay_flat():
    """Rows of a direction do not grow with the vectors, and pairs at the threshold still share one."""
    rng = np.random.RandomState(2)
    a, b = rng.normal(size=(2, 200, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.98 * a + np.sqrt(1 - 0.98 ** 2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    for n in (10 ** 5, 10 ** 7, 10 ** 9):
        filters = cap_filters.Filters(64, n)
        (ra, ca), (rb, cb) = filters.decode(a), filters.decode(b)
        met = {*zip(ra.tolist(), ca.tolist())}
        assert len({r for r, c in zip(rb.tolist(), cb.tolist()) if (r, c) in met}) >= 196
        assert n * len(ra) / 200 / 8 / filters.words ** filters.blocks < 32


def test_recent_names():
    from cohortica.llm.common import Recent

    recent, names = Recent(16), [*range(-20, 20), 3, 19, 5, 5]
    assert [recent.new(n) for n in names] == [True] * 40 + [True, True, False, False]

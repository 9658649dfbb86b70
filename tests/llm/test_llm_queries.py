"""The registered queries and the pipeline."""

import hashlib

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cohortica.llm import queries, secret_scan
from cohortica.llm.common import Written, table
from compare import connect, difference

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= {*entry.queries()} and {*queries.ORACLES} <= {*queries.QUERIES}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) is None


@pytest.fixture(scope="module")
def stages(spark):
    out = [table(spark, SF, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(Written(stage(spark, out[-1], SF), name).df)
    return out


def test_pipeline_stages(spark, stages):
    docs, spoken, single, masked, mixed, pieces = (s.toPandas().sort_values("doc_id", ignore_index=True) for s in stages)
    assert all(list(s.columns) == list(docs.columns) for s in (spoken, single, masked, mixed))
    assert set(spoken["doc_id"]) == {i for i, t in zip(docs["doc_id"], docs["text"]) if any(c.isalpha() for c in t or "")}
    # One of each group stays: no two kept texts reach the threshold, each one gone has a link to the group of a kept one.
    sets = {i: shingles(t) for i, t in zip(spoken["doc_id"], spoken["text"])}
    ids, up = sorted(sets), {i: i for i in sets}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                up[max(find(a), find(b))] = min(find(a), find(b))
    assert single["doc_id"].tolist() == [i for i in ids if find(i) == i]
    assert masked["doc_id"].tolist() == single["doc_id"].tolist()
    assert masked["text"].tolist() == [secret_scan.redact(t) for t in single["text"]]
    assert (masked["n_chars"] == masked["text"].str.len()).all()
    gone = set(masked["doc_id"]) - set(mixed["doc_id"])
    labels = table(spark, SF, "labels").toPandas().set_index("doc_id")
    clean = [i for i in masked["doc_id"] if i in labels.index and labels["quality"][i] == 1 and labels["toxic"][i] == 0]
    assert gone and len([i for i in clean if i in gone]) <= 0.05 * len(clean)
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert pieces["doc_id"].tolist() == mixed["doc_id"].tolist()
    for text, ids, digest in zip(mixed["text"], pieces["ids"], pieces["decoded_sha256"]):
        assert list(ids) == model.encode(text) and digest == hashlib.sha256(model.decode([*map(int, ids)]).encode()).hexdigest()


def shingles(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_pipeline_runs_whole(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).drop("ids").collect())) == sorted(map(tuple, stages[-1].drop("ids").collect()))


def test_pipeline_of_no_documents(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_stages_take_odd_rows(spark):
    schema = table(spark, SF, "documents").schema
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "the and of", "en", "s", 9), (4, "der die und", "de", None, None),
            (4, "der die und", "de", None, None), (5, "the cat " * 9000, "en", "s", 1)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() >= 2


@pytest.mark.parametrize("name", ["op1_cap_filters", "op3_adaptive_scan", "op12_uniform_threshold", "op13_conversation_repair"])
def test_nothing_but_the_result_stays(spark, name):
    from cohortica.workspace import shared_folder

    def held():
        return {p.getPath().getName() for p in files.listStatus(path)}

    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    before = held()
    out = queries.QUERIES[name](spark, SF)
    assert len(held() - before) == 1 and out.count() > 0


def test_a_failed_operator_leaves_nothing(spark):
    from cohortica.llm.common import scoped
    from cohortica.workspace import shared_folder

    @scoped
    def inner():
        return Written(spark.range(3).toDF("id"), "inner-table").df.where("id > 0")

    @scoped
    def outer(fails):
        found = inner()
        Written(found, "outer-table")
        if fails:
            raise ValueError("stopped")
        return found

    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    before = {p.getPath().getName() for p in files.listStatus(path)}
    with pytest.raises(ValueError):
        outer(True)
    assert {p.getPath().getName() for p in files.listStatus(path)} == before
    assert sorted(r["id"] for r in outer(False).collect()) == [1, 2]
    assert [p.getPath().getName().split("-")[0] for p in files.listStatus(path) if p.getPath().getName() not in before] == ["outer"]

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortica.operators import split


def frame(spark, sizes):
    rows = [(i, c) for c, n in enumerate(sizes) for i in range(sum(sizes[:c]), sum(sizes[:c + 1]))]
    return spark.createDataFrame(rows, "row_id bigint, label int")


@given(st.lists(st.integers(2, 500), min_size=2, max_size=6), st.sampled_from([0.1, 0.2, 0.25, 0.5]))
@settings(max_examples=200, deadline=None)
def test_quota_is_exact(sizes, share):
    counts = dict(enumerate(sizes))
    quota = split.test_quota(counts, share)
    assert sum(quota.values()) == math.ceil(share * sum(sizes))
    for c, n in counts.items():
        assert abs(quota[c] - n * sum(quota.values()) / sum(sizes)) <= 1


@given(st.lists(st.integers(3, 300), min_size=1, max_size=5), st.integers(2, 5))
@settings(max_examples=200, deadline=None)
def test_fold_sizes_differ_by_at_most_one(sizes, k):
    got = split.fold_sizes(dict(enumerate(sizes)), range(len(sizes)), k)
    for c, n in enumerate(sizes):
        assert sum(got[c]) == n and max(got[c]) - min(got[c]) <= 1
    totals = [sum(got[c][i] for c in got) for i in range(k)]
    assert max(totals) - min(totals) <= 1


def test_fold_sizes_by_hand():
    # sorted labels 0000000 11111 222 dealt to three folds in turn
    assert split.fold_sizes({0: 7, 1: 5, 2: 3}, [0, 1, 2], 3) == {0: [3, 2, 2], 1: [1, 2, 2], 2: [1, 1, 1]}


def test_split_and_folds_do_not_depend_on_layout(spark):
    df = frame(spark, [700, 50, 13])
    one = split.stratified_split(df.repartition(1), "label", "row_id")
    many = split.stratified_split(df.repartition(11), "label", "row_id")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    got = {r["label"]: r["n"] for r in one.groupBy("label").agg(F.sum(F.col("is_test").cast("int")).alias("n")).collect()}
    assert got == split.test_quota({0: 700, 1: 50, 2: 13}, 0.2)
    train = one.where("not is_test")
    a = split.stratified_folds(train.repartition(1), "label", "row_id")
    b = split.stratified_folds(train.repartition(5), "label", "row_id")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    sizes = [r["count"] for r in a.groupBy("label", "fold").count().where("label = 0").collect()]
    assert max(sizes) - min(sizes) <= 1 and len(sizes) == 3


def test_split_follows_hash_order(spark):
    df = split.stratified_split(frame(spark, [200, 90]), "label", "row_id", 0.3, seed=7)
    rows = df.withColumn("h", split.order_hash(7, F.col("row_id"))).collect()
    for c in (0, 1):
        mine = sorted((r["h"], r["is_test"]) for r in rows if r["label"] == c)
        flags = [t for _, t in mine]
        assert flags == sorted(flags)


def test_tiny_classes_are_refused(spark):
    with pytest.raises(ValueError):
        split.stratified_split(frame(spark, [5, 1]), "label", "row_id")
    with pytest.raises(ValueError):
        split.stratified_folds(frame(spark, [5, 2]), "label", "row_id", 3)


def test_row_ids_are_stable_and_unique(spark):
    df = spark.createDataFrame([(1, "a")] * 57 + [(2, None)] * 3 + [(3, "")], "x int, s string")
    a = split.row_ids(df.repartition(1), chunk=10)
    b = split.row_ids(df.repartition(6), chunk=1000)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert a.select("row_id").distinct().count() == 61


def test_labels_and_weights(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "t string")
    labels = split.class_labels(df, "t")
    assert labels == ["a", "b"]
    coded = split.encode(df, "t", labels)
    assert sorted(str(r["label"]) for r in coded.collect()) == ["0", "0", "1", "None"]
    assert split.balanced_weights({0: 2, 1: 1}) == {0: 0.75, 1: 1.5}

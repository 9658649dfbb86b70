import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortica.operators import profile
from cohortica.operators.quantiles import medians, quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]


@pytest.mark.parametrize("accuracy", [None, 3, 200])
def test_against_numpy_with_hot_values_and_groups(spark, accuracy):
    rng = np.random.default_rng(0)
    rows = [("a", float(v)) for v in rng.normal(size=8000)]
    rows += [("b", 3.0)] * 5000 + [("b", float(v)) for v in rng.integers(0, 6, 3000)]
    rows += [("c", 1.5), ("c", 2.5), ("c", None), (None, 7.0)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    got = {(r["g"], r["prob"]): r["value"] for r in quantiles(df, ["x"], PROBS, ["g"], accuracy).collect()}
    for g in ("a", "b", "c", None):
        values = [v for k, v in rows if k == g and v is not None]
        for p in PROBS:
            assert got[(g, p)] == pytest.approx(np.percentile(values, p * 100), abs=1e-12)


def test_a_bracket_is_a_small_share(spark, monkeypatch):
    """Of many distinct values few are ranked; and a sketch that misses its rank is made good."""
    from cohortica.operators import quantiles as module

    rng = np.random.default_rng(5)
    x = rng.normal(size=60_000)
    df = spark.createDataFrame([(float(v), float(k % 3)) for k, v in enumerate(x)], "x double, y double").repartition(4)
    want = [np.percentile(x, 100 * p) for p in PROBS]
    ranked, exact = [], module._ranked
    monkeypatch.setattr(module, "_ranked", lambda *a: ranked.append(a[-1]) or exact(*a))
    got = {r["prob"]: r["value"] for r in quantiles(df, ["x", "y"], PROBS).where("column = 'x'").collect()}
    assert [got[p] for p in PROBS] == pytest.approx(want, abs=1e-12) and ranked == [1000]
    monkeypatch.setattr(module.F, "percentile_approx", lambda v, ends, accuracy: F.transform(ends, lambda e: F.lit(9.0)))
    got = {r["prob"]: r["value"] for r in quantiles(df.groupBy("x").count(), ["x"], PROBS).collect()}
    assert [got[p] for p in PROBS] == pytest.approx(want, abs=1e-12) and ranked == [1000, 1000, None]


def test_the_narrowed_query_narrows(spark, tmp_path, monkeypatch):
    """d2_narrowed_quantiles ranks a share of the values of groups of a few hundred rows, and finds their medians."""
    import sys

    import __spark_entry__ as entry

    rng = np.random.default_rng(8)
    rows = [(f, "O", *map(float, v)) for f, n in (("A", 900), ("N", 331), (None, 200)) for v in rng.normal(size=(n, 4))] + [("R", "F", 1.0, None, 2.0, None)]
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    df = spark.createDataFrame(rows, "l_returnflag string, l_linestatus string, " + ", ".join(f"{c} double" for c in cols))
    df.write.parquet(f"{tmp_path}/lineitem.parquet")
    module, ranked = sys.modules["cohortica.operators.quantiles"], []
    exact = module._ranked
    monkeypatch.setattr(module, "_ranked", lambda *a: ranked.append(a[-1]) or exact(*a))
    got = {(r["l_returnflag"], r["column"]): r["value"] for r in entry.queries()["d2_narrowed_quantiles"](spark, str(tmp_path)).collect()}
    want = {(f, c): np.median(v) for f in ("A", "N", "R", None) for i, c in enumerate(cols)
            if (v := [r[i + 2] for r in rows if r[0] == f and r[i + 2] is not None])}
    assert got == pytest.approx(want, abs=1e-4) and ranked == [40]


def test_medians_skip_null_columns(spark):
    df = spark.createDataFrame([(1, None), (2, None), (4, None), (8, None), (None, None)], "a int, b double")
    assert medians(df, ["a", "b"]) == {"a": 3.0, "b": None}


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(1)
    data = {"n": rng.normal(size=2000), "u": np.round(rng.uniform(0, 1, 2000), 1),
            "w": rng.integers(0, 4, 2000).astype(float), "k": np.full(2000, 5.0)}
    df = spark.createDataFrame([tuple(float(data[c][i]) for c in data) for i in range(2000)], list(data))
    got = profile.histogram(df).orderBy("column", "bin").collect()
    for c, values in data.items():
        n, edges = np.histogram(values, bins="auto")
        mine = [r for r in got if r["column"] == c]
        assert [r["n"] for r in mine] == n.tolist()
        assert [r["low"] for r in mine] == pytest.approx(edges[:-1].tolist())
    whole = profile.histogram(spark.createDataFrame([(int(v),) for v in data["w"]], "w int"))
    assert whole.count() == len(np.histogram(data["w"].astype(int), bins="auto")[0])


def test_density(spark):
    x = np.random.default_rng(2).normal(size=500)
    df = spark.createDataFrame([(float(v), 1.0) for v in x], "x double, flat double").repartition(3)
    got = profile.density(df).orderBy("point").collect()
    grid = np.linspace(x.min(), x.max(), 200)
    h = x.std(ddof=1) * 500 ** -0.2
    want = np.exp(-0.5 * ((grid[:, None] - x[None]) / h) ** 2).sum(1) / (500 * h * np.sqrt(2 * np.pi))
    assert [r["density"] for r in got] == pytest.approx(want.tolist(), abs=1e-11)


def test_boxes_and_outliers(spark):
    rows = [("a", float(v)) for v in (1, 2, 3, 4, 100)] + [("b", 1.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    box = {r["class"]: r for r in profile.box_summary(df, ["x"], "g").collect()}
    assert (box["a"]["whisker_low"], box["a"]["whisker_high"], box["a"]["n_outliers"]) == (1.0, 4.0, 1)
    assert [tuple(r) for r in profile.box_outliers(df, ["x"], "g").collect()] == [("a", "x", 100.0)]


def test_correlation_wide_and_narrow_agree(spark):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(300, 22))
    df = spark.createDataFrame([tuple(map(float, r)) for r in m], [f"c{i}" for i in range(22)])
    want = np.corrcoef(m.T)
    for r in profile.correlation(df).collect():
        assert r["r"] == pytest.approx(want[int(r["col_a"][1:]), int(r["col_b"][1:])], abs=1e-9)
    with_null = df.withColumn("c0", F.when(F.col("c1") > 0, F.col("c0")))
    keep = m[:, 1] > 0
    r = profile.correlation(with_null).where("col_a = 'c5' and col_b = 'c0'").first()["r"]
    assert r == pytest.approx(np.corrcoef(m[keep, 5], m[keep, 0])[0, 1])


def test_crosstab_has_zero_for_absent_class(spark):
    df = spark.createDataFrame([("x", "A"), ("x", "B"), ("y", "A")], "v string, t string")
    got = {r["value"]: (r["A"], r["B"]) for r in profile.crosstab(df, "v", "t", ["A", "B"]).collect()}
    assert got == {"x": (0.5, 0.5), "y": (1.0, 0.0)}

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortica.operators import preprocess

SCHEMA = "row_id int, `a (b)` double, flat int, s string, one string, flag boolean"
ROWS = [(0, 1.0, 5, "x", "k", True), (1, 2.0, 5, "y'z", "k", False), (2, 4.0, 5, None, None, None),
        (3, 8.0, 5, "y'z", "k", True), (4, None, 5, "x", "k", True), (5, float("nan"), None, "w\\", "k", True)]
FEATURES = ["a (b)", "flat", "s", "one", "flag"]


def matrix(fitted, df):
    out = fitted.transform(df).select("row_id", vector_to_array("features").alias("v")).orderBy("row_id").collect()
    return np.array([r["v"] for r in out])


def test_matrix_by_hand(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    fitted = preprocess.fit(df, FEATURES)
    assert fitted.medians == {"a (b)": 3.0, "flat": 5.0}
    assert fitted.modes["s"] == "x"  # tie: the smaller text
    assert fitted.feature_names == ["num__a (b)", "num__flat", "cat__s_x", "cat__s_y'z", "cat__flag_true"]
    got = matrix(fitted, df)
    a = np.array([1, 2, 4, 8, 3, 3.0])
    np.testing.assert_allclose(got[:, 0], (a - a.mean()) / a.std())
    assert (got[:, 1] == 0).all()
    np.testing.assert_array_equal(got[:, 2:4], [[1, 0], [0, 1], [1, 0], [0, 1], [1, 0], [0, 0]])
    np.testing.assert_array_equal(got[:, 4], [1, 0, 1, 1, 1, 1])
    assert got[:, 0].mean() == pytest.approx(0) and got[:, 0].var() == pytest.approx(1)


def test_unseen_category_gives_zeros(spark):
    fitted = preprocess.fit(spark.createDataFrame(ROWS, SCHEMA), FEATURES)
    new = spark.createDataFrame([(0, 3.0, 5, "new", "other", False)], SCHEMA)
    assert matrix(fitted, new)[0, 2:].tolist() == [0, 0, 0]


def test_flags_come_first_and_are_not_scaled(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    fitted = preprocess.fit(df, FEATURES, ["a (b)"], threshold=2)
    assert fitted.feature_names[0] == "binarize__a (b)"
    assert matrix(fitted, df)[:, 0].tolist() == [0, 1, 1, 1, 0, 0]
    with pytest.raises(ValueError):
        preprocess.fit(df, FEATURES, ["absent"])
    path = str(tmp_path / "pre")
    fitted.model.write().save(path)
    again = PipelineModel.load(path).transform(df).select(vector_to_array("features")).collect()
    assert again == fitted.transform(df).select(vector_to_array("features")).collect()


def test_transform_has_no_python_and_no_shuffle(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    plan = preprocess.fit(df, FEATURES).transform(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "InPandas" not in plan


def test_many_categories(spark):
    df = spark.range(12_000).select(F.format_string("c%05d", "id").alias("s"))
    fitted = preprocess.fit(df, ["s"])
    assert len(fitted.feature_names) == 11_999
    seen = df.limit(3).union(spark.createDataFrame([("new",), (None,)], "s string"))
    rows = fitted.transform(seen).select("features").collect()
    # The first category and unseen texts are all zero; null takes the mode, here the first on a tie.
    assert [r["features"].numNonzeros() for r in rows] == [0, 1, 1, 0, 0]

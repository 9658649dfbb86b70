import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cohortica.functions import columns as C
from cohortica.operators import clean as cl
from cohortica.sources import delimited as raw


def write(tmp_path, text, name="raw.csv", bom=False):
    path = tmp_path / name
    path.write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.encode())
    return str(path)


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        raw.read_raw(spark, str(tmp_path / "none.csv"))


def test_raw_edges(spark, tmp_path):
    text = '"id";" name "\t;"x\t"\n1;" x ";"2"\n2;"";3\n3;NA;4\n4;"NA";5\n5;  y  ;6\n6;;7\n'
    df = raw.load_clean(spark, write(tmp_path, text, bom=True))
    assert df.columns == ["id", "name", "x"]
    assert dict(df.dtypes) == {"id": "bigint", "name": "string", "x": "bigint"}
    rows = {r["id"]: (r["name"], r["x"]) for r in df.collect()}
    # rows 3 and 6 go; quoted empty and quoted NA become null but stay; blanks inside quotes stay
    assert rows == {1: (" x ", 2), 2: (None, 3), 4: (None, 5), 5: ("y", 6)}


def test_strict_header_keeps_blanks_inside_quotes(spark, tmp_path):
    path = write(tmp_path, '"a\t";"b"\n1;2\n')
    assert raw.load_clean(spark, path, strict_header=True).columns == ["a\t", "b"]
    assert raw.load_clean(spark, path).columns == ["a", "b"]


def test_short_rows_are_padded_and_long_rows_fail(spark, tmp_path):
    short = raw.read_raw(spark, write(tmp_path, "a;b;c\n1;2\n3;4;5\n"))
    assert sorted((r["a"], r["b"], r["c"]) for r in short.collect()) == [("1", "2", None), ("3", "4", "5")]
    long = raw.read_raw(spark, write(tmp_path, "a;b\n1;2\n3;4;5\n", "long.csv"))
    with pytest.raises(Exception, match="more than 2 fields"):
        long.count()


def test_type_inference(spark):
    df = spark.createDataFrame([("1", "1.5", "x", "1", None), ("-2", "1e3", "2", "1d", None), (None, ".5", "3", "2", None)],
                               "a string, b string, c string, d string, e string")
    assert dict(raw.infer_types(df).dtypes) == {
        "a": "bigint", "b": "double", "c": "string", "d": "string", "e": "string"}


def test_clean_modes(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (float("nan"), "c"), (4.0, None)], "x double, s string")
    assert [tuple(r) for r in cl.clean(df).collect()] == [(1.0, "a")]
    assert sorted(r["x"] for r in cl.clean(df, "median").collect()) == [1.0, 2.5, 2.5, 4.0]
    with pytest.raises(ValueError):
        cl.clean(df, "other")


def test_binarise(spark):
    df = spark.createDataFrame([(0.0,), (0.999,), (1.0,), (-1.0,), (None,), (float("nan"),)], "x double")
    assert [r["x"] for r in cl.binarise(df, ["x"]).collect()] == [0, 0, 1, 0, 0, 0]
    with pytest.raises(ValueError):
        cl.binarise(df, ["y"])


def test_select_features_reports_missing(spark):
    df = spark.createDataFrame([(1, 2, "t")], "`a (b)` int, c int, Target string")
    out, missing = cl.select_features(df, ["a (b)", "zz"], "Target")
    assert out.columns == ["a (b)", "Target"] and missing == ["zz"]


def test_small_functions(spark):
    df = spark.createDataFrame([(-1,), (0,), (2,), (3,)], "c int")
    assert [r[0] for r in df.select(C.class_name(F.col("c"), ["x", "y", "z"])).collect()] == ["Unknown", "x", "z", "Unknown"]
    bands = spark.createDataFrame([(0.8,), (0.81,), (0.6,), (0.61,)], "p double").select(C.confidence_band(F.col("p")))
    assert [r[0] for r in bands.collect()] == ["Medium", "High", "Low", "Medium"]
    names = spark.createDataFrame([("a/b\\c d\te",)], "n string").select(C.safe_file_name(F.col("n")))
    assert names.first()[0] == "a_b_c_d_e"
    psi = spark.createDataFrame([(1,), (2,), (10,)], "n int").select(C.digamma(F.col("n")))
    assert [r[0] for r in psi.collect()] == pytest.approx([-0.5772156649, 0.4227843351, 2.2517525890], abs=1e-8)


def test_numeric_kinds(spark):
    df = spark.createDataFrame([(1, 1.0, True, "s")], "i int, d double, b boolean, s string")
    assert C.split_columns(df) == (["i", "d"], ["b", "s"])

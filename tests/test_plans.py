import re

from pyspark.sql import functions as F

from cohortica.operators import metrics, profile
from cohortica.plans.cases import scores, table
from cohortica.workspace import small_side


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def schemas(df, name):
    """Columns read by the scans of a given table; written intermediate tables are scans of their own."""
    scans = [line for line in plan(df).split("\n") if "FileScan" in line and f"{name}.parquet" in line]
    return [re.search(r"ReadSchema: struct<([^>]*)>", line).group(1) for line in scans]


def test_profiles_read_only_their_columns(spark, sf):
    lines = table(spark, sf, "lineitem")
    for df, cols in (
        (profile.value_counts(lines, "l_returnflag"), {"l_returnflag"}),
        (profile.counts_by_class(lines, ["l_linenumber"], "l_linestatus"), {"l_linenumber", "l_linestatus"}),
        (profile.histogram(lines, ["l_tax"], 20), {"l_tax"}),
        (profile.box_summary(lines, ["l_tax"], "l_returnflag"), {"l_tax", "l_returnflag"}),
    ):
        for s in schemas(df, "lineitem"):
            assert {c.split(":")[0] for c in s.split(",")} <= cols


def test_no_window_spans_a_table(spark, sf):
    for df in (metrics.full_report(scores(spark, sf)), profile.describe(table(spark, sf, "orders"), ["o_totalprice"])):
        assert "SinglePartition" not in plan(df)


def test_filters_reach_the_scan(spark, sf):
    df = table(spark, sf, "orders").where("o_totalprice > 1000")
    pushed = re.search(r"PushedFilters: \[([^]]*)\]", plan(profile.value_counts(df, "o_orderstatus"))).group(1)
    assert "GreaterThan(o_totalprice,1000.0)" in pushed and "IsNotNull(o_orderstatus)" in pushed


def test_broadcast_only_after_a_size_check(spark):
    big, little = spark.range(100), spark.range(5)
    kept = small_side(big, 10)
    assert kept is big
    joined = plan(spark.range(10_000).join(small_side(little, 10), "id"))
    assert "BroadcastHashJoin" in joined
    assert small_side(little, 10).agg(F.sum("id")).first()[0] == 10

"""Sources, sinks, filters, scalar functions."""

from pyspark.sql import functions as F

from cohortica.functions import columns as C
from cohortica.operators import clean as cl
from cohortica.operators import metrics, registry
from cohortica.operators.profile import drop_null
from cohortica.plans.cases import (
    BINARISED, CASES_SQL, CLASSES, FEATURES, MODELS, SCORES_SQL, cases, scores, table,
)
from cohortica.plans.catalogue import query, rounded
from cohortica.plans.training import matrix_table
from cohortica.sources import delimited as raw
from cohortica.sources import tables as T
from cohortica.workspace import fresh_path

CUSTOMER_SQL = ("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment "
                "FROM customer")
CASE_COLUMNS = ", ".join(["case_id", *FEATURES, "outcome"])


def _written(spark, sf, name):
    path = fresh_path(spark, f"raw-{name}")
    table(spark, sf, name).write.option("sep", ";").option("quoteAll", True).option("header", True).csv(path)
    return path


@query("a1_raw_read", CUSTOMER_SQL)
def a1(spark, sf):
    return raw.load_clean(spark, _written(spark, sf, "customer"))


@query("a3_header", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def a3(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return raw.normalise_header(df.toDF(*[f' "{c}\t" ' for c in df.columns]))


@query("a4_cells", "SELECT p_partkey, p_name, p_brand FROM part")
def a4(spark, sf):
    wrap = [F.concat(F.lit('\t "'), c, F.lit('"\n ')).alias(c) for c in ("p_name", "p_brand")]
    return raw.normalise_cells(table(spark, sf, "part").select("p_partkey", *wrap))


@query("a5_types", "SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, "
                   "o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def a5(spark, sf):
    df = table(spark, sf, "orders").drop("o_orderdate")
    return raw.infer_types(df.select(*[F.col(c).cast("string") for c in df.columns]))


@query("a6_row_lengths", "SELECT count(*) FILTER (o_orderkey % 10 = 0) AS long_rows, "
                         "count(*) FILTER (o_orderkey % 10 = 1) AS short_rows, count(*) AS all_rows FROM orders")
def a6(spark, sf):
    path = fresh_path(spark, "lengths")
    key = F.col("o_orderkey")
    third = F.when(key % 10 == 0, ";x;y").when(key % 10 == 1, "").otherwise(";x")
    rows = table(spark, sf, "orders").select(F.concat(key.cast("string"), F.lit(";"), "o_orderstatus", third).alias("v"))
    rows.withColumnRenamed("v", "key;status;third").write.option("header", True).option("quote", "\u0000").csv(path)
    return raw.bad_rows(spark, path)


@query("a7_save_clean", "SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier")
def a7(spark, sf):
    path = fresh_path(spark, "supplier-csv")
    T.save_table(table(spark, sf, "supplier"), path, "csv")
    return T.load_table(spark, path, "csv")


@query("a8_load_clean", f"WITH {CASES_SQL} SELECT {CASE_COLUMNS} FROM cases "
                        f"WHERE {' AND '.join(f'{c} IS NOT NULL' for c in FEATURES)}")
def a8(spark, sf):
    path = fresh_path(spark, "clean")
    T.save_table(cl.clean(cases(spark, sf)), path)
    return T.load_table(spark, path)


@query("a9_serving_read", "SELECT c_custkey, CAST(c_nationkey >= 1 AS INTEGER) AS c_nationkey, "
                          "CAST(c_acctbal >= 1 AS INTEGER) AS c_acctbal FROM customer")
def a9(spark, sf):
    path = fresh_path(spark, "serving")
    T.save_table(table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal"), path)
    return T.load_serving(spark, path, ["c_nationkey", "c_acctbal"])


REPORT_SQL = SCORES_SQL + """,
cells AS (SELECT model, label, prediction, count(*) AS n FROM predicted GROUP BY ALL),
codes AS (SELECT model, label AS class FROM cells UNION SELECT model, prediction FROM cells),
tallies AS (
  SELECT c.model, c.class,
    coalesce(sum(n) FILTER (label = class AND prediction = class), 0) AS tp,
    coalesce(sum(n) FILTER (label = class), 0) AS support,
    coalesce(sum(n) FILTER (prediction = class), 0) AS predicted
  FROM codes c JOIN cells USING (model) GROUP BY c.model, c.class),
rates AS (
  SELECT model, class, tp, support, CASE WHEN predicted = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / predicted END AS p,
    CASE WHEN support = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / support END AS r,
    CASE WHEN predicted + support = 0 THEN 0 ELSE CAST(2 * tp AS DOUBLE) / (predicted + support) END AS f FROM tallies),
report_rows AS (
  SELECT model, CAST(class AS VARCHAR) AS row_label, p AS precision, r AS recall, f AS f1_score,
    CAST(support AS DOUBLE) AS support FROM rates
  UNION ALL SELECT model, 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support),
    sum(tp) / sum(support) FROM rates GROUP BY model
  UNION ALL SELECT model, 'macro avg', avg(p), avg(r), avg(f), CAST(sum(support) AS DOUBLE) FROM rates GROUP BY model
  UNION ALL SELECT model, 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
    sum(f * support) / sum(support), CAST(sum(support) AS DOUBLE) FROM rates GROUP BY model),
class_scores AS (
  SELECT model, 0 AS class, p0 AS score, CAST(label = 0 AS BIGINT) AS hit FROM predicted
  UNION ALL SELECT model, 1, p1, CAST(label = 1 AS BIGINT) FROM predicted
  UNION ALL SELECT model, 2, p2, CAST(label = 2 AS BIGINT) FROM predicted),
ranked AS (
  SELECT model, class, hit, rank() OVER (PARTITION BY model, class ORDER BY score)
    + (count(*) OVER (PARTITION BY model, class, score) - 1) / 2.0 AS rk FROM class_scores),
class_auc AS (
  SELECT model, class, sum(hit) AS positives, sum(1 - hit) AS negatives,
    (sum(CASE WHEN hit = 1 THEN CAST(rk AS DOUBLE) ELSE 0 END) - CAST(sum(hit) AS DOUBLE) * (sum(hit) + 1) / 2)
      / (CAST(sum(hit) AS DOUBLE) * sum(1 - hit)) AS auc FROM ranked GROUP BY model, class),
model_auc AS (SELECT model, sum(auc * positives) / sum(positives) AS roc_auc FROM class_auc GROUP BY model),
reports AS (
  SELECT *, CAST(NULL AS DOUBLE) AS roc_auc FROM report_rows
  UNION ALL SELECT model, 'roc_auc', NULL, NULL, NULL, NULL, roc_auc FROM model_auc)
"""
REPORT_COLUMNS = ("model, row_label, round(precision, 6) AS precision, round(recall, 6) AS recall, "
                  "round(f1_score, 6) AS f1_score, round(support, 6) AS support, round(roc_auc, 6) AS roc_auc")
REPORT_ROWS = f"WITH {REPORT_SQL} SELECT {REPORT_COLUMNS} FROM reports"


def reports(spark, sf):
    return metrics.full_report(scores(spark, sf))


def _report_columns(df):
    return rounded(df.select("model", "row_label", "precision", "recall", "f1_score", "support", "roc_auc"))


@query("a10_report_scan", REPORT_ROWS)
def a10(spark, sf):
    folder = fresh_path(spark, "report-files")
    T.save_report_files(reports(spark, sf), folder, MODELS)
    return _report_columns(T.load_report_files(spark, folder))


@query("a12_report_table", REPORT_ROWS)
def a12(spark, sf):
    folder = fresh_path(spark, "reports")
    T.save_reports(reports(spark, sf), folder)
    return _report_columns(T.load_reports(spark, folder))


@query("a17_left_to_train", f"""WITH {REPORT_SQL}, configs(model) AS (
  SELECT upper(pre || '_' || v) FROM (VALUES ('base'), ('binn')) p(pre), (VALUES ('lr'), ('lr_balance'), ('lr_smote'),
    ('rf'), ('rf_balance'), ('rf_smote'), ('rf_grid'), ('rf_grid_smote'), ('xgb'), ('xgb_smote'), ('xgb_grid'),
    ('xgb_grid_smote')) c(v))
SELECT model FROM configs WHERE model NOT IN (SELECT model FROM reports)""")
def a17(spark, sf):
    return registry.left_to_train(matrix_table(spark).select("model"), reports(spark, sf))


@query("a18_safe_names", r"SELECT page_id, translate(url, '/\ ' || chr(9), '____') AS safe FROM pages")
def a18(spark, sf):
    return table(spark, sf, "pages").select("page_id", C.safe_file_name(F.col("url")).alias("safe"))


@query("b1_select_features", f"WITH {CASES_SQL} SELECT total_price, segment, sum_qty, outcome FROM cases")
def b1(spark, sf):
    return cl.select_features(cases(spark, sf), ["total_price", "segment", "not there", "sum_qty"], "outcome")[0]


@query("b2_drop_target", f"WITH {CASES_SQL} SELECT case_id, {', '.join(FEATURES)} FROM cases")
def b2(spark, sf):
    return cases(spark, sf).drop("outcome")


KINDS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{k}' AS kind, count({c}) AS n_present FROM cases"
    for c, k in [("case_id", "numeric"), *[(f, "numeric") for f in FEATURES[:6]],
                 ("priority", "categorical"), ("segment", "categorical"), ("outcome", "categorical")])


@query("b3_column_kinds", f"WITH {CASES_SQL} {KINDS_SQL}")
def b3(spark, sf):
    df = cases(spark, sf)
    numeric, _ = C.split_columns(df)
    present = C.melt_text(df, df.columns).groupBy("column").agg(F.count("value").alias("n_present"))
    kind = F.when(F.col("column").isin(numeric), "numeric").otherwise("categorical")
    return present.select("column", kind.alias("kind"), "n_present")


@query("b4_drop_nulls", f"WITH {CASES_SQL} SELECT {CASE_COLUMNS} FROM cases "
                        f"WHERE {' AND '.join(f'{c} IS NOT NULL' for c in FEATURES)}")
def b4(spark, sf):
    return cl.clean(cases(spark, sf))


@query("b5_fill_median", f"""WITH {CASES_SQL}, mid AS (
  SELECT median(n_lines) AS m1, median(sum_qty) AS m2, median(max_disc) AS m3 FROM cases)
SELECT case_id, round(coalesce(n_lines, m1), 6) AS n_lines, round(coalesce(sum_qty, m2), 6) AS sum_qty,
  round(coalesce(max_disc, m3), 6) AS max_disc, priority FROM cases, mid""")
def b5(spark, sf):
    df = cases(spark, sf).select("case_id", "n_lines", "sum_qty", "max_disc", "priority")
    return rounded(cl.fill_median(df, ["n_lines", "sum_qty", "max_disc"]))


@query("b6_binarise", f"""WITH {CASES_SQL} SELECT case_id, CAST(coalesce(n_lines >= 1, FALSE) AS INTEGER) AS n_lines,
  CAST(coalesce(nation_code >= 1, FALSE) AS INTEGER) AS nation_code, total_price FROM cases""")
def b6(spark, sf):
    return cl.binarise(cases(spark, sf).select("case_id", "n_lines", "nation_code", "total_price"), BINARISED)


@query("b7_drop_null_column", f"WITH {CASES_SQL} SELECT case_id, priority FROM cases WHERE priority IS NOT NULL")
def b7(spark, sf):
    return drop_null(cases(spark, sf).select("case_id", "priority"), "priority")


@query("b9_override", f"WITH {CASES_SQL} SELECT case_id, CAST(3 AS BIGINT) AS n_lines, 'BUILDING' AS segment, "
                      "CAST(0.5 AS DOUBLE) AS extra FROM cases")
def b9(spark, sf):
    df = cl.override(cases(spark, sf), {"n_lines": 3, "segment": "BUILDING", "extra": 0.5})
    return df.select("case_id", F.col("n_lines").cast("bigint").alias("n_lines"), "segment", "extra")


SUMMARY_SQL = """
SELECT model, max(f1_score) FILTER (row_label = 'accuracy') AS accuracy,
  max(precision) FILTER (row_label = 'weighted avg') AS precision,
  max(recall) FILTER (row_label = 'weighted avg') AS recall,
  max(f1_score) FILTER (row_label = 'weighted avg') AS f1,
  max(roc_auc) FILTER (row_label = 'roc_auc') AS roc_auc FROM reports GROUP BY model"""


@query("b10_rounded_metrics", f"""WITH {REPORT_SQL}, s AS ({SUMMARY_SQL})
SELECT model, round(accuracy, 4) AS accuracy, round(precision, 4) AS precision, round(recall, 4) AS recall,
  round(f1, 4) AS f1, round(roc_auc, 4) AS roc_auc FROM s""")
def b10(spark, sf):
    return registry.rounded_metrics(registry.summary(reports(spark, sf)))


SPACES_SQL = "' ' || " + " || ".join(f"chr({ord(c)})" for c in C.WHITESPACE if c != " ")


@query("h1_strip", f"""SELECT doc_id, md5(trim(trim(text, {SPACES_SQL}), '"')) AS stripped, length(text) AS n FROM documents""")
def h1(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(C.strip_cell(F.col("text"))).alias("stripped"), F.length("text").cast("bigint").alias("n"))


@query("h2_replace", r"SELECT conv_id, turn, md5(translate(text, '/\ ' || chr(9), '____')) AS safe FROM conversations")
def h2(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.md5(C.safe_file_name(F.col("text"))).alias("safe"))


@query("h3_suffix", """SELECT p_partkey, CASE WHEN ends_with(f, '_report.csv') THEN replace(f, '_report.csv', '') END AS model
FROM (SELECT p_partkey, p_name || CASE WHEN p_size % 2 = 0 THEN '_report.csv' ELSE '.csv' END AS f FROM part)""")
def h3(spark, sf):
    name = F.concat("p_name", F.when(F.col("p_size") % 2 == 0, "_report.csv").otherwise(".csv"))
    return table(spark, sf, "part").select("p_partkey", C.report_model_name(name).alias("model"))


@query("h4_threshold", "SELECT l_orderkey, l_linenumber, CAST(l_quantity >= 25 AS INTEGER) AS flag FROM lineitem")
def h4(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", C.threshold_flag(F.col("l_quantity"), 25).alias("flag"))


@query("h5_class_name", """SELECT l_linenumber - 2 AS code, CASE l_linenumber - 2 WHEN 0 THEN 'Dropout' WHEN 1 THEN 'Enrolled'
  WHEN 2 THEN 'Graduate' ELSE 'Unknown' END AS name, count(*) AS n FROM lineitem GROUP BY ALL""")
def h5(spark, sf):
    code = F.col("l_linenumber") - 2
    return table(spark, sf, "lineitem").groupBy(code.alias("code"), C.class_name(code, CLASSES).alias("name")).agg(
        F.count(F.lit(1)).alias("n"))


@query("h6_top_probability", f"WITH {SCORES_SQL} SELECT model, o_orderkey, round(greatest(p0, p1, p2), 6) AS top FROM scores")
def h6(spark, sf):
    return rounded(scores(spark, sf).select("model", "o_orderkey", C.top_probability(F.col("probability")).alias("top")))


@query("h7_formats", f"""WITH {SCORES_SQL} SELECT model, o_orderkey, printf('%.1f%%', 100 * greatest(p0, p1, p2)) AS percent,
  round(greatest(p0, p1, p2), 4) AS top FROM scores""")
def h7(spark, sf):
    top = C.top_probability(F.col("probability"))
    return rounded(scores(spark, sf).select("model", "o_orderkey", C.percent_text(top).alias("percent"), top.alias("top")), 4)

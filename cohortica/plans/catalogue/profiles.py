"""Profile, rank and sort queries."""

from pyspark.sql import functions as F

from cohortica.config import Settings
from cohortica.operators import importance, profile, registry
from cohortica.operators.quantiles import quantiles
from cohortica.plans.cases import CASES_SQL, CLASSES, FEATURES, NUMERIC, TEXT, cases, labelled, table
from cohortica.plans.catalogue import query, rounded
from cohortica.plans.catalogue.tables import REPORT_SQL, SUMMARY_SQL, reports
from cohortica.sources.tables import load_table, save_table
from cohortica.workspace import fresh_path, materialise

LINE_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _long_sql(source, cols, keep=""):
    return " UNION ALL ".join(
        f"SELECT {keep}'{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM {source} WHERE {c} IS NOT NULL" for c in cols)


def _written(spark, sf):
    """Cases, written once for operators that read their input several times."""
    return materialise(cases(spark, sf), "cases", "case_id")


def _lineitem(spark, sf):
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", *LINE_NUMBERS)


@query("d1_overview", f"WITH {CASES_SQL} SELECT count(*) AS n_rows, CAST(10 AS BIGINT) AS n_columns, "
                      "count(DISTINCT outcome) AS n_classes FROM cases")
def d1(spark, sf):
    return profile.overview(cases(spark, sf), "outcome")


@query("d2_describe", f"""WITH long AS ({_long_sql("lineitem", LINE_NUMBERS)})
SELECT "column", count(*) AS n, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, min(value) AS min,
  round(quantile_cont(value, 0.25), 4) AS p25, round(quantile_cont(value, 0.5), 4) AS p50,
  round(quantile_cont(value, 0.75), 4) AS p75, max(value) AS max FROM long GROUP BY "column" """)
def d2(spark, sf):
    return rounded(profile.describe(_lineitem(spark, sf)), 4)


PROBS = (0.1, 0.25, 0.5, 0.75, 0.9)


@query("d2_describe_by_class", " UNION ALL ".join(
    f"SELECT o_orderstatus, 'o_totalprice' AS \"column\", CAST({q} AS DOUBLE) AS prob, "
    f"round(quantile_cont(o_totalprice, {q}), 4) AS value FROM orders GROUP BY o_orderstatus" for q in PROBS))
def d2_class(spark, sf):
    return rounded(quantiles(table(spark, sf, "orders"), ["o_totalprice"], PROBS, ["o_orderstatus"]), 4)


@query("d2_narrowed_quantiles", f"""WITH long AS ({_long_sql("lineitem", LINE_NUMBERS, "l_returnflag, ")})
SELECT l_returnflag, "column", CAST(0.5 AS DOUBLE) AS prob, round(quantile_cont(value, 0.5), 4) AS value
FROM long GROUP BY ALL""")
def d2_narrow(spark, sf):
    # Brackets narrower than a group, here for small groups too by a coarse sketch.
    return rounded(quantiles(_lineitem(spark, sf), LINE_NUMBERS, [0.5], ["l_returnflag"], accuracy=40), 4)


@query("d3_value_counts", "SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1")
def d3(spark, sf):
    return profile.value_counts(table(spark, sf, "orders"), "o_orderpriority")


D4_COLUMNS = ("l_linenumber", "l_quantity", "l_discount", "l_partkey", "l_returnflag")


@query("d4_distinct", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct, count(DISTINCT {c}) <= 10 AS few, "
    f"count(DISTINCT {c}) < 10 AS below FROM lineitem" for c in D4_COLUMNS))
def d4(spark, sf):
    n = F.col("n_distinct")
    return profile.distinct_counts(table(spark, sf, "lineitem"), D4_COLUMNS).select(
        "column", "n_distinct", (n <= 10).alias("few"), (n < 10).alias("below"))


@query("d5_counts_by_class", f"""WITH {CASES_SQL}
SELECT 'nation_code' AS "column", CAST(nation_code AS VARCHAR) AS value, outcome AS class, count(*) AS n FROM cases GROUP BY ALL
UNION ALL SELECT 'segment', segment, outcome, count(*) FROM cases GROUP BY ALL
UNION ALL SELECT 'priority', priority, outcome, count(*) FROM cases WHERE priority IS NOT NULL GROUP BY ALL""")
def d5(spark, sf):
    return profile.counts_by_class(cases(spark, sf), ["nation_code", "segment", "priority"], "outcome")


@query("d6_crosstab", f"""WITH {CASES_SQL} SELECT segment AS value,
  {", ".join(f"round(count(*) FILTER (outcome = '{c}') / count(*), 6) AS {chr(34)}{c}{chr(34)}" for c in CLASSES)}
FROM cases GROUP BY segment""")
def d6(spark, sf):
    return rounded(profile.crosstab(cases(spark, sf), "segment", "outcome", CLASSES))


def _histogram_sql(source, cols, bins):
    """Bin counts; ``bins`` is a number or an expression on n, lo, hi and iqr."""
    return f"""long AS ({_long_sql(source, cols)}),
lim AS (SELECT "column", count(*) AS n, min(value) AS lo, max(value) AS hi,
  quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM long GROUP BY "column"),
lim2 AS (SELECT "column", lo, hi, CAST({bins} AS INTEGER) AS k FROM lim),
guess AS (SELECT "column", value, lo, hi, k, CAST(least(floor((value - lo) / (hi - lo) * k), k - 1) AS INTEGER) AS i
  FROM long JOIN lim2 USING ("column")),
placed AS (SELECT "column", CASE WHEN value < CASE WHEN i = k THEN hi ELSE lo + i * ((hi - lo) / k) END THEN i - 1
  WHEN i <> k - 1 AND value >= lo + (i + 1) * ((hi - lo) / k) THEN i + 1 ELSE i END AS bin FROM guess),
every AS (SELECT "column", lo, hi, k, CAST(unnest(range(k)) AS INTEGER) AS bin FROM lim2),
tally AS (SELECT "column", bin, count(*) AS n FROM placed GROUP BY ALL)
SELECT "column", bin, round(lo + bin * ((hi - lo) / k), 4) AS low,
  round(CASE WHEN bin + 1 = k THEN hi ELSE lo + (bin + 1) * ((hi - lo) / k) END, 4) AS high, coalesce(n, 0) AS n
FROM every LEFT JOIN tally USING ("column", bin)"""


AUTO_BINS = ("ceil((hi - lo) / least(greatest(2.0 * iqr * pow(n, -1.0 / 3.0), (hi - lo) / sqrt(n) / 2), "
             "(hi - lo) / (log2(n) + 1.0)))")


@query("d7_histogram", "WITH " + _histogram_sql("lineitem", LINE_NUMBERS, AUTO_BINS))
def d7(spark, sf):
    return rounded(profile.histogram(_lineitem(spark, sf)), 4)


@query("d7_density", f"""WITH {CASES_SQL}, long AS ({_long_sql("cases", ["total_price", "n_lines"])}),
st AS (SELECT "column", count(*) AS n, min(value) AS lo, max(value) AS hi, stddev_samp(value) * pow(count(*), -0.2) AS w
  FROM long GROUP BY "column"),
grid AS (SELECT *, lo + point * ((hi - lo) / 199) AS x FROM (SELECT *, CAST(unnest(range(200)) AS INTEGER) AS point FROM st)),
vals AS (SELECT "column", value, count(*) AS c FROM long GROUP BY ALL)
SELECT "column", point, round(x, 4) AS x,
  round(sum(c * exp(-0.5 * ((value - x) / w) * ((value - x) / w))) / (n * w * sqrt(2 * pi())) * 1000, 6) AS density
FROM grid JOIN vals USING ("column") GROUP BY "column", point, x, n, w""")
def d7_density(spark, sf):
    out = profile.density(_written(spark, sf).select("total_price", "n_lines"))
    return out.select("column", "point", F.round("x", 4).alias("x"), F.round(F.col("density") * 1000, 6).alias("density"))


@query("d8_histogram_20", "WITH " + _histogram_sql("orders", ["o_totalprice"], "20"))
def d8(spark, sf):
    return rounded(profile.histogram(table(spark, sf, "orders"), ["o_totalprice"], 20), 4)


def _box_sql(source, cols, by):
    return f"""long AS ({_long_sql(source, cols, f"{by} AS class, ")}),
box AS (SELECT class, "column", quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50,
  quantile_cont(value, 0.75) AS p75 FROM long GROUP BY ALL),
fenced AS (SELECT *, p25 - 1.5 * (p75 - p25) AS low, p75 + 1.5 * (p75 - p25) AS high FROM long JOIN box USING (class, "column")),
boxes AS (SELECT class, "column", p25, p50, p75, count(*) AS n, least(min(value) FILTER (value >= low), p25) AS whisker_low,
  greatest(max(value) FILTER (value <= high), p75) AS whisker_high,
  count(*) FILTER (value < low OR value > high) AS n_outliers FROM fenced
  GROUP BY class, "column", p25, p50, p75)"""


BOX_COLUMNS = ("class, \"column\", round(p25, 4) AS p25, round(p50, 4) AS p50, round(p75, 4) AS p75, n, "
               "round(whisker_low, 4) AS whisker_low, round(whisker_high, 4) AS whisker_high, n_outliers")


@query("d9_boxes", f"WITH {CASES_SQL}, {_box_sql('cases', NUMERIC, 'outcome')} SELECT {BOX_COLUMNS} FROM boxes")
def d9(spark, sf):
    return rounded(profile.box_summary(_written(spark, sf), NUMERIC, "outcome"), 4)


@query("d9_outliers", f"WITH {_box_sql('events', ['value'], 'event_type')} "
                      "SELECT class, \"column\", value FROM fenced WHERE value < low OR value > high")
def d9_outliers(spark, sf):
    return profile.box_outliers(table(spark, sf, "events"), ["value"], "event_type")


@query("d10_feature_grid", f"""WITH {CASES_SQL}, {_box_sql('cases', ['total_price', 'sum_qty', 'acct_bal', 'nation_code'], 'outcome')},
few AS (
  SELECT 'priority' AS "column", priority AS value, outcome AS class, count(*) AS n FROM cases WHERE priority IS NOT NULL GROUP BY ALL
  UNION ALL SELECT 'segment', segment, outcome, count(*) FROM cases GROUP BY ALL)
SELECT 'box' AS kind, CAST(NULL AS VARCHAR) AS value, {BOX_COLUMNS} FROM boxes
UNION ALL SELECT 'count', value, class, "column", NULL, NULL, NULL, n, NULL, NULL, NULL FROM few""")
def d10(spark, sf):
    shown = ["total_price", "sum_qty", "acct_bal", "nation_code", "priority", "segment"]
    return rounded(profile.feature_grid(_written(spark, sf), shown, "outcome"), 4)


@query("d11_correlation", "WITH " + CASES_SQL + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS r FROM cases"
    for i, a in enumerate(NUMERIC) for j, b in enumerate(NUMERIC) if i > j))
def d11(spark, sf):
    return rounded(profile.correlation(cases(spark, sf), NUMERIC))


@query("d12_medians", "WITH " + CASES_SQL + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(0.5 AS DOUBLE) AS prob, round(median({c}), 4) AS value FROM cases" for c in NUMERIC))
def d12(spark, sf):
    return rounded(quantiles(_written(spark, sf), NUMERIC, [0.5]), 4)


@query("d13_options", "SELECT DISTINCT p_brand AS value FROM part")
def d13(spark, sf):
    return profile.sorted_options(table(spark, sf, "part"), "p_brand")


@query("d14_metrics_long", f"""WITH {REPORT_SQL}, s AS ({SUMMARY_SQL})
SELECT model, metric, round(value, 6) AS value FROM (UNPIVOT s ON accuracy, precision, recall, f1, roc_auc
INTO NAME metric VALUE value)""")
def d14(spark, sf):
    return rounded(registry.long_metrics(registry.summary(reports(spark, sf))))


LABEL_SQL = "CASE outcome WHEN 'Dropout' THEN 0 WHEN 'Enrolled' THEN 1 ELSE 2 END"
STRENGTH_SQL = "strength AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, abs(corr({c}, {LABEL_SQL})) AS importance FROM cases" for c in NUMERIC) + ")"


def _strength(spark, sf):
    """Absolute correlation of each numeric feature with the class code."""
    code = F.array_position(F.array(*[F.lit(c) for c in CLASSES]), F.col("outcome")).cast("double") - 1
    df = cases(spark, sf).select(*NUMERIC, code.alias("code"))
    return df.agg(F.array(*[
        F.struct(F.lit(c).alias("feature"),
                 F.abs(F.corr(F.col(c).cast("double"), F.when(F.col(c).isNotNull(), F.col("code")))).alias("importance"))
        for c in NUMERIC]).alias("z")).select(F.inline("z"))


def _discrete_sql(source, cols, target):
    """Plug-in mutual information in nats."""
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS v, {target} AS y FROM {source} WHERE {c} IS NOT NULL" for c in cols)
    return f"""dlong AS ({long}),
dcell AS (SELECT feature, v, y, CAST(count(*) AS DOUBLE) AS n FROM dlong GROUP BY ALL),
dx AS (SELECT feature, v, sum(n) AS nx FROM dcell GROUP BY ALL),
dy AS (SELECT feature, y, sum(n) AS ny FROM dcell GROUP BY ALL),
dn AS (SELECT feature, sum(n) AS t FROM dcell GROUP BY ALL),
discrete AS (SELECT feature, greatest(sum(n / t * ln(n * t / (nx * ny))), 0) AS mi
  FROM dcell JOIN dx USING (feature, v) JOIN dy USING (feature, y) JOIN dn USING (feature) GROUP BY feature)"""


@query("f1_sort_importances", f"WITH {CASES_SQL}, {STRENGTH_SQL} SELECT feature, round(importance, 6) AS importance "
                              "FROM strength ORDER BY importance DESC")
def f1(spark, sf):
    return rounded(importance.sort_importances(_strength(spark, sf)))


@query("a11_importance_sink", f"WITH {CASES_SQL}, {STRENGTH_SQL} SELECT feature, round(importance, 6) AS importance FROM strength")
def a11(spark, sf):
    path = fresh_path(spark, "importance")
    save_table(_strength(spark, sf), path, "csv")
    return rounded(load_table(spark, path, "csv"))


@query("f2_first_rows", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def f2(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_orderkey").limit(5)


@query("f3_top_features", "SELECT p_brand AS feature, round(avg(p_retailprice), 4) AS importance FROM part "
                          "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def f3(spark, sf):
    per = table(spark, sf, "part").groupBy(F.col("p_brand").alias("feature")).agg(
        F.round(F.avg("p_retailprice"), 4).alias("importance"))
    return importance.top_features(per)


DIGAMMA = ("(ln({x} + 6.0) - 0.5 / ({x} + 6.0) - 1 / (({x} + 6.0) * ({x} + 6.0)) * (1.0::DOUBLE / 12 - "
           "1 / (({x} + 6.0) * ({x} + 6.0)) * (1.0::DOUBLE / 120 - 1 / (({x} + 6.0) * ({x} + 6.0)) / 252)) - (1.0 / {x} "
           + "".join(f"+ 1.0 / ({{x}} + {i}.0) " for i in range(1, 6)) + "))")


def _psi(x):
    return DIGAMMA.format(x=f"CAST({x} AS DOUBLE)")


def _knn_sql(source, cols, target):
    near = ", ".join(f"{f}({{'d': value, 'e': value, 'c': c}}, {j}) OVER w" for f in ("lag", "lead") for j in (1, 2, 3))
    return f"""klong AS ({_long_sql(source, cols, f"{target} AS y, ")}),
kcell AS (SELECT "column", y, value, count(*) AS c FROM klong GROUP BY ALL),
ksize AS (SELECT "column", y, sum(c) AS ny FROM kcell GROUP BY ALL HAVING sum(c) > 1),
kpoint AS (SELECT * FROM kcell JOIN ksize USING ("column", y)),
knear AS (SELECT *, list_sort(list_transform(list_filter([{near}], lambda x: x IS NOT NULL),
    lambda x: {{'d': abs(x['e'] - value), 'e': x['e'], 'c': x['c']}})) AS s, least(3, ny - 1) AS k
  FROM kpoint WINDOW w AS (PARTITION BY "column", y ORDER BY value)),
kreach AS (SELECT "column", y, value, c, ny, k, CASE WHEN c - 1 >= k THEN value WHEN s[1]['c'] >= k - c + 1 THEN s[1]['e']
    WHEN s[1]['c'] + s[2]['c'] >= k - c + 1 THEN s[2]['e'] ELSE s[3]['e'] END AS e FROM knear),
kspan AS (SELECT *, least(e, 2 * value - e) AS lo, greatest(e, 2 * value - e) AS hi FROM kreach),
kall AS (SELECT "column", value AS v, sum(c) AS w FROM kpoint GROUP BY ALL),
kcount AS (
  SELECT q."column", q.y, q.value, any_value(q.c) AS c, any_value(q.ny) AS ny, any_value(q.k) AS k, sum(w) AS m
  FROM kspan q JOIN kall t ON t."column" = q."column" AND t.v > q.lo AND t.v < q.hi WHERE q.lo < q.hi GROUP BY 1, 2, 3
  UNION ALL
  SELECT q."column", q.y, q.value, q.c, q.ny, q.k, t.w FROM kspan q JOIN kall t ON t."column" = q."column" AND t.v = q.value
  WHERE q.lo = q.hi),
knn AS (SELECT "column" AS feature, greatest({_psi("sum(c)")} + sum(c * {_psi("k")}) / sum(c) - sum(c * {_psi("ny")}) / sum(c)
  - sum(c * {_psi("m")}) / sum(c), 0) AS mi FROM kcount GROUP BY "column")"""


@query("i25_mutual_information", f"""WITH {CASES_SQL},
{_knn_sql("cases", ["total_price", "sum_qty", "acct_bal", "nation_code"], "outcome")},
{_discrete_sql("cases", ["segment", "priority"], "outcome")}
SELECT feature, round(mi, 6) AS mi, 'knn' AS method FROM knn
UNION ALL SELECT feature, round(mi, 6), 'discrete' FROM discrete""")
def i25(spark, sf):
    cols = ["total_price", "sum_qty", "acct_bal", "nation_code", "segment", "priority"]
    return rounded(importance.mutual_information(_written(spark, sf), cols, "outcome"))


@query("c1_align_importances", f"""WITH {CASES_SQL}, {_knn_sql("cases", NUMERIC, "outcome")}, {_discrete_sql("cases", TEXT, "outcome")}
SELECT feature, round(mi, 6) AS mi, TRUE AS sound FROM (SELECT * FROM knn UNION ALL SELECT * FROM discrete)""")
def c1(spark, sf):
    """All features ranked by forest and by mutual information, written and read back; forest shares add up to 1."""
    df = materialise(labelled(spark, sf), "labelled", "row_id").withColumn("row_id", F.col("row_id").cast("string"))
    path = fresh_path(spark, "ranking")
    settings = Settings(features=FEATURES, target="outcome", row_id="case_id")
    save_table(importance.rank_features(df, FEATURES, "outcome", settings), path, "csv")
    ranked = load_table(spark, path, "csv")
    total, low = ranked.agg(F.sum("rf"), F.min("rf")).first()
    return rounded(ranked.select("feature", "mi", F.lit(low >= 0 and abs(total - 1) < 1e-6).alias("sound")))

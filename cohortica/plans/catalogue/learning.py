"""Encoding, splitting, preprocessing, resampling, learners, evaluation, registry, scoring."""

from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortica.config import Settings
from cohortica.operators.clean import fill_median
from cohortica.operators import importance, learners, metrics, preprocess, registry, resample, scoring, split
from cohortica.plans import training
from cohortica.plans.cases import (
    BINARISED, CASES_SQL, CLASSES, FEATURES, LABELLED_SQL, NUMERIC, SCORES_SQL, TEXT, cases, labelled, scores, table,
)
from cohortica.plans.catalogue import query, rounded
from cohortica.plans.catalogue.tables import (
    REPORT_COLUMNS, REPORT_ROWS, REPORT_SQL, SUMMARY_SQL, _report_columns, reports,
)
from cohortica.streaming.reports import follow_reports, summary_so_far
from cohortica.streaming.scoring import score_available
from cohortica.workspace import fresh_path, materialise

FULL = Settings(features=FEATURES, binarised=BINARISED, target="outcome", row_id="case_id")
# The whole matrix with the full grids has forests of 600 trees and boosters of 200 rounds on every fold.
SEARCH = FULL.small()
# Every combination of the full grids but with fewer trees and rounds: 27 forests from 3 fits a fold, 36 boosters from 18 grown at once.
GRID = replace(
    SEARCH, forest_grid={**FULL.forest_grid, "n_estimators": (4, 8, 12)}, boost_grid={**FULL.boost_grid, "n_estimators": (1, 2)})
METRIC_COLUMNS = "accuracy, precision, recall, f1, roc_auc"
ROUNDED_METRICS = ", ".join(f"round({c}, 6) AS {c}" for c in METRIC_COLUMNS.split(", "))


def _written(spark, sf):
    """Labelled cases, written once for operators that read their input several times."""
    return materialise(labelled(spark, sf), "labelled", "row_id")


@query("i1_label_encode", """SELECT o_orderkey, o_orderstatus, CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS INTEGER) AS label
FROM orders""")
def i1(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.encode(orders, "o_orderstatus", split.class_labels(orders, "o_orderstatus"))


@query("i2_decode", f"""WITH {SCORES_SQL} SELECT model, o_orderkey, prediction,
  CASE prediction WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END AS predicted FROM predicted""")
def i2(spark, sf):
    labels = split.class_labels(table(spark, sf, "orders"), "o_orderstatus")
    return scores(spark, sf).select("model", "o_orderkey", "prediction", split.decode(F.col("prediction"), labels).alias("predicted"))


MEDIANS_SQL = "med AS (SELECT " + ", ".join(f"median({c}) AS md_{c}" for c in NUMERIC) + " FROM labelled)"
MOMENTS_SQL = "mom AS (SELECT " + ", ".join(
    f"avg(coalesce({c}, md_{c})) AS mu_{c}, stddev_pop(coalesce({c}, md_{c})) AS sd_{c}" for c in NUMERIC) + " FROM labelled, med)"
MODES_SQL = "mod AS (SELECT " + ", ".join(
    f"(SELECT {c} FROM labelled WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mo_{c}"
    for c in TEXT) + ")"
FIT_SQL = f"{LABELLED_SQL}, {MEDIANS_SQL}, {MOMENTS_SQL}, {MODES_SQL}"


def _matrix_sql(binarised=()):
    parts = [f"SELECT row_id, 'binarize__{c}' AS feature, CASE WHEN {c} >= 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value FROM labelled"
             for c in binarised]
    parts += [f"SELECT row_id, 'num__{c}', (coalesce({c}, md_{c}) - mu_{c}) / CASE WHEN sd_{c} = 0 THEN 1 ELSE sd_{c} END "
              "FROM labelled, med, mom" for c in NUMERIC if c not in binarised]
    for c in TEXT:
        parts.append(f"""SELECT row_id, 'cat__{c}_' || v, CAST(coalesce({c}, mo_{c}) = v AS INTEGER)::DOUBLE FROM labelled, mod,
  (SELECT DISTINCT {c} AS v FROM labelled WHERE {c} > (SELECT min({c}) FROM labelled)) cats""")
    return f"""WITH {FIT_SQL}, matrix(row_id, feature, value) AS ({" UNION ALL ".join(parts)})
SELECT row_id, feature, round(value, 6) + 0.0 AS value FROM matrix"""


def _long_matrix(df, fitted):
    """Feature vectors as rows (row_id, feature, value)."""
    arr = fitted.transform(df).select("row_id", vector_to_array("features").alias("v"))
    names = F.array(*[F.lit(n) for n in fitted.feature_names])
    long = arr.select("row_id", F.inline(F.arrays_zip(names.alias("feature"), F.col("v").alias("value"))))
    return rounded(long.toDF("row_id", "feature", "value"))


@query("i3_impute_median", f"WITH {FIT_SQL} SELECT row_id, {', '.join(f'round(coalesce({c}, md_{c}), 6) AS {c}' for c in NUMERIC)} "
                           "FROM labelled, med")
def i3(spark, sf):
    df = fill_median(_written(spark, sf).select("row_id", *NUMERIC), NUMERIC)
    return rounded(df.select("row_id", *[F.col(c).cast("double").alias(c) for c in NUMERIC]))


@query("i4_impute_mode", f"WITH {FIT_SQL} SELECT row_id, {', '.join(f'coalesce({c}, mo_{c}) AS {c}' for c in TEXT)} FROM labelled, mod")
def i4(spark, sf):
    df = labelled(spark, sf)
    fill = preprocess.modes(df, TEXT)
    return df.select("row_id", *[F.coalesce(F.col(c), F.lit(fill[c])).alias(c) for c in TEXT])


@query("i5_standardise", f"""WITH {FIT_SQL}, z AS (SELECT {", ".join(
    f"(coalesce({c}, md_{c}) - mu_{c}) / CASE WHEN sd_{c} = 0 THEN 1 ELSE sd_{c} END AS {c}" for c in NUMERIC)}, row_id
  FROM labelled, med, mom) SELECT row_id, {", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in NUMERIC)} FROM z""")
def i5(spark, sf):
    df = _written(spark, sf)
    fitted = preprocess.fit(df, NUMERIC)
    out = fitted.transform(df.select("row_id", *NUMERIC))
    return rounded(out.select("row_id", *[F.col(f"_num_{i}").alias(c) for i, c in enumerate(NUMERIC)]))


@query("i6_one_hot", _matrix_sql().replace("FROM matrix", "FROM matrix WHERE feature LIKE 'cat__%'"))
def i6(spark, sf):
    df = _written(spark, sf)
    return _long_matrix(df, preprocess.fit(df, TEXT))


@query("i7_preprocess_base", _matrix_sql())
def i7(spark, sf):
    df = _written(spark, sf)
    return _long_matrix(df, preprocess.fit(df, FEATURES))


@query("i8_preprocess_binned", _matrix_sql(BINARISED))
def i8(spark, sf):
    df = _written(spark, sf)
    return _long_matrix(df, preprocess.fit(df, FEATURES, BINARISED))


@query("i9_balanced_weights", f"""WITH {LABELLED_SQL}, c AS (SELECT label, count(*) AS n_c FROM labelled GROUP BY label)
SELECT row_id, l.label, round((SELECT count(*) FROM labelled) / ((SELECT count(*) FROM c) * n_c), 6) AS weight
FROM labelled l JOIN c USING (label)""")
def i9(spark, sf):
    df, _ = learners.with_weights(labelled(spark, sf), True)
    return rounded(df.select("row_id", "label", "weight"))


SPLIT_SQL = f"""{LABELLED_SQL},
size AS (SELECT count(*) AS n, count(*) - CAST(ceil(0.2 * count(*)) AS BIGINT) AS n_train FROM labelled),
per AS (SELECT label, count(*) AS n_c FROM labelled GROUP BY label),
fl AS (SELECT label, n_c, n_c * n_train // n AS base, (n_c * n_train) % n AS rest, n_train FROM per, size),
quota AS (SELECT label, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= n_train - sum(base) OVER () THEN 1 ELSE 0 END AS q FROM fl),
ordered AS (SELECT l.*, md5('42:' || CAST(row_id AS VARCHAR)) AS h FROM labelled l),
split AS (SELECT o.*, row_number() OVER (PARTITION BY o.label ORDER BY h, row_id) > q AS is_test FROM ordered o JOIN quota USING (label))"""


@query("i11_stratified_split", f"WITH {SPLIT_SQL} SELECT row_id, label, is_test FROM split")
def i11(spark, sf):
    df = _written(spark, sf).select("row_id", "label")
    return split.stratified_split(df, "label", "row_id")


@query("i12_stratified_folds", f"""WITH {SPLIT_SQL}, train AS (SELECT row_id, label, h FROM split WHERE NOT is_test),
cls AS (SELECT label, count(*) AS n_c, min(h) AS first_h FROM train GROUP BY label),
laid AS (SELECT label, n_c, sum(n_c) OVER (ORDER BY first_h) - n_c AS s FROM cls),
seats AS (SELECT label, (s + unnest(range(n_c))) % 3 AS f FROM laid),
sizes AS (SELECT label, f, count(*) AS m FROM seats GROUP BY ALL),
ends AS (SELECT label, f, sum(m) OVER (PARTITION BY label ORDER BY f) AS e FROM sizes),
num AS (SELECT row_id, label, row_number() OVER (PARTITION BY label ORDER BY h, row_id) AS rn FROM train)
SELECT row_id, label, CAST((SELECT min(f) FROM ends WHERE ends.label = num.label AND rn <= e) AS INTEGER) AS fold FROM num""")
def i12(spark, sf):
    df = split.stratified_split(_written(spark, sf).select("row_id", "label"), "label", "row_id")
    return split.stratified_folds(df.where("not is_test").drop("is_test"), "label", "row_id")


PRIORITIES = ("2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
SEGMENTS = ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
# The preprocessed row: scaled numbers, then flags of all but the first category.
VECTOR_SQL = "[" + ", ".join(
    [f"(coalesce({c}, md_{c}) - mu_{c}) / CASE WHEN sd_{c} = 0 THEN 1 ELSE sd_{c} END" for c in NUMERIC]
    + [f"CAST(coalesce({c}, mo_{c}) = '{v}' AS INTEGER)::DOUBLE" for c, vs in zip(TEXT, (PRIORITIES, SEGMENTS)) for v in vs]) + "]::DOUBLE[14]"


def _smote_input(spark, sf):
    """All features of the labelled cases, preprocessed."""
    df = _written(spark, sf)  # dealt evenly; so are its projections
    return materialise(preprocess.fit(df, FEATURES).transform(df).select("row_id", "label", "features"), "smote-input")


def _draw_sql(name, n):
    return f"CAST('0x' || md5('42:{name}:' || label || ':' || j)[1:15] AS BIGINT) % {n}"


@query("i13_smote", f"""WITH {FIT_SQL},
pts AS (SELECT row_id, label, {VECTOR_SQL} AS v,
  row_number() OVER (PARTITION BY label ORDER BY md5('42:' || CAST(row_id AS VARCHAR)), CAST(row_id AS VARCHAR)) - 1 AS pos FROM labelled, med, mom, mod),
cnt AS (SELECT label, count(*) AS n_c FROM pts GROUP BY label),
need AS (SELECT label, n_c, (SELECT max(n_c) FROM cnt) - n_c AS m FROM cnt WHERE n_c < (SELECT max(n_c) FROM cnt)),
drawn AS (SELECT label, n_c, unnest(range(m)) AS j FROM need),
picked AS (SELECT label, j, {_draw_sql("row", "n_c")} AS pos, {_draw_sql("slot", "5")} AS slot,
  CAST({_draw_sql("step", "1000000007")} AS DOUBLE) / 1000000007.0 AS u FROM drawn),
used AS (SELECT DISTINCT p.* FROM pts p JOIN picked USING (label, pos)),
near AS (SELECT q.label, q.pos, unnest(arg_min(p.pos, array_distance(q.v, p.v), 5)) AS near_pos,
    generate_subscripts(arg_min(p.pos, array_distance(q.v, p.v), 5), 1) - 1 AS slot
  FROM used q JOIN pts p ON p.label = q.label AND p.pos <> q.pos GROUP BY q.label, q.pos)
SELECT 'synthetic-' || k.label || '-' || k.j AS row_id, k.label,
  {", ".join(f"round(s.v[{i}] + u * (t.v[{i}] - s.v[{i}]), 4) + 0.0 AS f{i}" for i in range(1, 15))}
FROM picked k JOIN pts s ON s.label = k.label AND s.pos = k.pos
JOIN near n ON n.label = k.label AND n.pos = k.pos AND n.slot = k.slot
JOIN pts t ON t.label = k.label AND t.pos = n.near_pos""")
def i13(spark, sf):
    out = resample.smote(_smote_input(spark, sf), "row_id").where(F.col("row_id").startswith("synthetic"))
    v = out.select("row_id", "label", vector_to_array("features").alias("v"))
    return rounded(v.select("row_id", "label", *[F.get("v", i).alias(f"f{i + 1}") for i in range(14)]), 4)


@query("g2_append_synthetic", f"""WITH {LABELLED_SQL}, c AS (SELECT label, count(*) AS n FROM labelled GROUP BY label)
SELECT label, FALSE AS synthetic, n FROM c
UNION ALL SELECT label, TRUE, (SELECT max(n) FROM c) - n FROM c WHERE n < (SELECT max(n) FROM c)""")
def g2(spark, sf):
    out = resample.smote(_smote_input(spark, sf), "row_id", trees=FULL.smote_trees, leaf_rows=FULL.smote_leaf_rows)
    return out.groupBy("label", F.col("row_id").startswith("synthetic").alias("synthetic")).agg(F.count(F.lit(1)).alias("n"))


def _train_and_report(spark, sf, *names, settings=FULL):
    table_, _, _ = training.prepare(cases(spark, sf), settings)
    train, test = table_.where("not is_test").drop("is_test"), table_.where("is_test").drop("is_test")
    configs = {c.model: c for c in training.training_matrix()}
    shared = {}
    try:
        trained = [training.train_one(train, configs[n], settings, shared) for n in names]
        return training.evaluate(trained, test)
    finally:
        training.release(shared)


def _checked_reports(reports_):
    """Support of every report row, and whether its shares are shares and its AUC beats chance."""
    shares = F.lit(True)
    for c in ("precision", "recall", "f1_score"):
        shares = shares & F.coalesce(F.col(c).between(0, 1), F.col("row_label") == "roc_auc")
    better = F.when(F.col("row_label") == "roc_auc", (F.col("roc_auc") > 0.5) & (F.col("roc_auc") <= 1)).otherwise(F.col("roc_auc").isNull())
    support = F.when(F.col("row_label") != "accuracy", F.col("support"))
    return reports_.select("model", "row_label", support.cast("bigint").alias("support"), (shares & better).alias("sound"))


def _support_sql(*models):
    """Report rows of models on the held-out cases: supports follow from the split."""
    names = ", ".join(f"('{m}')" for m in models)
    return f"""WITH {SPLIT_SQL}, held AS (SELECT label, count(*) AS n FROM split WHERE is_test GROUP BY label), m(model) AS (VALUES {names}),
report AS (SELECT CAST(label AS VARCHAR) AS row_label, n AS support FROM held
  UNION ALL SELECT 'accuracy', NULL UNION ALL SELECT 'macro avg', (SELECT CAST(sum(n) AS BIGINT) FROM held)
  UNION ALL SELECT 'weighted avg', (SELECT CAST(sum(n) AS BIGINT) FROM held) UNION ALL SELECT 'roc_auc', NULL)
SELECT model, row_label, support, TRUE AS sound FROM m, report"""


def _search_sql(n_candidates):
    return f"""SELECT CAST(c AS INTEGER) AS candidate, CAST(f AS INTEGER) AS fold, TRUE AS sound
FROM (SELECT unnest(range({n_candidates})) AS c), (SELECT unnest(range(3)) AS f)"""


def _checked_search(scores_):
    return scores_.select("candidate", "fold", ((F.col("roc_auc") > 0.5) & (F.col("roc_auc") <= 1)).alias("sound"))


@query("i14_logistic", _support_sql("BASE_LR", "BASE_LR_BALANCE"))
def i14(spark, sf):
    return _checked_reports(_train_and_report(spark, sf, "BASE_LR", "BASE_LR_BALANCE", settings=FULL))


@query("i15_forest", _support_sql("BASE_RF"))
def i15(spark, sf):
    return _checked_reports(_train_and_report(spark, sf, "BASE_RF", settings=FULL))


@query("i16_boosted", _support_sql("BINN_XGB"))
def i16(spark, sf):
    return _checked_reports(_train_and_report(spark, sf, "BINN_XGB", settings=FULL))


def flagship(spark, sf):
    """Reports of plain and weighted logistic regression on the held-out cases."""
    return _report_columns(_train_and_report(spark, sf, "BASE_LR", "BASE_LR_BALANCE", settings=FULL))


def _searched(spark, sf, name):
    table_, _, _ = training.prepare(cases(spark, sf), GRID)
    config = next(c for c in training.training_matrix() if c.model == name)
    return _checked_search(training.search(table_.where("not is_test").drop("is_test"), config, GRID)[1])


@query("i17_grid_search", _search_sql(27))
def i17(spark, sf):
    return _searched(spark, sf, "BASE_RF_GRID")


FOLD_SCORES_SQL = f"""{SCORES_SQL}, fs AS (
  SELECT model, o_orderkey % 3 AS fold, 0 AS class, p0 AS score, CAST(label = 0 AS BIGINT) AS hit FROM predicted
  UNION ALL SELECT model, o_orderkey % 3, 1, p1, CAST(label = 1 AS BIGINT) FROM predicted
  UNION ALL SELECT model, o_orderkey % 3, 2, p2, CAST(label = 2 AS BIGINT) FROM predicted),
fr AS (SELECT model, fold, class, hit, rank() OVER (PARTITION BY model, fold, class ORDER BY score)
  + (count(*) OVER (PARTITION BY model, fold, class, score) - 1) / 2.0 AS rk FROM fs),
fa AS (SELECT model, fold, class, sum(hit) AS pos, (sum(CASE WHEN hit = 1 THEN CAST(rk AS DOUBLE) ELSE 0 END)
  - CAST(sum(hit) AS DOUBLE) * (sum(hit) + 1) / 2) / (CAST(sum(hit) AS DOUBLE) * sum(1 - hit)) AS auc FROM fr GROUP BY ALL),
fold_auc AS (SELECT model, fold, sum(auc * pos) / sum(pos) AS roc_auc FROM fa GROUP BY ALL)"""


@query("i19_boost_search", _search_sql(36))
def i19(spark, sf):
    return _searched(spark, sf, "BASE_XGB_GRID")


@query("i17_rank_candidates", f"""WITH {FOLD_SCORES_SQL} SELECT model AS candidate, round(avg(roc_auc), 6) AS mean_score
FROM fold_auc GROUP BY model""")
def i17_rank(spark, sf):
    df = scores(spark, sf).withColumn("fold", F.col("o_orderkey") % 3)
    per_fold = metrics.weighted_auc(df, ["model", "fold"]).withColumnRenamed("model", "candidate")
    return rounded(training.rank_candidates(per_fold))


MATRIX = [c.model for c in training.training_matrix()]


@query("i20_training_matrix", _support_sql(*MATRIX))
def i20(spark, sf):
    return _checked_reports(_train_and_report(spark, sf, *MATRIX, settings=SEARCH))


@query("i21_class_auc", f"WITH {REPORT_SQL} SELECT model, class, CAST(positives AS BIGINT) AS positives, "
                        "CAST(negatives AS BIGINT) AS negatives, round(auc, 6) AS auc FROM class_auc")
def i21_class(spark, sf):
    return rounded(metrics.class_auc(scores(spark, sf), ["model"]))


@query("i21_weighted_ovr_auc", f"WITH {REPORT_SQL} SELECT model, round(roc_auc, 6) AS roc_auc FROM model_auc")
def i21(spark, sf):
    return rounded(metrics.weighted_auc(scores(spark, sf), ["model"]))


@query("i22_classification_report", f"WITH {REPORT_SQL} SELECT {REPORT_COLUMNS.rsplit(', ', 2)[0]} FROM report_rows".replace(
    ", round(roc_auc", ""))
def i22(spark, sf):
    return rounded(metrics.classification_report(scores(spark, sf), ["model"]))


@query("i23_confusion", f"""WITH {SCORES_SQL} SELECT model, label, count(*) FILTER (prediction = 0) AS pred_0,
  count(*) FILTER (prediction = 1) AS pred_1, count(*) FILTER (prediction = 2) AS pred_2 FROM predicted GROUP BY ALL""")
def i23(spark, sf):
    return metrics.confusion_matrix(scores(spark, sf), 3, ["model"])


@query("i24_wide_report", REPORT_ROWS)
def i24(spark, sf):
    return _report_columns(reports(spark, sf))


@query("i25_discrete_text", """WITH t AS (SELECT lang, source FROM documents),
cell AS (SELECT lang, source, CAST(count(*) AS DOUBLE) AS n FROM t GROUP BY ALL),
x AS (SELECT lang, sum(n) AS nx FROM cell GROUP BY ALL), y AS (SELECT source, sum(n) AS ny FROM cell GROUP BY ALL)
SELECT 'lang' AS feature, round(greatest(sum(n / t * ln(n * t / (nx * ny))), 0), 6) AS mi, 'discrete' AS method
FROM cell JOIN x USING (lang) JOIN y USING (source), (SELECT sum(n) AS t FROM cell)""")
def i25_text(spark, sf):
    return rounded(importance.mutual_information(table(spark, sf, "documents"), ["lang"], "source"))


def _sound_importances(df):
    """Feature names, and whether all values are shares that add up to 1."""
    total, low = df.agg(F.sum("importance"), F.min("importance")).first()
    return df.select("feature", F.lit(low >= 0 and abs(total - 1) < 1e-6).alias("sound"))


FEATURES_SQL = " UNION ALL ".join(f"SELECT '{c}' AS feature, TRUE AS sound" for c in FEATURES)


def _columns_sql(binarised=()):
    """Names of the columns that preprocessing of the training rows makes."""
    parts = [f"SELECT 'binarize__{c}' AS feature" for c in binarised] + [f"SELECT 'num__{c}'" for c in NUMERIC if c not in binarised]
    parts += [f"SELECT DISTINCT 'cat__{c}_' || {c} FROM train WHERE {c} > (SELECT min({c}) FROM train)" for c in TEXT]
    return f"""WITH {SPLIT_SQL}, train AS (SELECT * FROM split WHERE NOT is_test), f(feature) AS ({" UNION ALL ".join(parts)})
SELECT feature, TRUE AS sound FROM f"""


@query("i26_forest_importance", FEATURES_SQL)
def i26(spark, sf):
    df = _written(spark, sf).withColumn("row_id", F.col("row_id").cast("string"))
    return _sound_importances(importance.forest_importance(df, FEATURES, FULL))


@query("i27_best_importance", _columns_sql(BINARISED))
def i27(spark, sf):
    table_, _, _ = training.prepare(cases(spark, sf), FULL)
    train = table_.where("not is_test").drop("is_test")
    configs = {c.model: c for c in training.training_matrix()}
    t = training.train_one(train, configs["BINN_RF"], FULL)
    return _sound_importances(learners.importances(t.model.stages[-1], t.feature_names, spark))


@query("i28_fill_inputs", f"""WITH {CASES_SQL}, d AS (SELECT median(n_lines) AS a, median(sum_qty) AS b, median(max_disc) AS m, min(priority) AS p,
  median(acct_bal) AS ab FROM cases)
SELECT case_id, round(coalesce(n_lines, a), 6) AS n_lines, round(coalesce(sum_qty, b), 6) AS sum_qty,
  round(coalesce(max_disc, m), 6) AS max_disc, coalesce(priority, p) AS priority, round(ab, 6) AS acct_bal FROM cases, d""")
def i28_fill(spark, sf):
    df = cases(spark, sf)
    features = ["n_lines", "sum_qty", "max_disc", "priority", "acct_bal"]
    filled = scoring.fill_inputs(df.select("case_id", *features[:-1]), scoring.form_defaults(df, features))
    return rounded(filled.select("case_id", *features))


def _fitted_logistic(spark, sf):
    df = _written(spark, sf)
    fitted = preprocess.fit(df, FEATURES)
    rows = fitted.transform(df).select(F.col("row_id").cast("string").alias("row_id"), "label", "features")
    model = learners.fit_learner("lr", rows, FULL)
    return PipelineModel([*fitted.model.stages, model]), df


def _consistent(out):
    """Whether band and risk group are those of the top probability and the predicted class."""
    top, predicted = F.col("top"), F.col("predicted")
    band = F.when(top > 0.8, "High").when(top > 0.6, "Medium").otherwise("Low")
    risk = F.when(predicted == "Dropout", "Likely to Drop Out").when(predicted == "Graduate", "Likely to Graduate").otherwise("Likely to Stay Enrolled")
    return (F.col("band") == band) & (F.col("risk_group") == risk) & predicted.isin(*CLASSES) & top.between(1 / len(CLASSES), 1)


ALL_SOUND_SQL = f"WITH {LABELLED_SQL} SELECT row_id, TRUE AS sound FROM labelled"


@query("i28_score_batch", ALL_SOUND_SQL)
def i28(spark, sf):
    """Saves the pipeline, loads it and scores every case with some inputs missing."""
    model, df = _fitted_logistic(spark, sf)
    path = fresh_path(spark, "model")
    model.write().save(path)
    defaults = scoring.form_defaults(df, FEATURES)
    out = scoring.score(df.drop("acct_bal"), PipelineModel.load(path), CLASSES, defaults, ["row_id"])
    return out.select("row_id", _consistent(out).alias("sound"))


@query("i28_score_stream", ALL_SOUND_SQL)
def i28_stream(spark, sf):
    """Scores arriving files; every row must come out as it does from the whole table."""
    model, df = _fitted_logistic(spark, sf)
    folder = fresh_path(spark, "arrivals")
    df.drop("label", "outcome").repartition(4).write.parquet(folder)
    arrived = spark.read.parquet(folder)
    defaults = scoring.form_defaults(df, FEATURES)
    columns = ["row_id", "predicted", "band", "risk_group", "top"]
    out = score_available(spark, folder, arrived.schema, model, CLASSES, defaults, ["row_id"]).select(*columns)
    whole = scoring.score(arrived, model, CLASSES, defaults, ["row_id"]).select(*columns)
    same = F.lit(True)
    for c in columns[1:-1]:
        same = same & (F.col(c) == F.col(f"b_{c}"))
    both = out.join(whole.toDF("row_id", *[f"b_{c}" for c in columns[1:]]), "row_id")
    return both.select("row_id", (_consistent(both) & same & (F.abs(F.col("top") - F.col("b_top")) < 1e-9)).alias("sound"))


OUTCOME_SQL = SCORES_SQL + """, top AS (SELECT model, o_orderkey, greatest(p0, p1, p2) AS t, prediction FROM predicted)"""


@query("i29_confidence_band", f"""WITH {OUTCOME_SQL} SELECT model, o_orderkey,
  CASE WHEN t > 0.8 THEN 'High' WHEN t > 0.6 THEN 'Medium' ELSE 'Low' END AS band FROM top""")
def i29(spark, sf):
    out = scoring.add_outcome(scores(spark, sf).withColumn("p", F.col("probability")), CLASSES, ["model", "o_orderkey"])
    return out.select("model", "o_orderkey", "band")


@query("i30_risk_group", f"""WITH {OUTCOME_SQL} SELECT model, o_orderkey, CASE prediction WHEN 0 THEN 'Likely to Drop Out'
  WHEN 2 THEN 'Likely to Graduate' ELSE 'Likely to Stay Enrolled' END AS risk_group FROM top""")
def i30(spark, sf):
    out = scoring.add_outcome(scores(spark, sf).withColumn("p", F.col("probability")), CLASSES, ["model", "o_orderkey"])
    return out.select("model", "o_orderkey", "risk_group")


SUMMARY_ROWS = f"WITH {REPORT_SQL}, s AS ({SUMMARY_SQL}) SELECT model, {ROUNDED_METRICS} FROM s"


@query("i31_run_summary", f"{SUMMARY_ROWS} WHERE model LIKE 'BINN%'")
def i31(spark, sf):
    all_reports = reports(spark, sf)
    trained = all_reports.where(F.col("model").startswith("BINN")).select("model").distinct()
    return rounded(registry.run_summary(all_reports, trained))


@query("i32_lenient_summary", f"""WITH {REPORT_SQL}, kept AS (SELECT * FROM reports WHERE NOT (model = 'BASE_LR' AND row_label = 'weighted avg')),
s AS (SELECT model, max(precision) FILTER (row_label = 'accuracy') AS accuracy,
  coalesce(max(precision) FILTER (row_label = 'weighted avg'), max(precision) FILTER (row_label = 'macro avg')) AS precision,
  coalesce(max(recall) FILTER (row_label = 'weighted avg'), max(recall) FILTER (row_label = 'macro avg')) AS recall,
  coalesce(max(f1_score) FILTER (row_label = 'weighted avg'), max(f1_score) FILTER (row_label = 'macro avg')) AS f1,
  max(roc_auc) AS roc_auc FROM kept GROUP BY model)
SELECT model, {ROUNDED_METRICS} FROM s""")
def i32(spark, sf):
    kept = reports(spark, sf).where("not (model = 'BASE_LR' and row_label = 'weighted avg')")
    return rounded(registry.lenient_summary(kept))


@query("i33_summary", SUMMARY_ROWS)
def i33(spark, sf):
    return rounded(registry.summary(reports(spark, sf)))


@query("i33_summary_stream", SUMMARY_ROWS)
def i33_stream(spark, sf):
    """Reports arrive as files, a few a batch, and the query is stopped and started again between them."""
    every = reports(spark, sf).withColumn("part", F.pmod(F.xxhash64("model", "row_label"), F.lit(6)).cast("int"))
    every = materialise(every, "reports-parts")
    arrived, out, checkpoint = (fresh_path(spark, n) for n in ("reports-in", "reports-out", "reports-offsets"))
    for half in (F.col("part") < 3, F.col("part") >= 3):
        every.where(half).repartition(3, "part").drop("part").write.mode("append").parquet(arrived)
        stream = spark.readStream.schema(every.drop("part").schema).option("maxFilesPerTrigger", 2).parquet(arrived)
        follow_reports(stream, out, checkpoint).awaitTermination()
    return rounded(summary_so_far(spark, out))


@query("c2_report_lookup", f"""WITH {REPORT_SQL} SELECT model, round(max(precision) FILTER (row_label = '1'), 6) AS precision_1,
  round(max(support) FILTER (row_label = 'macro avg'), 6) AS n FROM reports GROUP BY model""")
def c2(spark, sf):
    return rounded(reports(spark, sf).groupBy("model").agg(
        registry.cell("1", "precision").alias("precision_1"), registry.cell("macro avg", "support").alias("n")))


BEST_SQL = f"WITH {REPORT_SQL} SELECT model, round(roc_auc, 6) AS roc_auc FROM model_auc WHERE roc_auc > 0 ORDER BY model_auc.roc_auc DESC, model LIMIT 1"


@query("f4_arg_max", BEST_SQL)
def f4(spark, sf):
    return rounded(registry.arg_max_auc(registry.summary(reports(spark, sf)).select("model", "roc_auc")))


@query("f5_best_model", BEST_SQL)
def f5(spark, sf):
    return rounded(registry.best_model(reports(spark, sf)))


@query("i34_register_best", BEST_SQL.replace("AS roc_auc FROM", "AS roc_auc, 'models/' || model AS path FROM"))
def i34(spark, sf):
    models = scores(spark, sf).select("model").distinct().select("model", F.concat(F.lit("models/"), "model").alias("path"))
    return rounded(registry.register_best(reports(spark, sf), models))


@query("a13_run_folder", _support_sql("BASE_LR", "BINN_LR"))
def a13(spark, sf):
    """Trains two configurations into a folder, skips them, trains one again, and reads what the folder holds.

    A row is sound if its model has one path, one importance per column and one confusion matrix that adds up."""
    folder = fresh_path(spark, "run")
    df = cases(spark, sf)
    configs = [c for c in training.training_matrix() if c.model in ("BASE_LR", "BINN_LR")]
    training.run_matrix(df, FULL, folder, configs)
    training.run_matrix(df, FULL, folder, configs, run_all=False)
    training.run_matrix(df, FULL, folder, configs[:1])
    read = lambda name: spark.read.parquet(f"{folder}/{name}")
    paths = read("trained").groupBy("model").agg((F.count("*") == 1).alias("one_path"))
    single = read("importance").groupBy("model").agg((F.count("*") == F.countDistinct("feature")).alias("single"))
    reports_ = _checked_reports(read("reports"))
    counted = read("confusion").groupBy("model").agg(F.sum(F.expr("pred_0 + pred_1 + pred_2")).alias("n"))
    total = reports_.where("row_label = 'macro avg'").join(counted, "model").select("model", (F.col("support") == F.col("n")).alias("adds_up"))
    checks = paths.join(single, "model").join(total, "model")
    return reports_.join(checks, "model").select("model", "row_label", "support", F.expr("sound AND one_path AND single AND adds_up").alias("sound"))


@query("a14_load_model", f"WITH {CASES_SQL} SELECT count(*) AS n, TRUE AS same FROM cases")
def a14(spark, sf):
    """The registered best model, loaded again, scores every case as the fitted one does."""
    folder = fresh_path(spark, "run")
    df = cases(spark, sf)
    _, trained, labels = training.run_matrix(df, FULL, folder, [c for c in training.training_matrix() if c.model == "BASE_LR"])
    model, meta = training.load_best(spark, folder)
    columns = ["case_id", "predicted", "top"]
    loaded = scoring.score(df, model, meta["class_names"], None, ["case_id"]).select(*columns)
    fitted = scoring.score(df, trained[0].model, labels, None, ["case_id"])
    both = loaded.join(fitted.select("case_id", F.col("predicted").alias("p"), F.col("top").alias("t")), "case_id")
    same = (F.col("predicted") == F.col("p")) & (F.abs(F.col("top") - F.col("t")) < 1e-9)
    return both.agg(F.count(F.lit(1)).alias("n"), F.every(same).alias("same"))


@query("a16_metadata", f"""WITH {CASES_SQL} SELECT 'class' AS kind, outcome AS name FROM cases GROUP BY outcome
UNION ALL SELECT 'numeric', unnest([{", ".join(f"'{c}'" for c in NUMERIC)}])
UNION ALL SELECT 'categorical', unnest([{", ".join(f"'{c}'" for c in TEXT)}])""")
def a16(spark, sf):
    table_, labels, _ = training.prepare(cases(spark, sf), FULL)
    path = fresh_path(spark, "metadata")
    training.metadata_table(table_, labels).write.parquet(path)

    def tagged(kind, column):
        return F.transform(column, lambda name: F.struct(F.lit(kind).alias("kind"), name.alias("name")))

    return spark.read.parquet(path).select(F.inline(F.concat(
        tagged("class", "class_names"), tagged("numeric", "numeric_columns"), tagged("categorical", "categorical_columns"))))


@query("a15_performance", _columns_sql())
def a15(spark, sf):
    folder = fresh_path(spark, "run")
    configs = [c for c in training.training_matrix() if c.model == "BASE_RF"]
    training.run_matrix(cases(spark, sf), FULL, folder, configs)
    return _sound_importances(importance.sort_importances(training.load_performance(spark, folder)["feature_importance"]))

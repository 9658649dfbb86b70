from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cohortica.config import BOOST_GRID, FOREST_GRID, SELECTED_FEATURES
from cohortica.operators import preprocess, scoring
from cohortica.plans import training
from cohortica.plans.cases import FEATURES, cases
from cohortica.plans.catalogue.learning import SEARCH as SETTINGS
from cohortica.streaming.scoring import score_available
from cohortica.workspace import fresh_path


def test_matrix_names():
    names = [c.model for c in training.training_matrix()]
    assert len(names) == len(set(names)) == 24
    assert names[:3] == ["BASE_LR", "BASE_LR_BALANCE", "BASE_LR_SMOTE"] and "BINN_XGB_GRID_SMOTE" in names
    assert sum(c.grid for c in training.training_matrix()) == 8
    assert sum(c.smote for c in training.training_matrix()) == 10
    assert len(SELECTED_FEATURES) == 17


def test_grids():
    forest = training.candidates(FOREST_GRID)
    assert len(forest) == 27 and all(c["max_depth"] in (10, 20, 30) for c in forest)
    boost = training.candidates(BOOST_GRID)
    assert len(boost) == 36 and list(boost[0]) == ["learning_rate", "max_depth", "n_estimators", "subsample"]


def test_ranking_takes_the_first_on_a_tie(spark):
    rows = [(1, 0, .5), (1, 1, .7), (0, 0, .7), (0, 1, .5), (2, 0, .1), (2, 1, .2)]
    ranked = training.rank_candidates(spark.createDataFrame(rows, "candidate int, fold int, roc_auc double"))
    assert [r["candidate"] for r in ranked.collect()] == [0, 1, 2]


def test_prepare_reports_missing_and_drops_unlabelled(spark, sf):
    df = cases(spark, sf).withColumn("outcome", F.when(F.col("case_id") % 10 != 0, F.col("outcome")))
    from dataclasses import replace
    table, labels, missing = training.prepare(df, replace(SETTINGS, features=(*FEATURES, "absent")))
    assert missing == ["absent"] and labels == ["Dropout", "Enrolled", "Graduate"]
    assert table.count() == df.where("outcome is not null").count()
    assert training.feature_columns(table) == list(FEATURES)


def test_a_run_reads_the_split_and_finds_medians_once(spark, monkeypatch):
    """Later reads of a prepared table hash no ids; preprocessors and metadata share the medians of the training rows."""
    import numpy as np

    from cohortica.operators import quantiles

    rng = np.random.default_rng(6)
    rows = [(k, float(v) if k % 9 else None, float(w), "abc"[k % 3] if k % 7 else None, "xy"[int(v + rng.normal() > 0)]) for k, (v, w) in enumerate(rng.normal(size=(400, 2)))]
    df = spark.createDataFrame(rows, "id long, v double, w double, t string, y string")
    settings = replace(SETTINGS, features=("v", "w", "t"), binarised=("w",), target="y", row_id="id")
    table, _, _ = training.prepare(df, settings)
    assert "md5" not in table.where("not is_test")._jdf.queryExecution().optimizedPlan().toString()
    asked, exact = [], quantiles._ranked
    monkeypatch.setattr(quantiles, "_ranked", lambda *a: asked.append(a[1]) or exact(*a))
    folder = fresh_path(spark, "run")
    training.run_matrix(df, settings, folder, [c for c in training.training_matrix() if c.model in ("BASE_LR", "BINN_LR")])
    assert asked == [["v", "w"]]
    train = [r for r in table.where("not is_test").collect()]
    middle = np.median([r["v"] for r in train if r["v"] is not None])
    _, meta = training.load_best(spark, folder)
    assert float(meta["defaults"]["v"]) == middle and meta["defaults"]["t"] == "a"
    plain = preprocess.fit(table.where("not is_test"), ("v", "w", "t"))
    assert plain.medians["v"] == middle


def test_run_folder_and_scoring(spark, sf):
    folder = fresh_path(spark, "run")
    df = cases(spark, sf)
    configs = [c for c in training.training_matrix() if c.model in ("BASE_LR", "BASE_RF_SMOTE", "BINN_XGB")]
    reports, trained, labels = training.run_matrix(df, SETTINGS, folder, configs[:2])
    again, only, _ = training.run_matrix(df, SETTINGS, folder, configs, run_all=False)
    assert [t.config.model for t in only] == ["BINN_XGB"]
    performance = training.load_performance(spark, folder)
    assert {r["model"] for r in performance["results"].collect()} == {c.model for c in configs}
    assert performance["feature_importance"].count() > 0
    model, meta = training.load_best(spark, folder)
    best = performance["results"].orderBy(F.desc("roc_auc")).first()
    assert spark.read.parquet(f"{folder}/best_model").first()["model"] == best["model"] and best["roc_auc"] > 0.8
    assert meta["class_names"] == labels and meta["feature_columns"] == list(FEATURES)
    assert meta["categorical_columns"] == ["priority", "segment"]

    defaults = scoring.form_defaults(df, FEATURES)
    fresh = df.drop("outcome", "acct_bal")
    batch = scoring.score(fresh, model, labels, defaults, ["case_id"])
    source = fresh_path(spark, "arrivals")
    fresh.repartition(3).write.parquet(source)
    stream = score_available(spark, source, spark.read.parquet(source).schema, model, labels, defaults, ["case_id"])
    assert sorted(map(str, batch.collect())) == sorted(map(str, stream.select(batch.columns).collect()))
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert batch.count() == df.count() and "features" not in batch.columns and plan


def test_search_with_resampling(spark, sf):
    table, _, _ = training.prepare(cases(spark, sf), SETTINGS)
    train = table.where("not is_test").drop("is_test")
    config = next(c for c in training.training_matrix() if c.model == "BASE_RF_GRID_SMOTE")
    params, scores = training.search(train, config, SETTINGS)
    assert scores.count() == 4 * 3 and set(params) == {"n_estimators", "max_depth"}
    assert scores.agg(F.min("roc_auc")).first()[0] > 0.6


def test_search_over_rounds_and_depths(spark, sf):
    """Candidates that differ in rounds come from one fit, and score as boosters fitted alone."""
    from dataclasses import replace

    from cohortica.operators import learners, metrics

    grid = replace(SETTINGS, boost_grid={"n_estimators": (1, 3), "max_depth": (2, 3), "learning_rate": (0.1,), "subsample": (0.8, 1.0)}, folds=2)
    table, _, _ = training.prepare(cases(spark, sf), grid)
    train = table.where("not is_test").drop("is_test")
    config = next(c for c in training.training_matrix() if c.model == "BASE_XGB_GRID")
    params, scores = training.search(train, config, grid)
    assert scores.count() == 8 * 2 and scores.agg(F.min("roc_auc")).first()[0] > 0.6
    folded = training.split.stratified_folds(train, "label", "row_id", grid.folds, grid.seed)
    part, held = folded.where("fold <> 0"), folded.where("fold = 0")
    fitted = training._fit_pre(part, "base", grid)
    learn = training._learning_rows(fitted, part, False, grid)
    tries = training.candidates(grid.boost_grid)
    alone = learners.scored(learners.fit_learner("xgb", learn, grid, False, tries[0]), fitted.transform(held))
    found = scores.where("candidate = 0 and fold = 0").first()["roc_auc"]
    assert metrics.weighted_auc(alone).first()["roc_auc"] == pytest.approx(found)


def test_searches_share_the_rows_of_folds(spark, sf, monkeypatch):
    """A run fits the preprocessor of a fold once for all its searches, and they score as searches alone."""
    from dataclasses import replace

    few = replace(SETTINGS, folds=2, boost_grid={"n_estimators": (1, 2), "max_depth": (2,)})
    table, _, _ = training.prepare(cases(spark, sf), few)
    train = table.where("not is_test").drop("is_test")
    fitted, fit = [], training._fit_pre
    monkeypatch.setattr(training, "_fit_pre", lambda *args: fitted.append(args[1]) or fit(*args))
    configs = [c for c in training.training_matrix() if c.model in ("BASE_XGB_GRID", "BASE_RF_GRID", "BASE_XGB_GRID_SMOTE")]
    shared, together = {}, []
    try:
        together = [sorted(training.search(train, c, few, shared)[1].collect()) for c in configs]
    finally:
        training.release(shared)
    assert fitted == ["base"] * 2
    assert [sorted(training.search(train, c, few)[1].collect()) for c in configs[1:]] == together[1:]


def test_reports_arrive_in_any_order(spark):
    """Whatever the order of the files and wherever the query is stopped, the summary is that of all rows."""
    from cohortica.operators import registry
    from cohortica.streaming.reports import best_so_far, follow_reports, summary_so_far

    columns = "model string, row_label string, precision double, recall double, f1_score double, support double, roc_auc double"
    rows = [(f"m{k}", label, 0.1 * k, 0.2, 0.05 * k, 9.0, 0.5 + 0.1 * k if label == "roc_auc" else None)
            for k in range(4) for label in ("0", "accuracy", "weighted avg", "roc_auc") if (k, label) != (3, "accuracy")]
    whole = spark.createDataFrame(rows, columns)
    for order in (range(len(rows)), [7, 0, 14, 3, 11, 5, 1, 9, 2, 13, 4, 8, 6, 12, 10]):
        arrived, out, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "offsets"))
        order = list(order)
        for part in (order[:4], order[4:5], order[5:]):
            for k in part[::3]:
                spark.createDataFrame([rows[i] for i in part[part.index(k):part.index(k) + 3]], columns).coalesce(1).write.mode("append").parquet(arrived)
            stream = spark.readStream.schema(columns).option("maxFilesPerTrigger", 1).parquet(arrived)
            follow_reports(stream, out, checkpoint).awaitTermination()
        assert sorted(summary_so_far(spark, out).collect()) == sorted(registry.summary(whole).collect())
        assert best_so_far(spark, out).collect() == registry.best_model(whole).collect() and best_so_far(spark, out).first()["model"] == "m3"


def test_defaults_fill(spark):
    df = spark.createDataFrame([(1.0, "b"), (3.0, "a"), (None, None)], "x double, s string")
    defaults = scoring.form_defaults(df, ["x", "s"])
    assert defaults == {"x": 2.0, "s": "a"}
    filled = scoring.fill_inputs(spark.createDataFrame([(None,), (9.0,)], "x double"), defaults)
    assert [tuple(r) for r in filled.collect()] == [(2.0, "a"), (9.0, "a")]
    with pytest.raises(Exception):
        filled.select("y").collect()


def test_training_again_replaces_a_model(spark, sf):
    from dataclasses import replace

    folder, df = fresh_path(spark, "run"), cases(spark, sf)
    configs = [c for c in training.training_matrix() if c.model in ("BASE_RF", "BASE_LR")]
    training.run_matrix(df, SETTINGS, folder, configs)
    before = {r["model"]: r["roc_auc"] for r in training.load_performance(spark, folder)["results"].collect()}
    stump = replace(SETTINGS, forest_trees=1, forest_max_depth=1)
    training.run_matrix(df, stump, folder, [c for c in configs if c.model == "BASE_RF"])
    after = {r["model"]: r["roc_auc"] for r in training.load_performance(spark, folder)["results"].collect()}
    assert after["BASE_LR"] == before["BASE_LR"] and after["BASE_RF"] < before["BASE_RF"]
    reports = spark.read.parquet(f"{folder}/reports")
    assert reports.groupBy("model", "row_label").count().where("count > 1").count() == 0
    assert spark.read.parquet(f"{folder}/importance").groupBy("model", "feature").count().where("count > 1").count() == 0
    assert training.trained_models(spark, folder).count() == 2
    confusion = spark.read.parquet(f"{folder}/confusion")
    held = reports.where("row_label = 'macro avg'").select("model", "support").collect()
    totals = {r["model"]: r["n"] for r in confusion.groupBy("model").agg(F.sum(F.expr("pred_0 + pred_1 + pred_2")).alias("n")).collect()}
    assert {r["model"]: r["support"] for r in held} == totals


def test_a_stopped_run_goes_on(spark, sf, monkeypatch):
    """What has ended is kept when the run stops, and the next run trains the rest."""
    folder, df = fresh_path(spark, "run"), cases(spark, sf)
    names = ["BASE_LR", "BINN_LR", "BASE_LR_BALANCE", "BINN_RF", "BASE_RF"]
    configs = [next(c for c in training.training_matrix() if c.model == n) for n in names]
    fits, fit = [], training.fit_learner

    def stop_at_the_fourth(*args, **options):
        fits.append(1)
        if len(fits) == 4:
            raise RuntimeError("stopped")
        return fit(*args, **options)

    monkeypatch.setattr(training, "fit_learner", stop_at_the_fourth)
    with pytest.raises(RuntimeError, match="stopped"):
        training.run_matrix(df, SETTINGS, folder, configs)
    assert {r["model"] for r in training.trained_models(spark, folder).collect()} == set(names[:3])
    assert spark.catalog is not None and spark.sparkContext._jsc.sc().getPersistentRDDs().isEmpty()
    reports, trained, _ = training.run_matrix(df, SETTINGS, folder, configs, run_all=False)
    assert [t.config.model for t in trained] == names[3:] and {r["model"] for r in reports.collect()} == set(names[3:])
    assert {r["model"] for r in training.load_performance(spark, folder)["results"].collect()} == set(names)
    assert training.load_best(spark, folder)[0].stages


def test_no_configurations_train_nothing(spark, sf):
    reports, trained, _ = training.run_matrix(cases(spark, sf), SETTINGS, None, [])
    assert reports is None and trained == []


def test_nothing_stays_cached(spark, sf):
    spark.catalog.clearCache()
    table, _, _ = training.prepare(cases(spark, sf), SETTINGS)
    config = next(c for c in training.training_matrix() if c.model == "BASE_LR")
    training.train_one(table.where("not is_test").drop("is_test"), config, SETTINGS)
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().isEmpty()

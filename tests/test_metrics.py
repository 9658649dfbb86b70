import numpy as np
import pytest

from cohortica.operators import metrics, registry


def brute(score, hit):
    pos, neg = score[hit], score[~hit]
    d = pos[:, None] - neg[None]
    return ((d > 0).sum() + 0.5 * (d == 0).sum()) / (len(pos) * len(neg))


def scored(spark, y, p, pred=None):
    pred = p.argmax(1) if pred is None else pred
    return spark.createDataFrame(
        [(int(a), int(c), [float(v) for v in b]) for a, b, c in zip(y, p, pred)],
        "label int, prediction int, probability array<double>").repartition(5)


@pytest.mark.parametrize("buckets", [2, 3, 50])
def test_auc_against_brute_force(spark, buckets):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 400)
    p = np.round(rng.dirichlet([1, 1, 1], 400), 2)  # many ties
    p[:150] = [0.2, 0.3, 0.5]  # a hot score
    got = {r["class"]: r["auc"] for r in metrics.class_auc(scored(spark, y, p), (), buckets).collect()}
    want = {k: brute(p[:, k], y == k) for k in range(3)}
    assert got == pytest.approx(want, abs=1e-14)
    weighted = metrics.weighted_auc(scored(spark, y, p), (), buckets).first()["roc_auc"]
    assert weighted == pytest.approx(sum(want[k] * (y == k).mean() for k in range(3)), abs=1e-14)
    flipped = {r["class"]: r["auc"] for r in metrics.class_auc(scored(spark, y, 1 - p), (), buckets).collect()}
    assert flipped == pytest.approx({k: 1 - v for k, v in want.items()}, abs=1e-14)


def test_auc_edges(spark):
    y = np.array([0, 0, 1, 1])
    tied = np.full((4, 2), 0.5)
    assert metrics.weighted_auc(scored(spark, y, tied)).first()["roc_auc"] == 0.5
    perfect = np.array([[0.9, 0.1], [0.8, 0.2], [0.3, 0.7], [0.1, 0.9]])
    assert metrics.weighted_auc(scored(spark, y, perfect)).first()["roc_auc"] == 1.0
    assert metrics.weighted_auc(scored(spark, y, perfect[::-1])).first()["roc_auc"] == 0.0
    one_class = metrics.weighted_auc(scored(spark, np.zeros(4, int), perfect)).first()["roc_auc"]
    assert one_class is None


def test_report_by_hand(spark):
    # class 2 is never predicted, class 3 never true
    y, pred = [0, 0, 0, 1, 1, 2], [0, 0, 1, 1, 3, 0]
    df = scored(spark, np.array(y), np.full((6, 4), 0.25), pred)
    rows = {r["row_label"]: r for r in metrics.classification_report(df).collect()}
    assert rows["0"]["precision"] == pytest.approx(2 / 3) and rows["0"]["recall"] == pytest.approx(2 / 3)
    assert (rows["2"]["precision"], rows["2"]["recall"], rows["2"]["f1_score"], rows["2"]["support"]) == (0, 0, 0, 1)
    assert (rows["3"]["support"], rows["3"]["recall"]) == (0, 0)
    assert [rows["accuracy"][c] for c in ("precision", "recall", "f1_score", "support")] == [0.5] * 4
    assert rows["macro avg"]["precision"] == pytest.approx((2 / 3 + 1 / 2) / 4)
    assert rows["weighted avg"]["recall"] == pytest.approx(0.5) and rows["weighted avg"]["support"] == 6
    matrix = {r["label"]: [r[f"pred_{i}"] for i in range(4)] for r in metrics.confusion_matrix(df, 4).collect()}
    assert matrix == {0: [2, 1, 0, 0], 1: [0, 1, 0, 1], 2: [1, 0, 0, 0]}


def reports(spark, rows):
    return spark.createDataFrame(
        rows, "model string, row_label string, precision double, recall double, f1_score double, support double, roc_auc double")


def test_registry_edges(spark):
    def model(name, auc, weighted=True):
        out = [(name, "accuracy", .5, .5, .6, .5, None), (name, "macro avg", .1, .2, .3, 9.0, None),
               (name, "roc_auc", None, None, None, None, auc)]
        return out + ([(name, "weighted avg", .4, .5, .6, 9.0, None)] if weighted else [])

    df = reports(spark, model("null", None) + model("zero", 0.0) + model("b", .9) + model("a", .9) + model("nw", .95, False))
    assert registry.best_model(df.where("model <> 'nw'")).first()["model"] == "a"
    assert registry.best_model(df.where("model in ('null', 'zero')")).count() == 0
    assert registry.arg_max_auc(df.where("row_label = 'roc_auc' and model in ('null', 'zero')")).first()["model"] == "zero"
    assert {r["model"] for r in registry.summary(df).collect()} == {"zero", "a", "b"}
    lenient = {r["model"]: r for r in registry.lenient_summary(df).collect()}
    assert lenient["nw"]["precision"] == .1 and lenient["a"]["precision"] == .4
    assert lenient["null"]["roc_auc"] is None and lenient["a"]["accuracy"] == .5
    configs = spark.createDataFrame([("a",), ("c",)], "model string")
    assert [r["model"] for r in registry.left_to_train(configs, df).collect()] == ["c"]
    assert registry.left_to_train(configs, df, run_all=True).count() == 2

from __future__ import annotations

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator

from tablewright.operators import estimators, features, splits, tuning
from tablewright.sources import models
from tablewright.workspace import scratch_path


@pytest.fixture(scope="module")
def lin(spark):
    """label = 3 x1 - 2 x2 + 1."""
    rng = random.Random(1)
    rows = [(i, rng.uniform(-5, 5), rng.uniform(-5, 5)) for i in range(400)]
    df = spark.createDataFrame([(i, a, b, 3 * a - 2 * b + 1) for i, a, b in rows], "id int, x1 double, x2 double, label double")
    return features.assemble(df, ["x1", "x2"]).cache()


@pytest.fixture(scope="module")
def sep2(spark):
    """label is 1 where x1 > 0; x2 is noise."""
    rng = random.Random(2)
    rows = [(i, x, rng.uniform(0, 1), 1.0 if x > 0 else 0.0) for i, x in ((i, rng.uniform(-1, 1)) for i in range(400))]
    df = spark.createDataFrame(rows, "id int, x1 double, x2 double, label double")
    return features.assemble(df, ["x1", "x2"]).cache()


@pytest.mark.parametrize("name", ["linear_regress", "glm_regress"])
def test_planted_coefficients(spark, lin, name):
    model = estimators.make(name).fit(lin)
    got = {r.term: r.estimate for r in estimators.coefficient_rows(spark, model, ["x1", "x2"]).collect()}
    assert got == pytest.approx({"intercept": 1.0, "x1": 3.0, "x2": -2.0}, abs=1e-6)


@pytest.mark.parametrize(
    "name,params",
    [
        ("dtree_classify", {}),
        ("logistic_classify", {}),
        ("linear_svm_classify", {"maxIter": 50}),
        ("gbt_classify", {"maxIter": 3}),
        ("rf_classify", {"numTrees": 5}),
    ],
)
def test_classifiers_find_the_planted_rule(sep2, name, params):
    report = estimators.fit_and_score(estimators.make(name, **params), sep2, ["id"], "binary")
    got = {(r.split, r.metric): r for r in report.collect()}
    assert got["test", "roc_auc"].value >= 0.95
    assert got["train", "tpr"].n_rows + got["test", "tpr"].n_rows == 400


@pytest.mark.parametrize("name,params", [("dtree_regress", {}), ("gbt_regress", {"maxIter": 5}), ("rf_regress", {})])
def test_regressors_beat_the_mean(lin, name, params):
    report = estimators.fit_and_score(estimators.make(name, **params), lin, ["id"], "regression")
    r2 = {r.split: r.value for r in report.collect() if r.metric == "r2"}
    assert r2["test"] > 0.7


def test_network_and_its_parameter_count(spark, sep2):
    network = estimators.make("mlp_classify", layers=[2, 4, 2])
    model = network.fit(sep2)
    counts = estimators.layer_parameter_counts([2, 4, 2])
    assert counts == [(0, 12), (1, 10)]
    assert sum(n for _, n in counts) == model.weights.size
    assert sum(n for _, n in estimators.layer_parameter_counts([64, 16, 10])) == 1210


def test_kept_rows_lie_the_same_however_they_came(spark):
    from tablewright import workspace

    def layout(df):
        with workspace.kept(df, spread_by=["id"]) as rows:
            return [list(map(tuple, p)) for p in rows.rdd.glom().collect()]

    found = layout(spark.range(0, 5000).coalesce(1))
    assert found == layout(spark.range(0, 5000, numPartitions=13)) and len(found) > 1


def test_an_estimator_that_draws_needs_a_seed(spark, lin):
    for name in ("dtree_regress", "gbt_regress", "rf_regress"):
        assert estimators.make(name).getSeed() == 1234567
    fits = [estimators.make("rf_regress", numTrees=3).fit(lin).toDebugString.split("\n", 1)[1] for _ in range(2)]
    assert fits[0] == fits[1]


def test_a_class_named_all_is_a_class(spark):
    from tablewright.operators import metrics

    df = spark.createDataFrame([("all", "all"), ("all", "b"), ("b", "b")], "label string, prediction string")
    got = metrics.multiclass_metrics(metrics.multiclass_confusion(df)).collect()
    assert {(r["class"], r.is_total) for r in got} == {("all", False), ("b", False), (None, True)}


def test_saved_model_predicts_the_same(spark, lin):
    model = estimators.make("linear_regress").fit(lin)
    again = models.reload_model(model, models.save_model(model, scratch_path(spark, "m")))
    assert again.coefficients == model.coefficients and again.intercept == model.intercept


def test_cross_validation_reports_every_point(spark, sep2):
    model = tuning.cross_validate(
        sep2, ["id"], estimators.make("dtree_classify"), BinaryClassificationEvaluator(),
        {"maxDepth": [1, 3], "impurity": ["gini", "entropy"]}, folds=3,
    )
    rows = tuning.grid_rows(spark, model, larger_is_better=True).collect()
    assert len(rows) == 4 and sum(r.is_best for r in rows) == 1
    best = {r.param: r.value for r in tuning.best_param_rows(spark, model).collect()}
    chosen = next(r.params for r in rows if r.is_best)
    assert f"maxDepth={best['maxDepth']}" in chosen and f"impurity={best['impurity']}" in chosen


def test_regularisation_search_picks_the_smallest_error(spark, lin):
    model = tuning.cross_validate(
        lin, ["id"], estimators.make("linear_regress"), RegressionEvaluator(), {"regParam": [0.0, 10.0]}, folds=3
    )
    rows = tuning.grid_rows(spark, model, larger_is_better=False).collect()
    assert [r.is_best for r in rows] == [True, False]


def test_full_grids_have_the_known_sizes():
    sizes = {name: len(tuning.grid_points(axes)) for name, axes in tuning.GRIDS.items()}
    assert sizes == {
        "linear_regress": 42, "glm_regress": 42, "logistic_classify": 1, "naive_bayes_classify": 4,
        "linear_svm_classify": 1, "dtree_classify": 24, "gbt_classify": 9, "rf_classify": 108,
        "dtree_regress": 9, "gbt_regress": 9, "rf_regress": 36,
    }
    for name, axes in tuning.GRIDS.items():
        assert len(tuning.param_maps(estimators.make(name), axes)) == sizes[name]


def test_rules_and_importances(spark, sep2):
    model = estimators.make("dtree_classify", maxDepth=2).fit(sep2)
    rules = [r.rule for r in estimators.rule_rows(spark, model).orderBy("line_no").collect()]
    assert any("If (feature 0 <=" in r for r in rules)
    first = estimators.importance_rows(spark, model, ["x1", "x2"]).first()
    assert first.feature == "x1" and first.importance > 0.9


def _brute_split(values, labels, impurity):
    best = None
    distinct = sorted(set(values))
    for a, b in zip(distinct, distinct[1:]):
        t = (a + b) / 2
        left = [y for v, y in zip(values, labels) if v <= t]
        right = [y for v, y in zip(values, labels) if v > t]
        n = len(labels)
        gain = impurity(labels) - len(left) / n * impurity(left) - len(right) / n * impurity(right)
        if best is None or round(gain, 9) > round(best[1], 9):
            best = (t, gain)
    return best


def test_best_splits_match_brute_force(spark, many_blocks):
    rng = random.Random(8)
    values = [rng.randint(0, 60) for _ in range(300)]
    labels = [1 if v + rng.gauss(0, 15) > 30 else 0 for v in values]
    df = spark.createDataFrame(list(zip(values, labels)), "x int, label int").repartition(5)

    def gini(ys):
        p = sum(ys) / len(ys)
        return 2 * p * (1 - p)

    def variance(ys):
        m = sum(ys) / len(ys)
        return sum((y - m) ** 2 for y in ys) / len(ys)

    t, gain = _brute_split(values, labels, gini)
    got = splits.gini_best_split(df, ["x"]).first()
    assert (got.threshold, got.gain) == (t, pytest.approx(gain, abs=1e-8))
    t, gain = _brute_split(values, labels, variance)
    got = splits.variance_best_split(df, ["x"], digits=9).first()
    assert (got.threshold, got.gain) == (t, pytest.approx(gain, abs=1e-8))


def test_first_split_of_a_tree_is_the_best_split(sep2):
    model = estimators.make("dtree_classify", maxDepth=1, maxBins=512).fit(sep2)
    got = splits.gini_best_split(sep2, ["x1", "x2"]).orderBy("gain", ascending=False).first()
    root = float(model.toDebugString.split("<=")[1].split(")")[0])
    assert got.feature == "x1" and got.threshold == pytest.approx(root)


def test_tuned_report_is_held_out(sep2):
    from tablewright.plans.workflows import tuned_report

    report = tuned_report(sep2, ["id"], "logistic_classify", "binary", folds=3).collect()
    assert {r.split for r in report} == {"test"} and 100 < report[0].n_rows < 220
    assert next(r.value for r in report if r.metric == "roc_auc") > 0.95

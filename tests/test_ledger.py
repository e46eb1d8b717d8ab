from __future__ import annotations

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator

from tablewright.operators import estimators, features, ledger, tuning
from tablewright.workspace import scratch_path

AXES = {"maxDepth": [1, 3], "impurity": ["gini", "entropy"]}
FOLDS = 3


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    values = [(i, x, rng.uniform(0, 1), float(x + rng.gauss(0, 0.4) > 0)) for i, x in ((i, rng.uniform(-1, 1)) for i in range(300))]
    return features.assemble(spark.createDataFrame(values, "id int, x1 double, x2 double, label double"), ["x1", "x2"]).cache()


@pytest.fixture
def root(spark):
    return scratch_path(spark, "ledgers")


@pytest.fixture
def made(monkeypatch):
    """Fits made so far, as (point, fold); the one after ``made.limit`` fails."""

    class Made(list):
        limit = None

    fits, plain = Made(), ledger.fit_and_judge

    def fit(stored, estimator, evaluator, point, fold):
        if fits.limit is not None and len(fits) >= fits.limit:
            raise RuntimeError("the driver is lost")
        fits.append((ledger.point_text(point), fold))
        return plain(stored, estimator, evaluator, point, fold)

    monkeypatch.setattr(ledger, "fit_and_judge", fit)
    return fits


def search(rows, root, axes=AXES, parallelism=2, estimator=None):
    return ledger.cross_validate_resumable(
        rows, ["id"], estimator or estimators.make("dtree_classify"), BinaryClassificationEvaluator(), axes, root, FOLDS, parallelism=parallelism
    )


def test_equals_the_plain_search(spark, rows, root):
    got = search(rows, root)
    want = tuning.cross_validate(rows, ["id"], estimators.make("dtree_classify"), BinaryClassificationEvaluator(), AXES, FOLDS)
    assert got.avgMetrics == pytest.approx(want.avgMetrics, abs=1e-12)
    assert got.stdMetrics == pytest.approx(want.stdMetrics, abs=1e-12)
    assert tuning.best_param_rows(spark, got).collect() == tuning.best_param_rows(spark, want).collect()
    assert tuning.grid_rows(spark, got, True).select("params", "is_best").collect() == tuning.grid_rows(spark, want, True).select("params", "is_best").collect()


def test_a_broken_off_search_goes_on_without_refitting(rows, root, made):
    made.limit = 5
    with pytest.raises(RuntimeError, match="lost"):
        search(rows, root, parallelism=1)
    before = list(made)
    made.limit = None
    got = search(rows, root, parallelism=1)
    assert len(before) == 5 and len(made) == 12 and len(set(made)) == 12
    again = search(rows, root)
    assert len(made) == 12 and again.avgMetrics == got.avgMetrics


def test_a_wider_grid_fits_its_new_points_only(rows, root, made):
    search(rows, root, {"maxDepth": [1], "impurity": ["gini"]})
    search(rows, root, AXES)
    assert len(made) == 12 and len(set(made)) == 12


def test_other_rows_or_parameters_start_another_ledger(spark, rows, root, made):
    one = {"maxDepth": [1]}
    search(rows, root, one)
    search(rows.where("id <> 7"), root, one)
    search(rows, root, one, estimator=estimators.make("dtree_classify", maxBins=5))
    assert len(made) == 3 * FOLDS
    report = ledger.ledger_report(spark, root).collect()
    assert len(report) == 3 and all(r.n_folds == FOLDS and r.least <= r.mean <= r.most for r in report)


def test_smallest_error_is_best(spark, rows, root):
    model = ledger.cross_validate_resumable(
        rows, ["id"], estimators.make("linear_regress"), RegressionEvaluator(), {"regParam": [0.0, 10.0]}, root, FOLDS
    )
    assert [r.is_best for r in tuning.grid_rows(spark, model, larger_is_better=False).collect()] == [True, False]


def test_a_fold_without_rows_is_an_error(rows, root):
    with pytest.raises(ValueError, match="folds"):
        search(rows.where("id < 2"), root)

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression

from tablewright.operators import estimators, tuning
from tablewright.operators.sampling import assign_folds
from tablewright.workspace import kept

FOLDS = 3
GRIDS = {
    "linear_regress": {"regParam": [0.0, 0.1, 10.0]},
    "dtree_regress": {"maxBins": [8, 16], "maxDepth": [1, 3, 6]},
}


@pytest.fixture(scope="module")
def curved(spark):
    """A label that bends, one constant feature and one far from zero."""
    rng = np.random.default_rng(11)
    x = np.c_[rng.normal(size=900), rng.normal(50.0, 2.0, 900), np.full(900, 7.0)]
    y = np.sin(2 * x[:, 0]) + 0.3 * (x[:, 1] - 50) + 0.1 * rng.normal(size=900)
    return spark.createDataFrame([(i, float(v), Vectors.dense(r)) for i, (v, r) in enumerate(zip(y, x))], ["id", "label", "features"])


@pytest.mark.parametrize("name,kind,n_fits", [("linear_regress", LinearRegression, 10), ("dtree_regress", DecisionTreeRegressor, 7)])
def test_shared_work_gives_the_metrics_of_a_fit_for_each_point_and_fold(curved, monkeypatch, name, kind, n_fits):
    estimator, evaluator, axes = estimators.make(name), RegressionEvaluator(), GRIDS[name]
    folded = assign_folds(curved, ["id"], FOLDS, 12345)
    with kept(folded, spread_by=["id"]) as stored:
        maps = tuning.param_maps(estimator, axes)
        want = tuning._plain_metrics(stored, estimator, evaluator, maps, FOLDS, 4)
    sizes = []
    fit = kind._fit
    monkeypatch.setattr(kind, "_fit", lambda self, df: sizes.append(df.count()) or fit(self, df))
    found = tuning.cross_validate(curved, ["id"], estimator, evaluator, axes, FOLDS)
    assert found.avgMetrics == pytest.approx(want.mean(axis=1).tolist(), rel=1e-8)
    assert found.stdMetrics == pytest.approx(want.std(axis=1).tolist(), rel=1e-6)
    # One fit a fold serves all depths; least squares meets the rows themselves only in its last fit.
    assert len(sizes) == n_fits
    assert name != "linear_regress" or [n for n in sizes if n > 10] == [900]


@pytest.mark.parametrize("metric", ["rmse", "mae"])
def test_leaves_get_their_values_without_moving_rows(curved, monkeypatch, metric):
    """The rows of a fold meet the leaves' values as arrays: no join, and one pass where the metric is a mean."""
    estimator, evaluator, axes = estimators.make("dtree_regress"), RegressionEvaluator(metricName=metric), GRIDS["dtree_regress"]
    folded = assign_folds(curved, ["id"], FOLDS, 12345)
    with kept(folded, spread_by=["id"]) as stored:
        maps = tuning.param_maps(estimator, axes)
        want = tuning._plain_metrics(stored, estimator, evaluator, maps, FOLDS, 4)
        passes, evaluate = [], RegressionEvaluator._evaluate
        monkeypatch.setattr(RegressionEvaluator, "_evaluate", lambda self, df: passes.append(df) or evaluate(self, df))
        found = tuning._nested_metrics(stored, estimator, evaluator, maps, FOLDS, 4)
    assert found.ravel().tolist() == pytest.approx(want.ravel().tolist(), rel=1e-8)
    assert len(passes) == (0 if metric == "rmse" else 2 * 3 * FOLDS)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in passes]
    assert not any("Join" in plan for plan in plans)


def test_a_fold_without_rows_is_an_error(curved):
    with pytest.raises(ValueError, match="folds have rows"):
        tuning.cross_validate(curved.limit(2), ["id"], estimators.make("linear_regress"), RegressionEvaluator(), GRIDS["linear_regress"], 5)

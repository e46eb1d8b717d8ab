"""Trained models on the driver tables do better than chance, and repeat."""

from __future__ import annotations

import pytest

from tablewright.plans.catalog import QUERIES


def _metric(spark, small, name, metric, split="test"):
    return {(r.split, r.metric): r.value for r in QUERIES[name](spark, small).collect()}[split, metric]


@pytest.mark.parametrize("name", ["dtree_classify", "logistic_classify", "gbt_classify", "rf_classify"])
def test_document_quality_beats_chance(spark, small, name):
    assert _metric(spark, small, name, "roc_auc", "train") > 0.6


@pytest.mark.parametrize("name", ["dtree_regress", "gbt_regress", "rf_regress"])
def test_prices_are_fitted_and_not_spoilt(spark, small, name):
    """The label is nearly independent of the inputs, so held-out rows stay near their mean."""
    assert _metric(spark, small, name, "r2", "train") > 0.0
    assert _metric(spark, small, name, "r2") > -1.0


def test_clusters_cost_less_the_more_there_are(spark, small):
    costs = [r.cost for r in QUERIES["kmeans_elbow"](spark, small).orderBy("k").collect()]
    assert len(costs) == 19 and costs[-1] < costs[0]
    sweep = QUERIES["kmeans_silhouette_sweep"](spark, small).collect()
    assert all(-1 <= r.silhouette <= 1 for r in sweep)


@pytest.mark.parametrize("name", ["als_fit_predict", "als_new_user_rmse"])
def test_recommender_fits_its_ratings(spark, small, name):
    got = {r.split: r.rmse for r in QUERIES[name](spark, small).collect()}
    assert 0 < got["train"] < 1.5 and got["train"] <= got["test"]


def test_full_search_reports_every_point(spark, small):
    rows = QUERIES["cross_validate_grid"](spark, small).collect()
    assert len(rows) == 24 and sum(r.is_best for r in rows) == 1
    best = next(r for r in rows if r.is_best)
    assert best.mean_metric == max(r.mean_metric for r in rows)


@pytest.mark.parametrize("name", ["dtree_regress", "gbt_regress", "rf_regress"])
def test_fits_on_lines_do_not_follow_the_order_of_arrival(spark, small, tmp_path, name):
    """Lines of an order share numbers, so the key alone does not order them."""
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    assert lines.select("l_orderkey", "l_linenumber").distinct().count() < lines.count()
    lines.coalesce(1).orderBy("l_extendedprice").write.parquet(f"{tmp_path}/up/lineitem.parquet")
    lines.coalesce(1).orderBy("l_extendedprice", ascending=False).write.parquet(f"{tmp_path}/down/lineitem.parquet")
    for order in ("up", "down"):
        spark.read.parquet(f"{small}/part.parquet").write.parquet(f"{tmp_path}/{order}/part.parquet")
    found = [
        {(r.split, r.n_rows, r.metric): r.value for r in QUERIES[name](spark, f"{tmp_path}/{order}").collect()}
        for order in ("up", "down")
    ]
    assert found[0] == pytest.approx(found[1], rel=1e-9)


def test_lines_are_counted_without_their_join(spark, small, monkeypatch):
    plans = []
    kind = type(spark.range(1))
    count = kind.count
    monkeypatch.setattr(
        kind, "count", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or count(df)
    )
    rows = QUERIES["dtree_regress"](spark, small).collect()
    assert plans and not any("Join" in plan for plan in plans)
    sizes = {r.split: r.n_rows for r in rows}
    assert sum(sizes.values()) == spark.read.parquet(f"{small}/lineitem.parquet").count()

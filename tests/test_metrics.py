"""Metrics against Spark's own evaluators on the same rows, and against hand values."""

from __future__ import annotations

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tablewright.operators import metrics


@pytest.fixture(scope="module")
def scored(spark):
    """Scores with many ties; positives lean to high scores."""
    rng = random.Random(5)
    rows = []
    for _ in range(800):
        s = rng.randint(0, 40) / 40
        rows.append((1.0 if rng.random() < s else 0.0, s, 1.0 if s > 0.5 else 0.0))
    return spark.createDataFrame(rows, "label double, score double, prediction double").cache()


@pytest.mark.parametrize(
    "ours,theirs", [(metrics.roc_auc, "areaUnderROC"), (metrics.pr_auc, "areaUnderPR")]
)
@pytest.mark.parametrize("column", ["score", "prediction"])
def test_areas(scored, many_blocks, ours, theirs, column):
    raw = scored.withColumn("raw", array_to_vector(F.array(-F.col(column), F.col(column))))
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="raw", metricName=theirs, numBins=0)
    assert ours(scored, score=column).first()[0] == pytest.approx(evaluator.evaluate(raw), abs=1e-12)


def test_regression(spark):
    rng = random.Random(6)
    rows = [(y, y * 0.8 + rng.gauss(3, 2)) for y in (rng.uniform(1e6, 2e6) for _ in range(300))]
    df = spark.createDataFrame(rows, "label double, prediction double")
    got = metrics.regression_metrics(df).first()
    for ours, theirs in [("mse", "mse"), ("rmse", "rmse"), ("mae", "mae"), ("r2", "r2"), ("explained_variance", "var")]:
        want = RegressionEvaluator(metricName=theirs).evaluate(df)
        assert got[ours] == pytest.approx(want, rel=1e-9)


def test_hand_values(spark):
    rows = [(1.0, 1.0)] * 4 + [(0.0, 0.0)] * 3 + [(0.0, 1.0)] * 2 + [(1.0, 0.0)]
    counts = metrics.confusion_counts(spark.createDataFrame(rows, "label double, prediction double"))
    assert counts.first().asDict() == {"tp": 4, "tn": 3, "fp": 2, "fn": 1, "n": 10}
    assert metrics.confusion_fractions(counts).first().asDict() == {"tp": 0.4, "tn": 0.3, "fp": 0.2, "fn": 0.1}
    rates = metrics.binary_rates(counts).first()
    assert rates.tpr == pytest.approx(0.8) and rates.ppv == pytest.approx(4 / 6)
    assert rates.f1 == pytest.approx(8 / 11) and rates.accuracy == pytest.approx(0.7)
    assert rates.mcc == pytest.approx((12 - 2) / math.sqrt(6 * 5 * 5 * 4))


def test_undefined_values_are_null(spark):
    one_class = spark.createDataFrame([(1.0, 1.0, 0.3)] * 3, "label double, prediction double, score double")
    counts = metrics.confusion_counts(one_class)
    assert metrics.matthews_corrcoef(counts).first().mcc is None
    assert metrics.binary_rates(counts).first().tnr is None
    assert metrics.roc_auc(one_class).first()[0] is None
    assert metrics.pr_auc(one_class).first()[0] == pytest.approx(1.0)


def test_positive_class_is_chosen(spark):
    df = spark.createDataFrame([("yes", "yes"), ("no", "yes"), ("no", "no")], "label string, prediction string")
    assert metrics.confusion_counts(df, positive="no").first().asDict() == {"tp": 1, "tn": 1, "fp": 0, "fn": 1, "n": 3}


def test_multiclass_matches_evaluator(spark):
    rng = random.Random(7)
    rows = [(float(rng.randint(0, 3)), float(rng.randint(0, 4))) for _ in range(400)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    found = metrics.multiclass_metrics(metrics.multiclass_confusion(df)).collect()
    got = {r["class"]: r for r in found if not r.is_total}
    (total,) = [r for r in found if r.is_total]
    assert got["4.0"].recall is None
    ev = MulticlassClassificationEvaluator()
    assert total.accuracy == pytest.approx(ev.evaluate(df, {ev.metricName: "accuracy"}))
    for c in range(4):
        for ours, theirs in [("precision", "precisionByLabel"), ("recall", "recallByLabel"), ("f1", "fMeasureByLabel")]:
            want = ev.evaluate(df, {ev.metricName: theirs, ev.metricLabel: float(c)})
            assert got[f"{float(c)}"][ours] == pytest.approx(want)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 6)), min_size=2, max_size=30))
def test_roc_equals_pair_counting(spark, pairs):
    pos = [s for hit, s in pairs if hit]
    neg = [s for hit, s in pairs if not hit]
    df = spark.createDataFrame([(float(h), float(s)) for h, s in pairs], "label double, score double")
    got = metrics.roc_auc(df).first()[0]
    if not pos or not neg:
        assert got is None
    else:
        won = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
        assert got == pytest.approx(won / (len(pos) * len(neg)))

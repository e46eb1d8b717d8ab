"""Whole modelling jobs: sample, prepare, search the grid, judge the best model held out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablewright.functions.scalars import rounded
from tablewright.operators import estimators, features, ledger, sampling, tuning
from tablewright.plans import views
from tablewright.plans.registry import query
from tablewright.plans.sampling_queries import CLASS_FRACTIONS, STRATUM_SEED
from tablewright.workspace import materialize

EVALUATORS = {
    "binary": BinaryClassificationEvaluator,
    "multiclass": MulticlassClassificationEvaluator,
    "regression": RegressionEvaluator,
}

ACCOUNT_FEATURES = ["acctbal", "n_orders", "total_price", "n_urgent"]


def tuned_report(
    rows: DataFrame,
    keys: list[str],
    name: str,
    kind: str,
    axes: dict[str, Sequence] | None = None,
    folds: int = tuning.FOLDS,
    train_weight: float = 0.6,
    seed: int = 12345,
    ledger_root: str | None = None,
) -> DataFrame:
    """(split, n_rows, metric, value) of the best grid point, on rows the search never saw.

    Without ``axes`` the estimator's full grid is searched, points that give one and the same
    fit once.  With ``ledger_root``, a lasting folder, a search that broke off is gone on with.
    """
    train, test = sampling.train_test(rows, keys, train_weight, seed)
    axes = tuning.telling_axes(name) if axes is None else axes
    search = (train, keys, estimators.make(name), EVALUATORS[kind](), axes)
    if ledger_root is None:
        model = tuning.cross_validate(*search, folds, seed)
    else:
        model = ledger.cross_validate_resumable(*search, ledger_root, folds, seed)
    return estimators.score_report(model, test.withColumn("split", F.lit("test")), kind)


def account_numbers(accounts: DataFrame, names: list[str], positive: Column) -> DataFrame:
    """Key, plan, label and these numbers, written once: the indexer, the search and the scores start from them."""
    rows = accounts.select("cust_id", "plan", *names, positive.cast("double").alias("label"))
    return materialize(rows, "account-numbers")


def churn_rows(spark: SparkSession, d: str, positive_class: str = "True") -> DataFrame:
    """Customers down-sampled by class, plan indexed, account columns assembled.

    ``positive_class`` fixes which class is 1; it does not follow from class sizes.
    """
    accounts = views.customer_account(spark, d)
    kept = sampling.stratified_sample(accounts, "churn", CLASS_FRACTIONS, ["cust_id"], STRATUM_SEED)
    labelled = account_numbers(kept, ACCOUNT_FEATURES, F.col("churn") == positive_class)
    prepared = features.fit_feature_pipeline(labelled, ACCOUNT_FEATURES, ["plan"]).transform(labelled)
    # As plain numbers: small bin counts of the grid could not hold a nominal column's values.
    plain = array_to_vector(vector_to_array("features"))
    return prepared.select("cust_id", "label", plain.alias("features"))


@query("churn_workflow")
def churn_workflow(spark: SparkSession, d: str) -> DataFrame:
    """Churn end to end: the full tree grid over ten folds, judged on rows the search never saw."""
    report = tuned_report(churn_rows(spark, d), ["cust_id"], "dtree_classify", "binary")
    return report.withColumn("value", rounded("value"))


@query("tuned_logistic")
def tuned_logistic(spark: SparkSession, d: str) -> DataFrame:
    return tuned_report(churn_rows(spark, d), ["cust_id"], "logistic_classify", "binary")


@query("tuned_naive_bayes")
def tuned_naive_bayes(spark: SparkSession, d: str) -> DataFrame:
    """Multinomial weights need counts: the account's order counts and the plan's index."""
    accounts = account_numbers(views.customer_account(spark, d), ["n_orders", "n_urgent"], F.col("churn") == "True")
    rows = features.fit_feature_pipeline(accounts, ["n_orders", "n_urgent"], ["plan"]).transform(accounts)
    return tuned_report(rows.select("cust_id", "label", "features"), ["cust_id"], "naive_bayes_classify", "binary")


LINE_KEYS = ["l_orderkey", "l_linenumber"]


def price_rows(spark: SparkSession, d: str) -> DataFrame:
    lines = views.priced_lines(spark, d)
    names = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size"]
    return features.assemble(lines, names).select(*LINE_KEYS, "label", "features")


@query("price_workflow")
def price_workflow(spark: SparkSession, d: str) -> DataFrame:
    """Price regression end to end with the full grid."""
    return tuned_report(price_rows(spark, d), LINE_KEYS, "linear_regress", "regression")


@query("tuned_dtree_regress")
def tuned_dtree_regress(spark: SparkSession, d: str) -> DataFrame:
    return tuned_report(price_rows(spark, d), LINE_KEYS, "dtree_regress", "regression")

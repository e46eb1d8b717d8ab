"""Queries over splits, samples and folds, all keyed by customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.operators import sampling
from tablewright.plans import views
from tablewright.plans.oracle_views import over, unit
from tablewright.plans.registry import query

# The seeds, weights and class fractions of the sampled workflows.
SPLIT_SEED, SAMPLE_SEED, STRATUM_SEED = 12345, 23579, 123456
SPLIT_WEIGHTS = [("train", 0.6), ("test", 0.4)]
SAMPLE_FRACTION = 0.25
CLASS_FRACTIONS = {"False": 0.5, "True": 1.0}
FOLDS = 10

_SPLIT = f"CASE WHEN {unit('cust_id', SPLIT_SEED, 'split')} < 0.6 THEN 'train' ELSE 'test' END"


def split_accounts(spark: SparkSession, d: str) -> DataFrame:
    accounts = views.customer_account(spark, d)
    return sampling.hash_split(accounts, ["cust_id"], SPLIT_WEIGHTS, SPLIT_SEED)


@query("hash_split", over("customer_account", f"SELECT cust_id, {_SPLIT} AS split FROM customer_account"))
def hash_split(spark: SparkSession, d: str) -> DataFrame:
    return split_accounts(spark, d).select("cust_id", "split")


@query(
    "split_sizes",
    over("customer_account", f"SELECT {_SPLIT} AS split, count(*) AS n FROM customer_account GROUP BY 1"),
)
def split_sizes(spark: SparkSession, d: str) -> DataFrame:
    return sampling.split_sizes(split_accounts(spark, d))


@query(
    "hash_sample",
    over(
        "customer_account",
        f"SELECT cust_id, churn FROM customer_account WHERE {unit('cust_id', SAMPLE_SEED, 'sample')} < {SAMPLE_FRACTION}",
    ),
)
def hash_sample(spark: SparkSession, d: str) -> DataFrame:
    accounts = views.customer_account(spark, d).select("cust_id", "churn")
    return sampling.hash_sample(accounts, ["cust_id"], SAMPLE_FRACTION, SAMPLE_SEED)


@query(
    "stratified_sample",
    over(
        "customer_account",
        f"""SELECT cust_id, churn FROM customer_account
            WHERE {unit('cust_id', STRATUM_SEED, 'stratum')} < CASE churn WHEN 'True' THEN 1.0 ELSE 0.5 END""",
    ),
)
def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    accounts = views.customer_account(spark, d).select("cust_id", "churn")
    return sampling.stratified_sample(accounts, "churn", CLASS_FRACTIONS, ["cust_id"], STRATUM_SEED)


@query(
    "kfold_assign",
    over(
        "customer_account",
        f"""SELECT CAST(floor({unit('cust_id', SPLIT_SEED, 'fold')} * {FOLDS}) AS INT) AS fold, count(*) AS n
            FROM customer_account GROUP BY 1""",
    ),
)
def kfold_assign(spark: SparkSession, d: str) -> DataFrame:
    folded = sampling.assign_folds(views.customer_account(spark, d), ["cust_id"], FOLDS, SPLIT_SEED)
    return folded.groupBy("fold").agg(F.count("*").alias("n"))


@query("random_split_counts")
def random_split_counts(spark: SparkSession, d: str) -> DataFrame:
    parts = sampling.random_split(views.customer_account(spark, d).select("cust_id"), [0.8, 0.2], SPLIT_SEED)
    named = [p.select(F.lit(n).alias("split")) for n, p in zip(("train", "test"), parts)]
    return sampling.split_sizes(named[0].unionByName(named[1]))


@query("bernoulli_sample")
def bernoulli_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.bernoulli_sample(
        views.customer_account(spark, d).select("cust_id", "churn"), SAMPLE_FRACTION, SAMPLE_SEED
    )


@query("sample_by")
def sample_by(spark: SparkSession, d: str) -> DataFrame:
    accounts = views.customer_account(spark, d).select("cust_id", "churn")
    kept = sampling.sample_by(accounts, "churn", CLASS_FRACTIONS, STRATUM_SEED)
    return kept.groupBy("churn").agg(F.count("*").alias("n"))

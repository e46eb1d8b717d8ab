"""Splits, samples and folds that depend only on a row's key and a seed.

A hash of the key decides, so the same row lands on the same side whatever the
partitioning, the cluster size or the number of retries, and nothing is shuffled.
Spark's own generators are offered next to them; those depend on partition order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions.scalars import unit_hash


def hash_split(
    df: DataFrame,
    keys: list[str],
    weights: Sequence[tuple[str, float]],
    seed: int,
    name: str = "split",
) -> DataFrame:
    """Add the name of the part each row falls in; weights are taken relative to their sum."""
    total = sum(w for _, w in weights)
    u = unit_hash(keys, seed, "split")
    part: Column = F.lit(weights[-1][0])
    upper = total - weights[-1][1]
    for label, weight in reversed(weights[:-1]):
        part = F.when(u < F.lit(upper / total), label).otherwise(part)
        upper -= weight
    return df.withColumn(name, part)


def train_test(
    df: DataFrame, keys: list[str], train_weight: float, seed: int
) -> tuple[DataFrame, DataFrame]:
    u = unit_hash(keys, seed, "split")
    return df.filter(u < train_weight), df.filter(u >= train_weight)


def split_sizes(df: DataFrame, name: str = "split") -> DataFrame:
    return df.groupBy(name).agg(F.count("*").alias("n"))


def hash_sample(df: DataFrame, keys: list[str], fraction: float, seed: int) -> DataFrame:
    """Sample without replacement by key."""
    return df.filter(unit_hash(keys, seed, "sample") < fraction)


def stratified_sample(
    df: DataFrame, stratum: str, fractions: dict[str, float], keys: list[str], seed: int
) -> DataFrame:
    """Keep a fraction of each stratum; a stratum that is not named is left out."""
    wanted: Column = F.lit(0.0)
    for value, fraction in fractions.items():
        wanted = F.when(F.col(stratum) == value, F.lit(fraction)).otherwise(wanted)
    return df.filter(unit_hash(keys, seed, "stratum") < wanted)


def assign_folds(df: DataFrame, keys: list[str], k: int, seed: int, name: str = "fold") -> DataFrame:
    """Add a fold number 0 to k-1, usable as the fold column of cross-validation."""
    return df.withColumn(name, F.floor(unit_hash(keys, seed, "fold") * k).cast("int"))


def random_split(df: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    """Spark's random split; a seed is required."""
    return df.randomSplit(weights, seed)


def bernoulli_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_by(df: DataFrame, stratum: str, fractions: dict[str, float], seed: int) -> DataFrame:
    return df.stat.sampleBy(stratum, fractions, seed)

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tablewright.operators import sampling


@pytest.fixture(scope="module")
def keyed(spark):
    return spark.range(0, 4000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("c"))


def _unit(key: int, seed: int) -> float:
    return int(hashlib.md5(f"{seed}:split:{key}".encode()).hexdigest()[:8], 16) / 2**32


def test_split_is_the_same_on_any_partitioning(keyed):
    weights = [("train", 0.6), ("test", 0.4)]
    a = sampling.hash_split(keyed.repartition(1), ["id"], weights, 9)
    b = sampling.hash_split(keyed.repartition(13), ["id"], weights, 9)
    want = {i: "train" if _unit(i, 9) < 0.6 else "test" for i in range(4000)}
    assert {r.id: r.split for r in a.collect()} == {r.id: r.split for r in b.collect()} == want


def test_three_way_split_is_whole(keyed):
    out = sampling.hash_split(keyed, ["id"], [("a", 2), ("b", 1), ("c", 1)], 1)
    sizes = {r.split: r.n for r in sampling.split_sizes(out).collect()}
    assert sum(sizes.values()) == 4000
    assert sizes["a"] == pytest.approx(2000, rel=0.1) and sizes["b"] == pytest.approx(1000, rel=0.15)


def test_train_and_test_do_not_overlap(keyed):
    train, test = sampling.train_test(keyed, ["id"], 0.7, 3)
    assert train.count() + test.count() == 4000
    assert train.join(test, "id", "left_semi").count() == 0


def test_stratified_fractions(keyed):
    kept = sampling.stratified_sample(keyed, "c", {"hot": 0.25, "cold": 1.0}, ["id"], 2)
    n = {r.c: r["count"] for r in kept.groupBy("c").count().collect()}
    assert n["cold"] == 2666 and n["hot"] == pytest.approx(1334 * 0.25, rel=0.2)
    assert sampling.stratified_sample(keyed, "c", {"cold": 1.0}, ["id"], 2).where("c = 'hot'").count() == 0


def test_samples_and_folds(keyed):
    assert sampling.hash_sample(keyed, ["id"], 0.1, 4).count() == pytest.approx(400, rel=0.2)
    folds = sampling.assign_folds(keyed, ["id"], 10, 4).groupBy("fold").count().collect()
    assert sorted(r.fold for r in folds) == list(range(10))
    assert all(r["count"] == pytest.approx(400, rel=0.25) for r in folds)


def test_folds_are_independent_of_the_split(keyed):
    train, _ = sampling.train_test(keyed, ["id"], 0.6, 4)
    folds = sampling.assign_folds(train, ["id"], 10, 4).groupBy("fold").count().collect()
    assert len(folds) == 10 and all(r["count"] == pytest.approx(240, rel=0.3) for r in folds)


def test_spark_generators_take_a_seed(keyed):
    a, b = sampling.random_split(keyed, [0.8, 0.2], 5)
    assert a.count() + b.count() == 4000
    one = sampling.bernoulli_sample(keyed, 0.3, 6)
    assert one.collect() == sampling.bernoulli_sample(keyed, 0.3, 6).collect()
    assert set(r.c for r in sampling.sample_by(keyed, "c", {"hot": 1.0}, 7).collect()) == {"hot"}

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tablewright.operators import clustering, features
from tablewright.sources.delimited import literal_rows

VECTORS = np.random.default_rng(17).normal(size=(5, 6)).tolist()


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(3)
    rows = [(rng.choice("aaabbbccd"), rng.choice(["x", "y", None])) for _ in range(500)]
    return spark.createDataFrame(rows, "p string, q string").cache()


def test_label_index_agrees_with_string_indexer(labelled, many_blocks):
    index = features.label_index(labelled, ["p", "q"]).collect()
    for c in ("p", "q"):
        want = StringIndexer(inputCol=c, outputCol="i", handleInvalid="skip").fit(labelled).labels
        got = [r.value for r in sorted((r for r in index if r["column"] == c), key=lambda r: r["index"])]
        assert got == list(want)


def test_ties_go_to_value_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "p string")
    got = {r.value: r["index"] for r in features.label_index(df, ["p"]).collect()}
    assert got == {"c": 0.0, "a": 1.0, "b": 2.0}


def test_unseen_values_are_null_or_skipped(spark, labelled):
    index = features.label_index(labelled, ["p"])
    new = spark.createDataFrame([("a",), ("zz",), (None,)], "p string")
    assert features.apply_label_index(new, index, "p", "i").where("i is null").count() == 2
    assert features.apply_label_index(new, index, "p", "i", skip_invalid=True).count() == 1


def test_wide_columns(labelled):
    assert [tuple(r) for r in features.wide_columns(labelled, limit=3).collect()] == [("p", 4)]
    assert features.narrow_columns(labelled, ["p", "q"], 3) == ["q"]


def test_feature_pipeline(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0)], "p string, x double")
    out = features.fit_feature_pipeline(df, ["x"], ["p"]).transform(df)
    assert [list(r.features) for r in out.orderBy("x").collect()] == [[1, 0], [2, 1], [3, 0]]


def test_shared_indices_of_several_columns(spark):
    df = spark.range(50).selectExpr("cast(id % 7 as string) AS p", "cast(id % 3 as string) AS q")
    index = features.label_index(df, ["p", "q"])
    own = features.apply_label_indices(df, index, ["p", "q"])
    assert own.columns[-2:] == ["idx_p", "idx_q"] and own.where("idx_p is null or idx_q is null").count() == 0
    spark_own = features.indexers(["p", "q"]).fit(df).transform(df)
    assert sorted(own.select("p", "q", "idx_p", "idx_q").collect()) == sorted(spark_own.collect())


def test_ragged_and_null_arrays_fail(spark):
    for rows in ([[0.0], [1.0, 2.0, 3.0]], [[1.0, 2.0], [1.0, None]]):
        df = spark.createDataFrame([(r,) for r in rows], "v array<double>").coalesce(1)
        with pytest.raises(Exception, match="every array must have 2 numbers"):
            clustering.assign_nearest(df, "v", np.zeros((1, 2))).collect()


def test_assemble_and_take_apart(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "id int, a double, b double")
    out = features.vector_elements(features.assemble(df, ["b", "a"]).select("id", "features"), "features", ["f0", "f1"])
    assert out.first().asDict() == {"id": 1, "f0": 3.0, "f1": 2.0}


def test_covariance_matches_numpy(spark):
    data = np.random.default_rng(1).normal(size=(300, 7)) + 1e4
    df = spark.createDataFrame([(r.tolist(),) for r in data], "v array<double>").repartition(5)
    got = np.zeros((7, 7))
    for r in features.covariance(df, "v").collect():
        got[r.i, r.j] = r.cov
    assert np.allclose(got, np.cov(data.T), rtol=1e-9, atol=1e-9)


def test_principal_components_up_to_sign(spark):
    df = literal_rows(spark, [(v,) for v in VECTORS], "v array<double>")
    rows = features.vector_from_array(df, "v")
    out = features.fit_pca(rows, 4).transform(rows).select(vector_to_array("pcs").alias("p"), "v").collect()
    data = np.array(VECTORS)
    _, _, vt = np.linalg.svd(data - data.mean(axis=0))
    for r in out:
        want = np.array(r.v) @ vt[:4].T
        assert np.allclose(np.abs(r.p), np.abs(want), atol=1e-8)
        assert len(r.p) == 4


def test_vectors_round_trip(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "v array<double>")
    back = df.select(vector_to_array(array_to_vector("v")).alias("w")).first()
    assert back.w == [1.0, 2.0]
    assert df.select(F.size("v")).first()[0] == 2

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tablewright.operators import clustering, features, metrics
from tablewright.workspace import kept


@pytest.fixture(scope="module")
def blobs(spark):
    """Three far-apart groups of points."""
    rng = np.random.default_rng(4)
    centres = [(0, 0), (50, 0), (0, 50)]
    rows = [(i, i % 3, (rng.normal(size=2) + centres[i % 3]).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, blob int, v array<double>")
    return features.vector_from_array(df, "v").repartition(4).cache()


def test_blobs_are_recovered(blobs):
    found = clustering.assign_clusters(blobs, 3)
    assert found.select("blob", "prediction").distinct().count() == 3


def test_sweep(blobs):
    rows = clustering.sweep_clusters(blobs, range(2, 6)).orderBy("k").collect()
    assert [r.k for r in rows] == [2, 3, 4, 5]
    assert max(rows, key=lambda r: r.silhouette).k == 3
    assert rows[0].cost > rows[1].cost * 5


def test_pca_kmeans(blobs):
    found = clustering.pca_kmeans(blobs, 2, 3)
    assert found.select("blob", "prediction").distinct().count() == 3


def _brute(df, centres):
    rows = df.select("id", "v").collect()
    data = np.array([r.v for r in rows])
    d = ((data[:, None, :] - centres[None]) ** 2).sum(axis=2)
    return {r.id: int(c) for r, c in zip(rows, d.argmin(axis=1))}, data, d


def test_single_step_matches_numpy(blobs):
    centres = clustering.lowest_id_centres(blobs, "id", "v", 5)
    own, data, d = _brute(blobs, centres)
    got = {r.id: r.cluster for r in clustering.assign_nearest(blobs.select("id", "v"), "v", centres).collect()}
    assert got == own
    step = {r.cluster: r for r in clustering.lloyd_step(blobs, "v", centres).collect()}
    assert sum(r.n for r in step.values()) == 300
    for c, r in step.items():
        assert np.allclose(r.centre, data[d.argmin(axis=1) == c].mean(axis=0))
    cost = clustering.within_cluster_cost(blobs, "v", centres).first().wcss
    assert cost == pytest.approx(d.min(axis=1).sum())


def test_equal_distance_goes_to_the_lowest_centre(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0])], "id int, v array<double>")
    centres = np.array([[1.0, 0.0], [-1.0, 0.0]])
    assert clustering.assign_nearest(df, "v", centres).first().cluster == 0


def test_silhouette_matches_pair_distances(spark):
    rng = np.random.default_rng(9)
    data, label = rng.normal(size=(40, 3)), np.arange(40) % 3
    df = spark.createDataFrame([(v.tolist(), float(c)) for v, c in zip(data, label)], "v array<double>, prediction double")
    d = ((data[:, None] - data[None]) ** 2).sum(axis=2)
    scores = []
    for i in range(40):
        own = d[i, label == label[i]].sum() / ((label == label[i]).sum() - 1)
        other = min(d[i, label == c].mean() for c in range(3) if c != label[i])
        scores.append((other - own) / max(own, other))
    got = metrics.silhouette(features.vector_from_array(df, "v"))
    assert got == pytest.approx(np.mean(scores), abs=1e-12)


def test_fixed_seed_gives_the_same_clusters(blobs):
    a = clustering.assign_clusters(blobs, 3).agg(F.sum(F.col("id") * F.col("prediction"))).first()[0]
    b = clustering.assign_clusters(blobs, 3).agg(F.sum(F.col("id") * F.col("prediction"))).first()[0]
    assert a == b


def test_small_tables_are_not_spread_over_the_session_s_partitions(spark, blobs):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "64")
    try:
        with kept(blobs, spread_by=["id"]) as rows:
            assert rows.rdd.getNumPartitions() == 1
        with kept(blobs, spread_by=["id"], n_rows=250_000) as rows:
            assert rows.rdd.getNumPartitions() == 10 and rows.count() == 300
    finally:
        spark.conf.set(key, before)


def test_a_fit_goes_on_until_its_centres_rest(spark):
    """These rows ask for more than the 300 steps that such fits once ended after."""
    rows = spark.range(0, 20000, 1, 1).select(F.exp(F.col("id") / 5000).alias("x"))
    vectors = rows.select(array_to_vector(F.array("x")).alias("features")).cache()
    model = clustering.settled_kmeans(vectors, 20)
    assert model.summary.numIter > 300
    x = np.array([r.x for r in rows.collect()])
    centres = np.array(model.clusterCenters())[:, 0]
    own = np.abs(x[:, None] - centres).argmin(axis=1)
    assert np.abs([x[own == i].mean() - c for i, c in enumerate(centres)]).max() <= 1e-9

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tablewright.operators import optimality, recommend, tree_tables
from tests.harness import compare
from tablewright.plans.catalog import ORACLES, QUERIES


def _points(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = np.c_[rng.normal(size=(n, 3)), rng.integers(0, 5, n)]
    y = ((x[:, 0] + 0.5 * x[:, 1] > 0) ^ (x[:, 3] == 2)).astype(float)
    return spark.createDataFrame([(i, float(v), Vectors.dense(r)) for i, (v, r) in enumerate(zip(y, x))], ["id", "label", "features"])


WALK = """
WITH RECURSIVE w AS (
    SELECT r.id, t.tree, 0 AS node FROM rows r, (SELECT DISTINCT tree FROM nodes) t
    UNION ALL
    SELECT w.id, w.tree,
           CASE WHEN coalesce(r.x[n.feature + 1] <= n.threshold, list_contains(n.categories, r.x[n.feature + 1])) THEN n."left" ELSE n."right" END
    FROM w JOIN nodes n ON n.tree = w.tree AND n.node = w.node JOIN rows r ON r.id = w.id WHERE n."left" IS NOT NULL
)
SELECT w.id, w.tree, n.node AS leaf, n.value, n.weight FROM w JOIN nodes n ON n.tree = w.tree AND n.node = w.node WHERE n."left" IS NULL
"""


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_walks_in_spark_and_sql_agree_with_the_model(spark, kind):
    rows = _points(spark)
    forest = RandomForestClassifier(numTrees=4, maxDepth=4, seed=3)
    estimator = forest if kind == "forest" else GBTClassifier(maxIter=3, maxDepth=3, seed=3)
    indexed = VectorIndexer(inputCol="features", outputCol="f", maxCategories=5).fit(rows).transform(rows)
    indexed = indexed.select("id", "label", F.col("f").alias("features"))
    model = estimator.fit(indexed)
    nodes = tree_tables.stored_nodes(model)
    assert nodes.where("categories IS NOT NULL").count() > 0
    scored = model.transform(indexed).withColumn("features", vector_to_array("features"))
    walked = tree_tables.walk(scored.select("id", "features", "prediction"), nodes)
    duck = duckdb.connect()
    duck.register("nodes", nodes.toArrow())
    duck.register("rows", scored.select("id", F.col("features").alias("x")).toArrow())
    got = sorted(tuple(r) for r in walked.select("id", "tree", "leaf", "value", "weight").collect())
    assert got == sorted(duck.execute(WALK).fetchall()) and len(got) == 400 * nodes.select("tree").distinct().count()
    if kind == "boosted":  # the sum of the trees decides
        margin = walked.groupBy("id", "prediction").agg(F.sum(F.col("weight") * F.col("value")).alias("m"))
        assert margin.where((F.col("m") > 0) != (F.col("prediction") == 1)).count() == 0


@pytest.mark.parametrize("name", ["tree_walk", "tree_walk_regress", "logistic_optimality", "kmeans_fixed_point", "als_equations"])
def test_queries_match_sql(spark, small, duck, name):
    assert compare(QUERIES[name](spark, small), duck, ORACLES[name]) is None


def _columns(spark, n=600):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(n, 3)) * [1.0, 5.0, 0.3] + [0, 2, 1]
    y = (x @ [1.0, -0.3, 0.0] + rng.normal(size=n) > 0).astype(float)
    return spark.createDataFrame([(float(v), *map(float, r), 4.0) for v, r in zip(y, x)], "label double, a double, b double, c double, constant double")


NAMES = ["a", "b", "c", "constant"]


def _vectors(rows):
    from tablewright.operators.features import assemble

    return assemble(rows, NAMES).select("label", "features")


@pytest.mark.parametrize("reg,elastic", [(0.05, 1.0), (0.05, 0.4), (0.01, 0.0)])
def test_a_logistic_fit_is_optimal_and_a_shifted_one_is_not(spark, reg, elastic):
    rows = _columns(spark)
    model = LogisticRegression(regParam=reg, elasticNetParam=elastic, maxIter=500, tol=1e-12).fit(_vectors(rows))
    terms = optimality.linear_terms(spark, model, NAMES)
    got = optimality.logistic_residuals(rows, terms, NAMES, reg, elastic).collect()
    assert len(got) == 5 and max(r.residual for r in got) < 1e-5
    moved = terms.withColumn("coefficient", F.col("coefficient") + F.when(F.col("term") == "a", 0.2).otherwise(0.0))
    assert max(r.residual for r in optimality.logistic_residuals(rows, moved, NAMES, reg, elastic).collect()) > 1e-3


def test_a_support_vector_fit_is_nearly_optimal(spark):
    rows = _columns(spark)
    model = LinearSVC(regParam=0.1, maxIter=2000, tol=1e-12).fit(_vectors(rows))
    terms = optimality.linear_terms(spark, model, NAMES)
    good = optimality.hinge_residuals(rows, terms, NAMES, 0.1, kink=1e-3).collect()
    moved = terms.withColumn("coefficient", F.col("coefficient") + F.when(F.col("term") == "a", 0.3).otherwise(0.0))
    bad = optimality.hinge_residuals(rows, moved, NAMES, 0.1, kink=1e-3).collect()
    assert max(r.residual for r in good) < 0.02 < max(r.residual for r in bad)


def _ratings(spark, users=30, items=25, seed=4):
    rng = np.random.default_rng(seed)
    cells = [(int(u), int(i), float(rng.integers(1, 6))) for u in range(users) for i in range(items) if rng.random() < 0.4 or u == 0]
    return cells, spark.createDataFrame(cells, "user int, item int, rating double")


def test_user_equations_and_their_solution_match_numpy(spark):
    cells, ratings = _ratings(spark)
    rng = np.random.default_rng(5)
    y = rng.normal(size=(25, 6))
    factors = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(y)], "id int, features array<float>")
    y = np.float32(y).astype(float)
    want = {}
    for u in range(30):
        own = [(i, r) for w, i, r in cells if w == u]
        f = y[[i for i, _ in own]]
        want[u] = np.linalg.solve(f.T @ f + 0.1 * len(own) * np.eye(6), f.T @ [r for _, r in own])
    got = {r.id: r.features for r in recommend.fold_in_factors(ratings, factors, 0.1).collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[u], want[u], rtol=1e-8) for u in want)
    solved = spark.createDataFrame([(u, [float(v) for v in x]) for u, x in want.items()], "id int, features array<double>")
    equations = optimality.user_equations(ratings, factors, 0.1)
    assert equations.agg({"n": "sum"}).first()[0] == len(cells)
    assert max(r.residual for r in optimality.equation_residuals(equations, solved).collect()) < 1e-9
    best = recommend.best_items(solved, factors, 3).collect()
    for u in (0, 7):
        order = sorted(range(25), key=lambda i: (-(y[i] @ want[u]), i))[:3]
        assert [r.item for r in sorted((r for r in best if r.user == u), key=lambda r: r.rank)] == order


def test_a_folded_user_gets_what_the_fit_gave_a_twin(spark):
    cells, _ = _ratings(spark)
    pairs = spark.createDataFrame([(f"u{u}", f"i{i}", r) for u, i, r in cells], "user_id string, item_id string, rating double")
    fitted = recommend.fit_recommender(pairs, blocks=2, rank=5)
    twin = pairs.where("user_id = 'u3'").withColumn("user_id", F.lit("twin"))
    twin = twin.unionByName(spark.createDataFrame([("twin", "unknown", 5.0)], pairs.schema))
    folded = [(r.rank, r.item_id) for r in recommend.recommend_folded(fitted, twin, 5).orderBy("rank").collect()]
    own = [(r["rank"], r.item_id) for r in fitted.top_items(spark.createDataFrame([("u3",)], "user_id string"), 5).orderBy("rank").collect()]
    assert folded == own


def test_a_clustering_off_its_fixed_point_is_seen(spark):
    points = spark.createDataFrame([([0.0, 0.0], 0), ([0.0, 2.0], 0), ([5.0, 5.0], 1), ([0.0, 1.0], 1)], "x array<double>, cluster int")
    centres = spark.createDataFrame([(0, [0.0, 1.0]), (1, [2.5, 3.0])], "cluster int, centre array<double>")
    got = {r.cluster: (r.n, r.shift, r.n_nearer) for r in optimality.cluster_fixed_point(points, centres).collect()}
    assert got == {0: (2, 0.0, 0), 1: (2, 0.0, 1)}
    off = optimality.cluster_fixed_point(points, centres.withColumn("centre", F.array(F.lit(1.0), F.lit(1.0)))).collect()
    assert max(r.shift for r in off) == pytest.approx(2.0)


def test_residuals_without_the_equations_are_those_of_the_equations(spark):
    """And what is moved to add them up is one vector a user, never the cells of a matrix."""
    cells, ratings = _ratings(spark)
    rng = np.random.default_rng(8)
    items = spark.createDataFrame([(i, rng.normal(size=6).tolist()) for i in range(25)], "id int, features array<float>")
    users = spark.createDataFrame([(u, rng.normal(size=6).tolist()) for u in range(30)], "id int, features array<float>")
    want = {r.user: (r.n, r.residual) for r in optimality.equation_residuals(optimality.user_equations(ratings, items, 0.1), users).collect()}
    found = optimality.factor_residuals(ratings, items, users, 0.1)
    got = {r.user: (r.n, r.residual) for r in found.collect()}
    assert got.keys() == want.keys() and all(got[u] == (want[u][0], pytest.approx(want[u][1], rel=1e-9)) for u in want)
    plan = QUERIES["als_equations"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan

"""Queries over fitted models, tuning, clustering and recommendation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.functions.scalars import rounded
from tablewright.operators import clustering, estimators, features, ledger, recommend, sampling, splits, tuning
from tablewright.plans import views
from tablewright.plans.feature_queries import LINE_FEATURES
from tablewright.plans.oracle_views import over
from tablewright.plans.registry import query
from tablewright.sources import models
from tablewright.workspace import kept, lasting_path, materialize, scratch_path

DOC_FEATURES = ["n_chars", "n_spaces", "n_periods", "e_ratio"]
SEED = 12345
TRAIN_WEIGHT = 0.6
HIDDEN_UNITS = 16


# --- prepared tables ---------------------------------------------------------


def doc_rows(spark: SparkSession, d: str) -> DataFrame:
    """Document quality with its four text features."""
    rows = views.doc_features(spark, d).withColumn("label", F.col("quality").cast("double"))
    return features.assemble(rows, DOC_FEATURES).select("doc_id", "label", "features")


def line_rows(spark: SparkSession, d: str, names: Sequence[str] = tuple(LINE_FEATURES)) -> DataFrame:
    lines = views.priced_lines(spark, d)
    return features.assemble(lines, names).select("l_orderkey", "l_linenumber", "label", "features")


def vector_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = views.expression(spark, d).withColumn("label", F.col("label").cast("double"))
    return features.vector_from_array(rows, "embedding").select("vec_id", "label", "features")


def score_documents(spark: SparkSession, d: str, name: str, **params) -> DataFrame:
    estimator = estimators.make(name, **params)
    return estimators.fit_and_score(estimator, doc_rows(spark, d), ["doc_id"], "binary", TRAIN_WEIGHT, SEED)


def score_lines(spark: SparkSession, d: str, name: str, **params) -> DataFrame:
    """The layout follows the number of lines, which the files state: no join is made to count them.

    Lines of an order can share a number, so lines with one key lie in the order of their numbers.
    """
    keys = ["l_orderkey", "l_linenumber"]
    estimator = estimators.make(name, **params)
    n_lines = views.table(spark, d, "lineitem").count()
    lines = views.priced_lines(spark, d)
    return estimators.fit_and_score(
        estimator, lines, keys, "regression", TRAIN_WEIGHT, SEED, inputs=LINE_FEATURES, n_rows=n_lines
    )


# --- models with a closed form -----------------------------------------------

_OLS = over(
    "priced_lines",
    """, v AS (SELECT var_pop(l_quantity) AS v1, var_pop(l_discount) AS v2,
                      covar_pop(l_quantity, l_discount) AS c12, covar_pop(l_quantity, label) AS c1y,
                      covar_pop(l_discount, label) AS c2y, avg(l_quantity) AS m1,
                      avg(l_discount) AS m2, avg(label) AS my FROM priced_lines),
         b AS (SELECT (c1y * v2 - c2y * c12) / (v1 * v2 - c12 * c12) AS b1,
                      (c2y * v1 - c1y * c12) / (v1 * v2 - c12 * c12) AS b2, m1, m2, my FROM v)
       SELECT 'intercept' AS term, round(my - b1 * m1 - b2 * m2, 4) + 0.0 AS estimate FROM b
       UNION ALL SELECT 'l_quantity', round(b1, 4) + 0.0 FROM b
       UNION ALL SELECT 'l_discount', round(b2, 4) + 0.0 FROM b""",
)


def _linear_terms(spark: SparkSession, d: str, name: str) -> DataFrame:
    names = ["l_quantity", "l_discount"]
    with kept(line_rows(spark, d, names).select("label", "features")) as rows:
        model = estimators.make(name).fit(rows)
    terms = estimators.coefficient_rows(spark, model, names)
    return terms.select("term", rounded("estimate", 4).alias("estimate"))


@query("linear_regression_coefficients", _OLS)
def linear_regression_coefficients(spark: SparkSession, d: str) -> DataFrame:
    return _linear_terms(spark, d, "linear_regress")


@query("glm_gaussian_coefficients", _OLS)
def glm_gaussian_coefficients(spark: SparkSession, d: str) -> DataFrame:
    return _linear_terms(spark, d, "glm_regress")


NB_FEATURES = ["n_spaces", "n_periods"]

_NB = """, s AS (SELECT lang AS class, CAST(count(*) AS DOUBLE) AS n, sum(n_spaces) AS x0,
                        sum(n_periods) AS x1 FROM doc_features GROUP BY lang),
           t AS (SELECT sum(n) AS total, count(*) AS k FROM s),
           p AS (SELECT class, ln(n + 1) - ln(total + k) AS pi,
                        ln(x0 + 1) - ln(x0 + x1 + 2) AS t0, ln(x1 + 1) - ln(x0 + x1 + 2) AS t1
                 FROM s CROSS JOIN t)"""


def fit_naive_bayes(spark: SparkSession, d: str):
    """(model, class names, rows) of the language model over two character counts."""
    # Written once: the indexer, the fit and the scores all pass over these numbers.
    docs = materialize(views.doc_features(spark, d).select("lang", *NB_FEATURES), "language-counts")
    index = features.indexers(["lang"]).fit(docs)
    indexed = index.transform(docs).withColumnRenamed("idx_lang", "label")
    rows = features.assemble(indexed, NB_FEATURES).select("lang", "label", "features")
    return estimators.make("naive_bayes_classify").fit(rows), index.labelsArray[0], rows


@query(
    "naive_bayes_parameters",
    over(
        "doc_features",
        _NB
        + """ SELECT class, 'pi' AS term, round(pi, 6) + 0.0 AS value FROM p
              UNION ALL SELECT class, 'n_spaces', round(t0, 6) + 0.0 FROM p
              UNION ALL SELECT class, 'n_periods', round(t1, 6) + 0.0 FROM p""",
    ),
)
def naive_bayes_parameters(spark: SparkSession, d: str) -> DataFrame:
    model, classes, _ = fit_naive_bayes(spark, d)
    rows = estimators.naive_bayes_rows(spark, model, classes, NB_FEATURES)
    return rows.select("class", "term", rounded("value").alias("value"))


@query(
    "naive_bayes_classify",
    over(
        "doc_features",
        _NB
        + """ , r AS (SELECT doc_id, lang, p.class AS predicted FROM doc_features CROSS JOIN p
                      QUALIFY row_number() OVER (PARTITION BY doc_id
                              ORDER BY pi + n_spaces * t0 + n_periods * t1 DESC) = 1)
              SELECT lang AS class, predicted, count(*) AS n FROM r GROUP BY lang, predicted""",
    ),
)
def naive_bayes_classify(spark: SparkSession, d: str) -> DataFrame:
    model, classes, rows = fit_naive_bayes(spark, d)
    names = F.array(*[F.lit(c) for c in classes])
    scored = model.transform(rows).select(
        F.col("lang").alias("class"), F.get(names, F.col("prediction").cast("int")).alias("predicted")
    )
    return scored.groupBy("class", "predicted").agg(F.count("*").alias("n"))


def _split_sql(view: str, features_: list[str], y: str, gain: str, digits: int) -> str:
    cells = " UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS v, {y} AS y FROM {view}" for f in features_)
    return over(
        view,
        f""", x AS ({cells}),
             g AS (SELECT feature, v, CAST(count(*) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS s
                   FROM x GROUP BY feature, v),
             c AS (SELECT feature, (v + lead(v) OVER w) / 2 AS threshold, sum(n) OVER w AS nl,
                          sum(s) OVER w AS sl, sum(n) OVER (PARTITION BY feature) AS n,
                          sum(s) OVER (PARTITION BY feature) AS s
                   FROM g WINDOW w AS (PARTITION BY feature ORDER BY v)),
             k AS (SELECT feature, threshold, n, nl, n - nl AS nr, s, sl, s - sl AS sr FROM c
                   WHERE threshold IS NOT NULL),
             r AS (SELECT feature, threshold, round({gain}, {digits}) + 0.0 AS gain FROM k)
           SELECT feature, threshold, gain FROM r
           QUALIFY row_number() OVER (PARTITION BY feature ORDER BY gain DESC, threshold) = 1""",
    )


_GINI = (
    "2 * (s / n) * (1 - s / n) - (nl / n) * (2 * (sl / nl) * (1 - sl / nl))"
    " - (nr / n) * (2 * (sr / nr) * (1 - sr / nr))"
)


@query("gini_best_split", _split_sql("doc_features", ["n_periods", "n_spaces"], "quality", _GINI, 9))
def gini_best_split(spark: SparkSession, d: str) -> DataFrame:
    return splits.gini_best_split(views.doc_features(spark, d), ["n_periods", "n_spaces"], "quality")


@query(
    "variance_best_split",
    _split_sql(
        "priced_lines",
        ["l_quantity", "l_discount", "p_size"],
        "label",
        "(sl * sl / nl + sr * sr / nr - s * s / n) / n",
        2,
    ),
)
def variance_best_split(spark: SparkSession, d: str) -> DataFrame:
    best = splits.variance_best_split(views.priced_lines(spark, d), ["l_quantity", "l_discount", "p_size"])
    return best.select("feature", "threshold", rounded("gain", 2).alias("gain"))


# --- estimators scored on both parts of a keyed split ------------------------


@query("dtree_classify")
def dtree_classify(spark: SparkSession, d: str) -> DataFrame:
    return score_documents(spark, d, "dtree_classify")


@query("logistic_classify")
def logistic_classify(spark: SparkSession, d: str) -> DataFrame:
    return score_documents(spark, d, "logistic_classify")


@query("linear_svm_classify")
def linear_svm_classify(spark: SparkSession, d: str) -> DataFrame:
    return score_documents(spark, d, "linear_svm_classify")


@query("gbt_classify")
def gbt_classify(spark: SparkSession, d: str) -> DataFrame:
    return score_documents(spark, d, "gbt_classify")


@query("rf_classify")
def rf_classify(spark: SparkSession, d: str) -> DataFrame:
    return score_documents(spark, d, "rf_classify")


@query("dtree_regress")
def dtree_regress(spark: SparkSession, d: str) -> DataFrame:
    return score_lines(spark, d, "dtree_regress")


@query("gbt_regress")
def gbt_regress(spark: SparkSession, d: str) -> DataFrame:
    return score_lines(spark, d, "gbt_regress")


@query("rf_regress")
def rf_regress(spark: SparkSession, d: str) -> DataFrame:
    return score_lines(spark, d, "rf_regress")


@query("mlp_classify")
def mlp_classify(spark: SparkSession, d: str) -> DataFrame:
    """A small network over the wide rows; its outer layers follow from the data."""
    rows = vector_rows(spark, d)
    shape = views.expression(spark, d).agg(
        F.max(F.size("embedding")).alias("inputs"), F.max("label").alias("top")
    ).first()
    layers = [shape.inputs, HIDDEN_UNITS, shape.top + 1]
    network = estimators.make("mlp_classify", layers=layers)
    return estimators.fit_and_score(network, rows, ["vec_id"], "multiclass", 0.7, SEED)


@query(
    "mlp_param_counts",
    over(
        "expression",
        f""", s AS (SELECT max(len(embedding)) AS i, max(label) + 1 AS o FROM expression)
           SELECT '0' AS layer, CAST((i + 1) * {HIDDEN_UNITS} AS BIGINT) AS n_params FROM s
           UNION ALL SELECT '1', CAST({HIDDEN_UNITS + 1} * o AS BIGINT) FROM s
           UNION ALL SELECT 'total', CAST((i + 1) * {HIDDEN_UNITS} + {HIDDEN_UNITS + 1} * o AS BIGINT) FROM s""",
    ),
)
def mlp_param_counts(spark: SparkSession, d: str) -> DataFrame:
    """Weights and biases per layer of the network that fits the table's shape."""
    shape = views.expression(spark, d).agg(
        F.max(F.size("embedding")).alias("inputs"), (F.max("label") + 1).alias("classes")
    )
    layers = [F.col("inputs"), F.lit(HIDDEN_UNITS), F.col("classes")]
    counts = estimators.layer_parameter_counts(layers)
    total = sum((n for _, n in counts[1:]), counts[0][1])
    cells = [
        F.struct(F.lit(name).alias("layer"), n.cast("bigint").alias("n_params"))
        for name, n in [*[(str(i), n) for i, n in counts], ("total", total)]
    ]
    return shape.select(F.inline(F.array(*cells)))


@query("pipeline_predict")
def pipeline_predict(spark: SparkSession, d: str) -> DataFrame:
    """Index the language, assemble, classify: one pipeline, applied to the held-out part."""
    docs = views.doc_features(spark, d).select("doc_id", "lang", *DOC_FEATURES, F.col("quality").cast("double").alias("label"))
    # The numbers are written once: the text is not read again for the indexer, the fit and the scores.
    docs = materialize(docs, "doc-features")
    train, test = sampling.train_test(docs, ["doc_id"], TRAIN_WEIGHT, SEED)
    stages = [
        features.indexers(["lang"], invalid="keep"),
        VectorAssembler(inputCols=[*DOC_FEATURES, "idx_lang"], outputCol="features"),
        estimators.make("logistic_classify"),
    ]
    scored = Pipeline(stages=stages).fit(train).transform(test)
    return scored.select("doc_id", "label", "prediction", vector_to_array("probability")[1].alias("probability"))


# --- tuning and inspection ---------------------------------------------------

# Thresholds of the two-rule document filter that is searched over.
RULE_GRID = {"min_periods": [5, 10, 20, 40], "max_ratio": [0.1, 0.15]}


@query(
    "param_grid",
    over(
        "doc_features",
        """SELECT min_periods, CAST(max_ratio AS DOUBLE) AS max_ratio,
                  CAST(sum(CASE WHEN (n_periods > min_periods AND e_ratio < CAST(max_ratio AS DOUBLE))
                                     = (quality = 1) THEN 1 ELSE 0 END) AS BIGINT) AS n_correct
           FROM doc_features CROSS JOIN (VALUES (5), (10), (20), (40)) AS a(min_periods)
             CROSS JOIN (VALUES (0.1), (0.15)) AS b(max_ratio)
           GROUP BY min_periods, max_ratio""",
    ),
)
def param_grid(spark: SparkSession, d: str) -> DataFrame:
    """Every grid point of a threshold rule with the number of documents it gets right."""

    def correct(point: dict):
        keep = (F.col("n_periods") > point["min_periods"]) & (F.col("e_ratio") < point["max_ratio"])
        return keep == (F.col("quality") == 1)

    return tuning.score_grid(views.doc_features(spark, d), tuning.grid_points(RULE_GRID), correct)


def search_trees(spark: SparkSession, d: str):
    """The whole tree grid over ten folds.  Fits that its ledger holds for these very rows, from an
    earlier or a broken-off search, are not made again."""
    return ledger.cross_validate_resumable(
        doc_rows(spark, d),
        ["doc_id"],
        estimators.make("dtree_classify"),
        BinaryClassificationEvaluator(),
        tuning.GRIDS["dtree_classify"],
        lasting_path(spark, "searches"),
    )


@query("cross_validate_grid")
def cross_validate_grid(spark: SparkSession, d: str) -> DataFrame:
    return tuning.grid_rows(spark, search_trees(spark, d), larger_is_better=True)


@query("best_params")
def best_params(spark: SparkSession, d: str) -> DataFrame:
    return tuning.best_param_rows(spark, search_trees(spark, d))


@query(
    "tuned_model_roundtrip",
    over("priced_lines", "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM priced_lines"),
)
def tuned_model_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose prediction changes after the model of a whole search is saved and loaded back."""
    rows = line_rows(spark, d, ["l_quantity", "l_discount"])
    keys = ["l_orderkey", "l_linenumber"]
    search = tuning.cross_validate(
        rows, keys, estimators.make("linear_regress"), RegressionEvaluator(), tuning.telling_axes("linear_regress")
    )
    again = models.reload_model(search, models.save_model(search, scratch_path(spark, "tuned-model")))
    reloaded = again.bestModel.setPredictionCol("reloaded")
    both = reloaded.transform(search.bestModel.transform(rows.select("features")))
    different = F.count_if(F.col("prediction") != F.col("reloaded"))
    return both.agg(F.count("*").alias("n_rows"), different.alias("n_different"))


def fit_tree(spark: SparkSession, d: str):
    with kept(doc_rows(spark, d).select("label", "features")) as rows:
        return estimators.make("dtree_classify", maxDepth=5).fit(rows)


@query("tree_rules")
def tree_rules(spark: SparkSession, d: str) -> DataFrame:
    return estimators.rule_rows(spark, fit_tree(spark, d))


@query("feature_importance")
def feature_importance(spark: SparkSession, d: str) -> DataFrame:
    return estimators.importance_rows(spark, fit_tree(spark, d), DOC_FEATURES)


# --- clustering --------------------------------------------------------------


@query("kmeans_assign")
def kmeans_assign(spark: SparkSession, d: str) -> DataFrame:
    rows = vector_rows(spark, d).select("vec_id", "features")
    return clustering.assign_clusters(rows, 10).select("vec_id", F.col("prediction").alias("cluster"))


@query("kmeans_elbow")
def kmeans_elbow(spark: SparkSession, d: str) -> DataFrame:
    sweep = clustering.sweep_clusters(vector_rows(spark, d), with_silhouette=False, spread_by=["vec_id"])
    return sweep.select("k", "cost")


@query("kmeans_silhouette_sweep")
def kmeans_silhouette_sweep(spark: SparkSession, d: str) -> DataFrame:
    return clustering.sweep_clusters(vector_rows(spark, d), spread_by=["vec_id"]).select("k", "cost", "silhouette")


@query("pca_kmeans")
def pca_kmeans(spark: SparkSession, d: str) -> DataFrame:
    rows = vector_rows(spark, d).select("vec_id", "features")
    clustered = clustering.pca_kmeans(rows, components=5, k=10)
    return clustered.select("vec_id", F.col("prediction").alias("cluster"))


# --- recommendation ----------------------------------------------------------


def rated_pairs(spark: SparkSession, d: str) -> DataFrame:
    """One row per (user, item), written once because several passes start from it."""
    return materialize(recommend.mean_ratings(views.ratings(spark, d)), "rated-pairs")


@query("als_fit_predict")
def als_fit_predict(spark: SparkSession, d: str) -> DataFrame:
    """Fit on a keyed share of the pairs, report the error on both shares."""
    keys = ["user_id", "item_id"]
    weights = [("train", TRAIN_WEIGHT), ("test", 1 - TRAIN_WEIGHT)]
    return recommend.split_rmse(sampling.hash_split(rated_pairs(spark, d), keys, weights, SEED))


@query("als_top_items")
def als_top_items(spark: SparkSession, d: str) -> DataFrame:
    """Ten items for the most active user."""
    pairs = rated_pairs(spark, d)
    counts = pairs.groupBy("user_id").agg(F.count("*").alias("n"))
    user = counts.orderBy(F.desc("n"), "user_id").limit(1).select("user_id")
    return recommend.fit_recommender(pairs).top_items(user, 10)


NEW_USER = "300000"


def favourites(pairs: DataFrame) -> DataFrame:
    """The highest rating from the new user for each of the ten most-rated items."""
    known = pairs.groupBy("item_id").agg(F.count("*").alias("n"))
    best = known.orderBy(F.desc("n"), "item_id").limit(10)
    # Written once: the ids, the fit and the recommendation all start from these ten rows.
    return materialize(best.select(F.lit(NEW_USER).alias("user_id"), "item_id", F.lit(10.0).alias("rating")), "favourites")


@query("als_new_user_rmse")
def als_new_user_rmse(spark: SparkSession, d: str) -> DataFrame:
    """The error on both shares of the pairs after the new user's ratings joined the training share."""
    weights = [("train", TRAIN_WEIGHT), ("test", 1 - TRAIN_WEIGHT)]
    pairs = rated_pairs(spark, d)
    split = sampling.hash_split(pairs, ["user_id", "item_id"], weights, SEED)
    new = favourites(pairs).withColumn("split", F.lit("train"))
    return recommend.split_rmse(split.unionByName(new))


@query("als_new_user")
def als_new_user(spark: SparkSession, d: str) -> DataFrame:
    """Ten items for a new user who gave the ten most-rated items the highest rating."""
    pairs = rated_pairs(spark, d)
    return recommend.fold_in_user(spark, pairs, favourites(pairs), 10)

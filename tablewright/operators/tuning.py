"""Parameter grids and cross-validated search with key-hashed folds."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator
from pyspark.ml.evaluation import Evaluator, RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablewright.operators import tree_tables
from tablewright.operators.sampling import assign_folds
from tablewright.workspace import PARTITION_ROWS, fits_at_once, kept

# The full grid searched for each estimator, and the number of folds.
FOLDS = 10
_LINEAR_GRID: dict[str, list] = {
    "maxIter": [10, 20, 30, 50, 100, 500, 1000],
    "regParam": [0.001, 0.01, 0.1],
    "tol": [0.01, 0.1],
}
GRIDS: dict[str, dict[str, list]] = {
    "linear_regress": _LINEAR_GRID,
    "glm_regress": _LINEAR_GRID,
    "logistic_classify": {
        "maxIter": [100],
        "regParam": [0.01],
        "tol": [1e-4],
        "elasticNetParam": [1.0],
    },
    "naive_bayes_classify": {"smoothing": [1e-2, 1e-4, 1e-6, 1e-8]},
    "linear_svm_classify": {"maxIter": [10000], "regParam": [0.10], "tol": [1e-4]},
    "dtree_classify": {
        "impurity": ["gini", "entropy"],
        "maxBins": [3, 5, 9, 10],
        "maxDepth": [5, 10, 15],
    },
    "gbt_classify": {"maxDepth": [3, 5, 10], "maxBins": [5, 10, 20]},
    "rf_classify": {
        "maxDepth": [3, 5, 10],
        "featureSubsetStrategy": ["auto", "all"],
        "impurity": ["gini", "entropy"],
        "maxBins": [5, 10, 20],
        "numTrees": [5, 10, 20],
    },
    "dtree_regress": {"impurity": ["variance"], "maxBins": [25, 30, 35], "maxDepth": [5, 10, 15]},
    "gbt_regress": {"impurity": ["variance"], "maxBins": [3, 5, 10], "maxDepth": [2, 5, 10]},
    "rf_regress": {
        "impurity": ["variance"],
        "maxBins": [25, 30, 35],
        "maxDepth": [5, 10, 15],
        "numTrees": [3, 5, 10, 15],
    },
}


# An exact solver takes no steps, so these axes of the full grid cannot change its fit.
_WITHOUT_EFFECT = {"linear_regress": ("maxIter", "tol")}


def telling_axes(name: str) -> dict[str, list]:
    """The full grid of an estimator with one value on each axis that its solver ignores."""
    ignored = _WITHOUT_EFFECT.get(name, ())
    return {axis: values[:1] if axis in ignored else values for axis, values in GRIDS[name].items()}


def grid_points(axes: dict[str, Sequence]) -> list[dict]:
    """Every combination of the values on each axis."""
    return [dict(zip(axes, values)) for values in product(*axes.values())]


def param_maps(estimator: Estimator, axes: dict[str, Sequence]) -> list[dict]:
    builder = ParamGridBuilder()
    for name, values in axes.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


def cross_validate(
    df: DataFrame,
    keys: list[str],
    estimator: Estimator,
    evaluator: Evaluator,
    axes: dict[str, Sequence],
    folds: int = FOLDS,
    seed: int = 12345,
    parallelism: int | None = None,
) -> CrossValidatorModel:
    """Search the grid over folds fixed by a hash of each row's key.

    Features are assembled before the search, so the folds share one stored table of label, vector
    and fold number, and a fit reads its folds from it by a plain condition.  Work that the points
    of a grid share is done once: the moments of linear fits, the upper levels of regression trees.
    """
    folded = assign_folds(df, keys, folds, seed).select(*keys, "label", "features", "fold")
    maps = param_maps(estimator, axes)
    moments = _from_moments(estimator, evaluator, axes)
    nested = not moments and isinstance(estimator, DecisionTreeRegressor) and "maxDepth" in axes
    # Moments do not follow the layout; histograms of deep trees are made and moved for each partition.
    layout = {} if moments else {"spread_by": keys, "partition_rows": DEEP_ROWS if nested else PARTITION_ROWS}
    with kept(folded, **layout) as stored:
        at_once = parallelism or fits_at_once(stored)
        present = {r.fold for r in stored.select("fold").distinct().collect()}
        if len(present) < folds:
            raise ValueError(f"only {len(present)} of {folds} folds have rows")
        if moments:
            metrics = _moment_metrics(stored, estimator, evaluator, maps, folds)
        elif nested:
            metrics = _nested_metrics(stored, estimator, evaluator, maps, folds, at_once)
        else:
            metrics = _plain_metrics(stored, estimator, evaluator, maps, folds, at_once)
        means = metrics.mean(axis=1)
        best = int(means.argmax() if evaluator.isLargerBetter() else means.argmin())
        model = CrossValidatorModel(
            estimator.fit(stored, maps[best]), avgMetrics=means.tolist(), stdMetrics=metrics.std(axis=1).tolist()
        )
    for param, value in ((model.estimator, estimator), (model.evaluator, evaluator), (model.estimatorParamMaps, maps)):
        model.set(param, value)
    return model


def fit_and_judge(stored: DataFrame, estimator: Estimator, evaluator: Evaluator, point: dict, fold: int) -> float:
    """The metric on one fold of the model fitted on all others."""
    model = estimator.fit(stored.where(F.col("fold") != fold), point)
    return float(evaluator.evaluate(model.transform(stored.where(F.col("fold") == fold), point)))


def _each(spark: SparkSession, one: Callable, cells: Sequence[tuple], at_once: int) -> list:
    with ThreadPool(at_once) as pool:
        return pool.starmap(inheritable_thread_target(spark)(one), cells, chunksize=1)


def _plain_metrics(
    stored: DataFrame, estimator: Estimator, evaluator: Evaluator, maps: list[dict], folds: int, at_once: int
) -> np.ndarray:
    """A row per grid point, a column per fold, from one fit for each."""
    cells = [(point, fold) for point in maps for fold in range(folds)]
    found = _each(stored.sparkSession, lambda p, f: fit_and_judge(stored, estimator, evaluator, p, f), cells, at_once)
    return np.array(found).reshape(len(maps), folds)


# --- trees that differ in depth only -----------------------------------------

#: Rows that fill the one partition of a small table that deep trees are fitted on.
DEEP_ROWS = 40_000


def cut_values(nodes: DataFrame, depths: Sequence[int]) -> list[tuple[float, list[float]]]:
    """(leaf, its value in the tree cut at each depth) from the node table of one tree.

    Leaves are numbered from the left, as the model numbers them.
    """
    rows = nodes.select("node", "left", "right", "value").orderBy("node").collect()
    parents = {child: r.node for r in rows if r.left is not None for child in (r.left, r.right)}
    levels: dict[int, int] = {}
    cuts: dict[int, list[float]] = {}
    for r in rows:  # in preorder, so a node comes after its parent
        parent = parents.get(r.node)
        levels[r.node] = 0 if parent is None else levels[parent] + 1
        above = cuts.get(parent)
        cuts[r.node] = [r.value if above is None or levels[r.node] <= d else above[i] for i, d in enumerate(depths)]
    leaves = [r.node for r in rows if r.left is None]
    return [(float(i), cuts[node]) for i, node in enumerate(leaves)]


def _nested_metrics(
    stored: DataFrame, estimator: Estimator, evaluator: Evaluator, maps: list[dict], folds: int, at_once: int
) -> np.ndarray:
    """As ``_plain_metrics`` for regression trees: one fit serves all depths of a grid.

    A tree grows level by level and no level looks at the greatest depth, so a tree of a lesser
    depth is the deepest one cut there.  The values of its leaves reach the rows as arrays, whatever the
    rows: none is moved, and where the metric is a mean, one pass judges all depths.
    """
    spark = stored.sparkSession
    depth = estimator.getParam("maxDepth")
    at_one_go = isinstance(evaluator, RegressionEvaluator) and evaluator.getMetricName() == "rmse" and not evaluator.isSet("weightCol")
    alike: dict[tuple, list[int]] = {}
    for i, point in enumerate(maps):
        alike.setdefault(tuple((p.name, v) for p, v in point.items() if p != depth), []).append(i)

    def one(members: list[int], fold: int) -> list[float]:
        deepest = max((maps[i] for i in members), key=lambda point: point[depth])
        model = estimator.fit(stored.where(F.col("fold") != fold), deepest).setLeafCol("leaf")
        cuts = cut_values(tree_tables.tree_nodes(model), [maps[i][depth] for i in members])
        names = [f"d{place}" for place in range(len(members))]
        # Leaves are numbered from 0 on, so a leaf is its value's place.
        values = tuple(list(column) for column in zip(*(values for _, values in cuts)))
        table = spark.createDataFrame([values], ", ".join(f"{n} array<double>" for n in names))
        ended = model.transform(stored.where(F.col("fold") == fold)).drop(model.getPredictionCol())
        judged = [F.get(table.select(n).scalar(), F.col("leaf").cast("int")) for n in names]
        if at_one_go:
            gaps = [value - F.col(evaluator.getLabelCol()) for value in judged]
            return list(ended.agg(*[F.sqrt(F.avg(gap * gap)).alias(n) for n, gap in zip(names, gaps)]).first())
        return [float(evaluator.evaluate(ended.withColumn(model.getPredictionCol(), value))) for value in judged]

    cells = [(members, fold) for members in alike.values() for fold in range(folds)]
    metrics = np.empty((len(maps), folds))
    for (members, fold), found in zip(cells, _each(spark, one, cells, at_once)):
        metrics[members, fold] = found
    return metrics


# --- linear fits from moments ------------------------------------------------


def _from_moments(estimator: Estimator, evaluator: Evaluator, axes: dict[str, Sequence]) -> bool:
    """Whether all fits of a search follow from means and covariances: least squares solved exactly,
    without weights, judged by the root mean square of the gaps."""
    return (
        isinstance(estimator, LinearRegression)
        and estimator.getSolver() == "normal"
        and estimator.getElasticNetParam() == 0.0
        and not estimator.isSet("weightCol")
        and isinstance(evaluator, RegressionEvaluator)
        and evaluator.getMetricName() == "rmse"
        and set(axes) <= {"regParam", "maxIter", "tol"}
    )


def fold_moments(stored: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, means, covariances, least and largest numbers by fold, of the features and, last, the label."""
    width = len(stored.select(vector_to_array("features").alias("x")).first().x)
    x = vector_to_array("features")
    rows = stored.select("fold", *[x[i].alias(f"x{i}") for i in range(width)], F.col("label").alias(f"x{width}"))
    names = [f"x{i}" for i in range(width + 1)]
    sums = [F.covar_pop(a, b) for i, a in enumerate(names) for b in names[i:]]
    found = rows.groupBy("fold").agg(
        F.count("*").alias("n"),
        F.array(*[F.avg(c) for c in names]).alias("means"),
        F.array(*sums).alias("sums"),
        F.array(*[F.min(c) for c in names]).alias("least"),
        F.array(*[F.max(c) for c in names]).alias("most"),
    )
    out = {}
    for r in found.collect():
        cov = np.zeros((width + 1, width + 1))
        cov[np.triu_indices(width + 1)] = r.sums
        cov = cov + np.triu(cov, 1).T
        out[r.fold] = r.n, np.array(r.means), cov, np.array(r.least), np.array(r.most)
    return out


def united(parts: Sequence[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, covariances and which columns are constant, over the rows of several folds."""
    n = sum(p[0] for p in parts)
    mean = sum(p[0] * p[1] for p in parts) / n
    cov = sum(p[0] * (p[2] + np.outer(p[1] - mean, p[1] - mean)) for p in parts) / n
    return mean, cov, np.min([p[3] for p in parts], axis=0) == np.max([p[4] for p in parts], axis=0)


def moment_rows(mean: np.ndarray, cov: np.ndarray, constant: np.ndarray) -> np.ndarray:
    """Few rows with these means and covariances: two on each axis of the standardised cloud."""
    scale = np.where(constant, 0.0, np.sqrt(np.diag(cov)))
    unit = np.where(scale > 0, scale, 1.0)
    values, axes = np.linalg.eigh(np.where(np.outer(scale, scale) > 0, cov / np.outer(unit, unit), 0.0))
    steps = (axes * np.sqrt(np.maximum(values, 0.0) * len(mean))).T * scale
    return np.vstack([mean + steps, mean - steps])


def _moment_metrics(
    stored: DataFrame, estimator: Estimator, evaluator: Evaluator, maps: list[dict], folds: int
) -> np.ndarray:
    """As ``_plain_metrics`` for exact least squares, in two passes over the rows for the whole grid.

    Such a fit knows its rows only by their means and covariances, which add up over folds.  So the
    estimator is given a few rows with the moments of all folds but one, and gives the model of
    those folds; then every row meets the models of the folds without it.
    """
    spark = stored.sparkSession
    by_fold = fold_moments(stored)
    terms: list[list[list[float]]] = []
    for fold in range(folds):
        few = moment_rows(*united([m for f, m in by_fold.items() if f != fold]))
        rows = spark.createDataFrame([(Vectors.dense(r[:-1]), float(r[-1])) for r in few], ["features", "label"]).coalesce(1)
        models = [estimator.fit(rows, point) for point in maps]
        terms.append([[float(m.intercept), *map(float, m.coefficients)] for m in models])
    table = F.array(*[F.array(*[F.array(*map(F.lit, t)) for t in models]) for models in terms])
    row = F.concat(F.array(F.lit(1.0)), vector_to_array("features"))

    def gap(own: Column) -> Column:
        return F.aggregate(F.zip_with(own, "row", lambda a, b: a * b), -F.col("label"), lambda s, v: s + v)

    met = stored.select("fold", "label", row.alias("row"), F.get(table, F.col("fold")).alias("models"))
    gaps = met.select("fold", F.transform("models", gap).alias("gaps"))
    means = [F.sqrt(F.avg(F.get("gaps", F.lit(i)) * F.get("gaps", F.lit(i)))).alias(f"m{i}") for i in range(len(maps))]
    found = {r.fold: list(r)[1:] for r in gaps.groupBy("fold").agg(*means).collect()}
    return np.array([found[fold] for fold in range(folds)]).T


def grid_rows(spark: SparkSession, model: CrossValidatorModel, larger_is_better: bool) -> DataFrame:
    """(point, params, mean_metric, is_best), one row per grid point."""
    scores = list(model.avgMetrics)
    best = scores.index(max(scores) if larger_is_better else min(scores))
    rows = []
    for i, (point, score) in enumerate(zip(model.getEstimatorParamMaps(), scores)):
        text = ", ".join(sorted(f"{p.name}={v}" for p, v in point.items()))
        rows.append((i, text, float(score), i == best))
    return spark.createDataFrame(rows, "point int, params string, mean_metric double, is_best boolean")


def best_param_rows(spark: SparkSession, model: CrossValidatorModel) -> DataFrame:
    """(param, value) of the best fitted model; of its last stage when it is a pipeline."""
    best = model.bestModel
    best = best.stages[-1] if hasattr(best, "stages") else best
    rows = sorted((p.name, str(v)) for p, v in best.extractParamMap().items())
    return spark.createDataFrame(rows, "param string, value string")


def score_grid(df: DataFrame, points: Sequence[dict], is_correct: Callable[[dict], Column]) -> DataFrame:
    """(the point's parameters, n_correct) for every grid point of a rule, in one pass.

    ``is_correct`` turns a point into a condition on a row.  All points are counted in
    the same aggregate, so rows are neither repeated per point nor shuffled.
    """
    counts = df.agg(*[F.count_if(is_correct(p)).alias(f"p{i}") for i, p in enumerate(points)])
    cells = [
        F.struct(*[F.lit(v).alias(name) for name, v in p.items()], F.col(f"p{i}").alias("n_correct"))
        for i, p in enumerate(points)
    ]
    return counts.select(F.inline(F.array(*cells)))

"""Supervised estimators, their scores and what they learned, always as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.operators import metrics
from tablewright.operators.features import assemble
from tablewright.operators.sampling import hash_split
from tablewright.workspace import kept, laid_out

# The parameters each estimator starts from.
DEFAULTS: dict[str, tuple[type[Estimator], dict]] = {
    "dtree_classify": (
        DecisionTreeClassifier,
        {"impurity": "gini", "maxBins": 10, "maxDepth": 30, "seed": 12357},
    ),
    "logistic_classify": (
        LogisticRegression,
        {"maxIter": 100, "regParam": 0.01, "tol": 1e-4, "elasticNetParam": 1.0},
    ),
    "linear_svm_classify": (LinearSVC, {"maxIter": 10000, "regParam": 0.10, "tol": 1e-4}),
    "naive_bayes_classify": (NaiveBayes, {"smoothing": 1.0, "modelType": "multinomial"}),
    "gbt_classify": (GBTClassifier, {"seed": 1234567}),
    "rf_classify": (RandomForestClassifier, {"seed": 1234567}),
    "linear_regress": (LinearRegression, {"solver": "normal", "regParam": 0.0}),
    "glm_regress": (GeneralizedLinearRegression, {"family": "gaussian", "link": "identity"}),
    "dtree_regress": (DecisionTreeRegressor, {"impurity": "variance", "seed": 1234567}),
    "gbt_regress": (GBTRegressor, {"impurity": "variance", "seed": 1234567}),
    "rf_regress": (RandomForestRegressor, {"impurity": "variance", "seed": 1234567}),
    "mlp_classify": (MultilayerPerceptronClassifier, {"maxIter": 100, "seed": 12345}),
}


def make(name: str, **params) -> Estimator:
    """An estimator by name; ``params`` replace its starting parameters.

    One that draws at random must have a seed: the default follows from the process.
    """
    kind, defaults = DEFAULTS[name]
    made = kind(**{**defaults, **params})
    if made.hasParam("seed") and not made.isSet("seed"):
        raise ValueError(f"{name} needs a seed")
    return made


def _long(df: DataFrame, names: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Turn metric columns into (metric, value) rows, keeping the ``by`` columns."""
    cells = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in names]
    return df.select(*by, F.inline(F.array(*cells)))


def _binary_rows(scored: DataFrame, by: list[str]) -> DataFrame:
    counts = metrics.confusion_counts(scored, by=by)
    rates = metrics.binary_rates(counts, by)
    areas = metrics.curve_areas(metrics.score_curve(scored, by=by), by)
    names = [c for c in rates.columns if c not in by]
    return _long(rates, names, by).unionByName(_long(areas, ["roc_auc", "pr_auc"], by))


def _multiclass_rows(scored: DataFrame, by: list[str]) -> DataFrame:
    found = metrics.multiclass_metrics(metrics.multiclass_confusion(scored, by=by), by=by)
    whole = _long(found.where(F.col("is_total")), ["accuracy"], by)
    names = ["precision", "recall", "f1"]
    classes = _long(found.where(~F.col("is_total")), names, [*by, "class"])
    return whole.unionByName(
        classes.select(*by, F.concat_ws("_", "metric", "class").alias("metric"), "value")
    )


def _regression_rows(scored: DataFrame, by: list[str]) -> DataFrame:
    """As the others, with the number of rows."""
    found = metrics.regression_metrics(scored, by=by, size="n_rows")
    return _long(found, [c for c in found.columns if c not in (*by, "n_rows")], [*by, "n_rows"])


REPORTS = {"binary": _binary_rows, "multiclass": _multiclass_rows}


def fit_and_score(
    estimator: Estimator,
    df: DataFrame,
    keys: list[str],
    kind: str,
    train_weight: float = 0.6,
    seed: int = 12345,
    inputs: Sequence[str] | None = None,
    n_rows: int | None = None,
) -> DataFrame:
    """(split, n_rows, metric, value): fit on a keyed share of the rows, score both shares.

    ``kind`` is 'binary', 'multiclass' or 'regression'.  Split, label and feature vector
    are prepared once and kept for the passes the fit and the scoring make over them;
    both shares are judged together.  With ``inputs``, numeric columns instead of a ready vector,
    plain numbers are moved and sorted, rows with one key lie in the order of their numbers, and
    the vectors are built where they are stored.  The layout follows ``n_rows``, or else a count.
    """
    weights = [("train", train_weight), ("test", 1 - train_weight)]
    columns = ["label", *(["features"] if inputs is None else inputs)]
    rows = laid_out(df.select(*keys, *columns), keys, n_rows, then_by=[] if inputs is None else columns)
    if inputs is not None:
        rows = assemble(rows, inputs)
    with kept(hash_split(rows, keys, weights, seed).select("split", "label", "features")) as rows:
        model = estimator.fit(rows.where(F.col("split") == "train").select("label", "features"))
        return score_report(model, rows, kind)


def score_report(model: Model, df: DataFrame, kind: str) -> DataFrame:
    """(split, n_rows, metric, value) of a fitted model on rows that name their split."""
    by = ["split"]
    scored = _score_columns(model.transform(df), kind)
    if kind == "regression":
        # One aggregate gives sizes and errors: nothing is stored.
        found = _regression_rows(scored, by).select("split", "n_rows", "metric", "value")
        return df.sparkSession.createDataFrame(found.collect(), found.schema)
    with kept(scored) as scored:
        sizes = scored.groupBy(*by).agg(F.count("*").alias("n_rows"))
        found = REPORTS[kind](scored, by).join(sizes, by).select("split", "n_rows", "metric", "value")
        return df.sparkSession.createDataFrame(found.collect(), found.schema)


def _score_columns(scored: DataFrame, kind: str) -> DataFrame:
    """Keep the split, label, prediction and, for two classes, the positive one's margin."""
    keep = ["split", "label", "prediction"]
    if kind == "binary":
        return scored.select(*keep, vector_to_array("rawPrediction")[1].alias("score"))
    return scored.select(*keep)


# --- what a model learned ----------------------------------------------------


def coefficient_rows(spark: SparkSession, model: Model, names: Sequence[str]) -> DataFrame:
    """(term, estimate) of a linear model, the intercept included."""
    rows = [("intercept", float(model.intercept))]
    rows += [(n, float(v)) for n, v in zip(names, model.coefficients, strict=True)]
    return spark.createDataFrame(rows, "term string, estimate double")


def naive_bayes_rows(
    spark: SparkSession, model: Model, classes: Sequence[str], names: Sequence[str]
) -> DataFrame:
    """(class, term, value): log prior as 'pi' and log weight per feature."""
    theta = model.theta.toArray()
    rows = []
    for i, label in enumerate(classes):
        rows.append((label, "pi", float(model.pi[i])))
        rows += [(label, n, float(theta[i, j])) for j, n in enumerate(names)]
    return spark.createDataFrame(rows, "class string, term string, value double")


def importance_rows(spark: SparkSession, model: Model, names: Sequence[str]) -> DataFrame:
    """(feature, importance), most important first; every feature is listed by name."""
    values = model.featureImportances.toArray()
    ordered = sorted(zip(names, values, strict=True), key=lambda p: (-p[1], p[0]))
    return spark.createDataFrame([(n, float(v)) for n, v in ordered], "feature string, importance double")


def rule_rows(spark: SparkSession, model: Model) -> DataFrame:
    """(line_no, rule): the learned tree or trees as text, one line per row."""
    lines = model.toDebugString.rstrip("\n").split("\n")
    return spark.createDataFrame(list(enumerate(lines, 1)), "line_no int, rule string")


def layer_parameter_counts(layer_sizes: Sequence[int]) -> list[tuple[int, int]]:
    """(layer, weights and biases) of a fully connected network."""
    return [(i, (a + 1) * b) for i, (a, b) in enumerate(zip(layer_sizes, layer_sizes[1:]))]

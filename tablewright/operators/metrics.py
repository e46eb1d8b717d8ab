"""Evaluation metrics as aggregates over (label, prediction) or (label, score) columns.

Every metric can be taken ``by`` some columns, which gives one result per group (the
parts of a split, say) from the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions.scalars import ratio
from tablewright.operators.ordering import running_totals


def regression_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    size: str | None = None,
) -> DataFrame:
    """Squared, absolute and relative errors from one pass, with the number of rows as ``size``.

    The explained variance is the mean squared distance of the predictions from the
    mean label, taken apart so that no large squares are subtracted.
    """
    y, p = F.col(label), F.col(prediction)
    sizes = [] if size is None else [size]
    sums = df.groupBy(*by).agg(
        *[F.count("*").alias(s) for s in sizes],
        F.avg((p - y) * (p - y)).alias("mse"),
        F.avg(F.abs(p - y)).alias("mae"),
        F.var_pop(y).alias("var_y"),
        F.var_pop(p).alias("var_p"),
        (F.avg(p) - F.avg(y)).alias("shift"),
    )
    return sums.select(
        *by,
        *sizes,
        "mse",
        F.sqrt("mse").alias("rmse"),
        "mae",
        (F.lit(1.0) - ratio(F.col("mse"), F.col("var_y"))).alias("r2"),
        (F.col("var_p") + F.col("shift") * F.col("shift")).alias("explained_variance"),
    )


def rmse(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    d = F.col(prediction) - F.col(label)
    return df.agg(F.sqrt(F.avg(d * d)).alias("rmse"))


# --- two classes -------------------------------------------------------------


def score_curve(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    positive=1.0,
    by: Sequence[str] = (),
) -> DataFrame:
    """(score, tp, fp, hits, misses): the counts at each score and those down to it.

    Rows are counted per distinct score before anything is sorted, so ties never gather.
    """
    hit = F.col(label) == F.lit(positive)
    points = df.groupBy(*by, F.col(score).alias("score")).agg(
        F.count_if(hit).alias("tp"), F.count_if(~hit).alias("fp")
    )
    return running_totals(points, [F.desc("score")], {"hits": "tp", "misses": "fp"}, by)


def curve_areas(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(roc_auc, pr_auc) of a score curve, both from one aggregate.

    ROC: the share of (positive, negative) pairs in the right order, equal scores counting
    half.  Precision-recall: trapezoids, from recall 0 at the precision of the top score.
    """
    hits, misses, tp = F.col("hits"), F.col("misses"), F.col("tp")
    hits_before, misses_before = hits - tp, misses - F.col("fp")
    precision = hits / (hits + misses)
    before = ratio(hits_before, (hits_before + misses_before).cast("double"))
    sums = curve.groupBy(*by).agg(
        F.sum(tp * (misses - F.col("fp") / F.lit(2.0))).alias("lost"),
        F.sum(tp * (precision + F.coalesce(before, precision)) / F.lit(2.0)).alias("area"),
        F.max("hits").cast("double").alias("p"),
        F.max("misses").cast("double").alias("n"),
    )
    return sums.select(
        *by,
        (F.lit(1.0) - ratio(F.col("lost"), F.col("p") * F.col("n"))).alias("roc_auc"),
        ratio(F.col("area"), F.col("p")).alias("pr_auc"),
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", positive=1.0) -> DataFrame:
    """Area under the ROC curve; null when a class is absent."""
    return curve_areas(score_curve(df, label, score, positive)).select("roc_auc")


def pr_auc(df: DataFrame, label: str = "label", score: str = "score", positive=1.0) -> DataFrame:
    """Area under the precision-recall curve; null when there is no positive row."""
    return curve_areas(score_curve(df, label, score, positive)).select("pr_auc")


def confusion_counts(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    positive=1.0,
    by: Sequence[str] = (),
) -> DataFrame:
    """tp, tn, fp, fn and n from a single pass; ``positive`` says which class is positive."""
    truth, guess = F.col(label) == F.lit(positive), F.col(prediction) == F.lit(positive)
    return df.groupBy(*by).agg(
        F.count_if(truth & guess).alias("tp"),
        F.count_if(~truth & ~guess).alias("tn"),
        F.count_if(~truth & guess).alias("fp"),
        F.count_if(truth & ~guess).alias("fn"),
        F.count("*").alias("n"),
    )


def confusion_fractions(counts: DataFrame) -> DataFrame:
    """Each cell as a fraction of all rows (not a rate within a class)."""
    n = F.col("n").cast("double")
    return counts.select(*[ratio(F.col(c), n).alias(c) for c in ("tp", "tn", "fp", "fn")])


def _mcc(tp: Column, tn: Column, fp: Column, fn: Column) -> Column:
    spread = F.sqrt(tp + fp) * F.sqrt(tp + fn) * F.sqrt(fp + tn) * F.sqrt(tn + fn)
    return ratio(tp * tn - fp * fn, spread)


def matthews_corrcoef(counts: DataFrame) -> DataFrame:
    """Null when a class or a prediction is absent and the coefficient is undefined."""
    cells = [F.col(c).cast("double") for c in ("tp", "tn", "fp", "fn")]
    return counts.select(_mcc(*cells).alias("mcc"))


def binary_rates(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rates within a class or a prediction, accuracy, F1 and the Matthews coefficient."""
    tp, tn, fp, fn = [F.col(c).cast("double") for c in ("tp", "tn", "fp", "fn")]
    return counts.select(
        *by,
        ratio(tp, tp + fn).alias("tpr"),
        ratio(tn, tn + fp).alias("tnr"),
        ratio(tp, tp + fp).alias("ppv"),
        ratio(tn, tn + fn).alias("npv"),
        ratio(fp, tn + fp).alias("fpr"),
        ratio(fn, tp + fn).alias("fnr"),
        ratio(fp, tp + fp).alias("fdr"),
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        ratio(F.lit(2.0) * tp, F.lit(2.0) * tp + fp + fn).alias("f1"),
        _mcc(tp, tn, fp, fn).alias("mcc"),
    )


# --- many classes ------------------------------------------------------------


def multiclass_confusion(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    return df.groupBy(*by, label, prediction).agg(F.count("*").alias("n"))


def multiclass_metrics(
    confusion: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """(class, is_total, precision, recall, f1, accuracy) from confusion cells.

    Each cell adds to its true class and to its predicted class, so one grouping gives
    both margins; accuracy covers all classes and stands on a row of its own without a class.
    """
    hit = F.col(label) == F.col(prediction)
    zero = F.lit(0).cast("bigint")

    def margin(name: str, actual: Column, guessed: Column) -> Column:
        label_text = F.col(name).cast("string").alias("class")
        return F.struct(label_text, actual.alias("actual"), guessed.alias("guessed"))

    cells = confusion.select(
        *by,
        F.inline(F.array(margin(label, F.col("n"), zero), margin(prediction, zero, F.col("n")))),
        F.when(hit, F.col("n")).otherwise(0).alias("hits"),
    )
    per_class = cells.groupBy(*by, "class").agg(
        F.sum("actual").alias("actual"),
        F.sum("guessed").alias("guessed"),
        F.sum(F.when(F.col("actual") > 0, F.col("hits")).otherwise(0)).alias("hits"),
    )
    hits, actual, guessed = [F.col(c).cast("double") for c in ("hits", "actual", "guessed")]
    rows = per_class.select(
        *by,
        "class",
        F.lit(False).alias("is_total"),
        ratio(hits, guessed).alias("precision"),
        ratio(hits, actual).alias("recall"),
        ratio(F.lit(2.0) * hits, actual + guessed).alias("f1"),
        F.lit(None).cast("double").alias("accuracy"),
    )
    none = F.lit(None).cast("double")
    right = F.sum(F.when(hit, F.col("n")).otherwise(0)).cast("double")
    whole = (
        confusion.groupBy(*by)
        .agg(ratio(right, F.sum("n").cast("double")).alias("accuracy"))
        .withColumns({"class": F.lit(None).cast("string"), "is_total": F.lit(True), "precision": none, "recall": none, "f1": none})
    )
    return rows.unionByName(whole)


# --- clusters ----------------------------------------------------------------


def silhouette(df: DataFrame, features: str = "features", cluster: str = "prediction") -> float:
    """Squared-Euclidean silhouette from per-cluster sums, never from pairs of rows."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=cluster).evaluate(df)

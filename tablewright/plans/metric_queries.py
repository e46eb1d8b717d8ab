"""Queries over evaluation metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.functions.scalars import rounded
from tablewright.operators import clustering, features, metrics
from tablewright.plans import views
from tablewright.plans.oracle_views import over
from tablewright.plans.registry import query


def _rounded_row(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[rounded(c, digits).alias(c) for c in df.columns])


# --- regression --------------------------------------------------------------


def line_predictions(spark: SparkSession, d: str) -> DataFrame:
    """Extended price as the label, list price times quantity as its prediction."""
    return views.priced_lines(spark, d).select(
        "label", (F.col("p_retailprice") * F.col("l_quantity")).alias("prediction")
    )


def _regression_sql(label: str, prediction: str) -> str:
    return over(
        "priced_lines",
        f""", p AS (SELECT label, p_retailprice * l_quantity AS prediction FROM priced_lines),
             q AS (SELECT {label} AS y, {prediction} AS p, (SELECT avg({label}) FROM p) AS m FROM p)
           SELECT round(avg((p - y) * (p - y)), 1) + 0.0 AS mse,
                  round(sqrt(avg((p - y) * (p - y))), 3) + 0.0 AS rmse,
                  round(avg(abs(p - y)), 3) + 0.0 AS mae,
                  round(1 - sum((p - y) * (p - y)) / sum((y - m) * (y - m)), 6) + 0.0 AS r2,
                  round(avg((p - m) * (p - m)), 1) + 0.0 AS explained_variance
           FROM q""",
    )


def _regression_row(df: DataFrame) -> DataFrame:
    digits = {"mse": 1, "explained_variance": 1, "r2": 6}
    return df.select(*[rounded(c, digits.get(c, 3)).alias(c) for c in df.columns])


@query("regression_metrics", _regression_sql("label", "prediction"))
def regression_metrics(spark: SparkSession, d: str) -> DataFrame:
    return _regression_row(metrics.regression_metrics(line_predictions(spark, d)))


@query("regression_metrics_swapped", _regression_sql("prediction", "label"))
def regression_metrics_swapped(spark: SparkSession, d: str) -> DataFrame:
    """The two columns exchanged: errors stay, r2 and explained variance do not."""
    swapped = metrics.regression_metrics(line_predictions(spark, d), "prediction", "label")
    return _regression_row(swapped)


# --- two classes -------------------------------------------------------------


def _roc_sql(score: str) -> str:
    return over(
        "scored",
        f""", g AS (SELECT {score} AS s, CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
                          CAST(sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS DOUBLE) AS fp
                   FROM scored GROUP BY 1),
             r AS (SELECT tp, fp, sum(fp) OVER (ORDER BY s) - fp AS below FROM g)
           SELECT round(sum(tp * (below + fp / 2)) / (sum(tp) * sum(fp)), 6) + 0.0 AS roc_auc FROM r""",
    )


@query("roc_auc", _roc_sql("score"))
def roc_auc(spark: SparkSession, d: str) -> DataFrame:
    return _rounded_row(metrics.roc_auc(views.scored_documents(spark, d)))


@query("roc_auc_hard_label", _roc_sql("prediction"))
def roc_auc_hard_label(spark: SparkSession, d: str) -> DataFrame:
    """The area when the 0/1 prediction itself is taken as the score."""
    return _rounded_row(metrics.roc_auc(views.scored_documents(spark, d), score="prediction"))


@query(
    "pr_auc",
    over(
        "scored",
        """, g AS (SELECT score AS s, CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
                          CAST(sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS DOUBLE) AS fp
                   FROM scored GROUP BY 1),
             c AS (SELECT s, tp, sum(tp) OVER w AS h, sum(fp) OVER w AS m, sum(tp) OVER () AS p
                   FROM g WINDOW w AS (ORDER BY s DESC)),
             q AS (SELECT s, h / p AS recall, h / (h + m) AS prec FROM c),
             l AS (SELECT recall, prec, lag(recall, 1, 0.0) OVER (ORDER BY s DESC) AS r0,
                          coalesce(lag(prec) OVER (ORDER BY s DESC), prec) AS p0 FROM q)
           SELECT round(sum((recall - r0) * (prec + p0) / 2), 6) + 0.0 AS pr_auc FROM l""",
    ),
)
def pr_auc(spark: SparkSession, d: str) -> DataFrame:
    return _rounded_row(metrics.pr_auc(views.scored_documents(spark, d)))


_CELLS = """, k AS (SELECT CAST(sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
                         CAST(sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn,
                         CAST(sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
                         CAST(sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fn,
                         CAST(count(*) AS DOUBLE) AS n FROM scored)"""
_MCC = "(tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (fp + tn) * (tn + fn))"


def counts(spark: SparkSession, d: str) -> DataFrame:
    return metrics.confusion_counts(views.scored_documents(spark, d))


@query(
    "confusion_fractions",
    over(
        "scored",
        _CELLS
        + """ SELECT round(tp / n, 6) + 0.0 AS tp, round(tn / n, 6) + 0.0 AS tn,
                     round(fp / n, 6) + 0.0 AS fp, round(fn / n, 6) + 0.0 AS fn FROM k""",
    ),
)
def confusion_fractions(spark: SparkSession, d: str) -> DataFrame:
    return _rounded_row(metrics.confusion_fractions(counts(spark, d)))


@query("matthews_corrcoef", over("scored", _CELLS + f" SELECT round({_MCC}, 6) + 0.0 AS mcc FROM k"))
def matthews_corrcoef(spark: SparkSession, d: str) -> DataFrame:
    return _rounded_row(metrics.matthews_corrcoef(counts(spark, d)))


@query(
    "binary_rates",
    over(
        "scored",
        _CELLS
        + f""" SELECT round(tp / (tp + fn), 6) + 0.0 AS tpr, round(tn / (tn + fp), 6) + 0.0 AS tnr,
                      round(tp / (tp + fp), 6) + 0.0 AS ppv, round(tn / (tn + fn), 6) + 0.0 AS npv,
                      round(1 - tn / (tn + fp), 6) + 0.0 AS fpr, round(1 - tp / (tp + fn), 6) + 0.0 AS fnr,
                      round(1 - tp / (tp + fp), 6) + 0.0 AS fdr, round((tp + tn) / n, 6) + 0.0 AS accuracy,
                      round(2 * (tp / (tp + fp)) * (tp / (tp + fn))
                            / (tp / (tp + fp) + tp / (tp + fn)), 6) + 0.0 AS f1,
                      round({_MCC}, 6) + 0.0 AS mcc FROM k""",
    ),
)
def binary_rates(spark: SparkSession, d: str) -> DataFrame:
    return _rounded_row(metrics.binary_rates(counts(spark, d)))


# --- many classes ------------------------------------------------------------


@query(
    "multiclass_confusion",
    over("guesses", "SELECT label, prediction, count(*) AS n FROM guesses GROUP BY label, prediction"),
)
def multiclass_confusion(spark: SparkSession, d: str) -> DataFrame:
    return metrics.multiclass_confusion(views.language_guesses(spark, d))


@query(
    "multiclass_metrics",
    over(
        "guesses",
        """, c AS (SELECT label AS class FROM guesses UNION SELECT prediction FROM guesses),
             m AS (SELECT class,
                     CAST((SELECT count(*) FROM guesses WHERE label = class AND prediction = class) AS DOUBLE) AS h,
                     CAST((SELECT count(*) FROM guesses WHERE label = class) AS DOUBLE) AS a,
                     CAST((SELECT count(*) FROM guesses WHERE prediction = class) AS DOUBLE) AS g FROM c)
           SELECT class, round(h / nullif(g, 0), 6) + 0.0 AS "precision",
                  round(h / nullif(a, 0), 6) + 0.0 AS recall,
                  round(2 * h / (a + g), 6) + 0.0 AS f1, CAST(NULL AS DOUBLE) AS accuracy FROM m
           UNION ALL
           SELECT 'all', NULL, NULL, NULL,
                  round(avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0.0 END), 6) FROM guesses""",
    ),
)
def multiclass_metrics(spark: SparkSession, d: str) -> DataFrame:
    per_class = metrics.multiclass_metrics(metrics.multiclass_confusion(views.language_guesses(spark, d)))
    return per_class.select(
        F.when(F.col("is_total"), "all").otherwise(F.col("class")).alias("class"),
        *[rounded(c).alias(c) for c in ("precision", "recall", "f1", "accuracy")]
    )


# --- clusters ----------------------------------------------------------------

# Fixed value: how many of the lowest-numbered vectors serve as centres.
CENTRES = 5

_NEAREST = f""", x AS (SELECT vec_id, unnest(range(0, len(embedding))) AS dim, unnest(embedding) AS v
                       FROM expression),
                 s AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cluster, vec_id FROM expression
                       ORDER BY vec_id LIMIT {CENTRES}),
                 c AS (SELECT cluster, dim, v FROM s JOIN x USING (vec_id)),
                 d AS (SELECT x.vec_id, c.cluster, sum((x.v - c.v) * (x.v - c.v)) AS cost
                       FROM x JOIN c USING (dim) GROUP BY x.vec_id, c.cluster),
                 a AS (SELECT vec_id, cluster, cost FROM d
                       QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY cost, cluster) = 1)"""


def centres(spark: SparkSession, d: str):
    vectors = views.expression(spark, d)
    return vectors, clustering.lowest_id_centres(vectors, "vec_id", "embedding", CENTRES)


@query(
    "kmeans_lloyd_step",
    over(
        "expression",
        _NEAREST
        + """ SELECT CAST(a.cluster AS INT) AS cluster, CAST(dim AS INT) AS dim, count(*) AS n,
                     round(avg(v), 6) + 0.0 AS centre
              FROM a JOIN x USING (vec_id) GROUP BY a.cluster, dim""",
    ),
)
def kmeans_lloyd_step(spark: SparkSession, d: str) -> DataFrame:
    vectors, start = centres(spark, d)
    step = clustering.lloyd_step(vectors, "embedding", start)
    return step.select("cluster", "n", F.posexplode("centre").alias("dim", "centre")).select(
        "cluster", "dim", "n", rounded("centre").alias("centre")
    )


@query("wcss", over("expression", _NEAREST + " SELECT round(sum(cost), 6) + 0.0 AS wcss FROM a"))
def wcss(spark: SparkSession, d: str) -> DataFrame:
    vectors, start = centres(spark, d)
    return clustering.within_cluster_cost(vectors, "embedding", start).select(rounded("wcss").alias("wcss"))


@query(
    "silhouette",
    over(
        "expression",
        """, pairs AS (SELECT a.vec_id, a.label AS own, b.label AS other, b.vec_id AS other_id,
                              list_sum(list_transform(list_zip(a.embedding, b.embedding),
                                       lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS dist
                       FROM expression a CROSS JOIN expression b),
             m AS (SELECT vec_id, own, other, sum(dist)
                          / (CASE WHEN own = other THEN count(*) - 1 ELSE count(*) END) AS mean_dist
                   FROM pairs GROUP BY vec_id, own, other),
             s AS (SELECT vec_id, min(CASE WHEN own = other THEN mean_dist END) AS a,
                          min(CASE WHEN own <> other THEN mean_dist END) AS b FROM m GROUP BY vec_id)
           SELECT round(avg((b - a) / greatest(a, b)), 6) + 0.0 AS silhouette FROM s""",
    ),
)
def silhouette(spark: SparkSession, d: str) -> DataFrame:
    """How well the true labels separate the vectors."""
    rows = features.vector_from_array(views.expression(spark, d), "embedding").select(
        "features", F.col("label").cast("double").alias("prediction")
    )
    value = metrics.silhouette(rows)
    return spark.createDataFrame([(value,)], "silhouette double").select(rounded("silhouette").alias("silhouette"))

"""Quality of documents by hierarchical empirical Bayes over sites.

Three sources speak about a document: its own text (log-odds of a logistic regression over
document statistics), the path of its site and its host.  Hosts are beta-binomial groups
around the global share of good documents, paths are groups around their host; how strongly
a level is shrunk follows from how much its groups differ beyond chance.  A sparse site so
stays near the global prior, a well-known one moves the odds of its documents.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.llm.labelled import HELD_OUT_FOLD, SAMPLE_ROWS, labelled_sample, training_labels
from tablewright.llm.quality_rules import statistics
from tablewright.llm.words import CARRIED, fold_number, uncarry
from tablewright.workspace import materialize

REGULARISATION = 0.001
#: The text's evidence is held to this many natural log units either way.
MOST_EVIDENCE = 12.0
LEAST_PROBABILITY = 0.5
#: Shrinkage of a level in pseudo-documents: between one and practically everything.
PSEUDO_RANGE = (1.0, 1e6)

HOST, PATH = "source", "lang"


def fit_text_evidence(docs: DataFrame, labels: DataFrame, bound: int) -> tuple[list[float], float] | None:
    """Coefficients and intercept of the text's log-odds beyond the prior; None for one class."""
    sample = labelled_sample(docs, labels, "quality", bound)
    rows = materialize(
        sample.select(
            F.least("label", F.lit(1)).cast("double").alias("label"),
            "weight",
            statistics("text")["features"].alias("x"),
        ),
        "site-sample",
    )
    known = rows.agg(
        F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("label")).alias("good")
    ).first()
    if not known.n or not 0 < known.good < known.n:
        return None
    fitted = LogisticRegression(
        featuresCol="v", labelCol="label", weightCol="weight", regParam=REGULARISATION, maxIter=100, tol=1e-6
    ).fit(rows.withColumn("v", array_to_vector("x")))
    prior = known.good / known.n
    return [float(c) for c in fitted.coefficients], float(fitted.intercept) - math.log(prior / (1 - prior))


def _pseudo_documents(groups: DataFrame, expected: Column) -> float:
    """Beta-binomial concentration by moments: how far groups lie from ``expected`` beyond what
    their sizes explain."""
    n, good = F.col("n"), F.col("good")
    share = good / n
    within = expected * (1 - expected)
    m = groups.agg(
        F.sum(n).alias("n"),
        F.sum(n * (share - expected) * (share - expected)).alias("spread"),
        F.sum(within).alias("chance"),
        F.sum(n * within).alias("within"),
    ).first()
    low, high = PSEUDO_RANGE
    if not m.n or not m.within:
        return high
    between = max(0.0, (m.spread - m.chance) / m.n)
    return min(high, max(low, m.within / m.n / between - 1)) if between > 0 else high


def site_posteriors(known: DataFrame) -> tuple[float, DataFrame, DataFrame]:
    """(global share, posterior by host, posterior by host and path) from labelled rows
    (host, path, label); null is a host or path like any other."""
    good = F.sum(F.least(F.col("label"), F.lit(1))).cast("double")
    paths = materialize(
        known.groupBy("host", "path").agg(F.count("*").cast("double").alias("n"), good.alias("good")), "paths"
    )
    total = paths.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    share = ((total.good or 0.0) + 1.0) / ((total.n or 0.0) + 2.0)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    m = _pseudo_documents(hosts, F.lit(share))
    by_host = materialize(
        hosts.select("host", ((F.col("good") + m * share) / (F.col("n") + m)).alias("host_share")), "hosts"
    )
    around = paths.join(
        by_host.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h")), "left"
    )
    m = _pseudo_documents(around, F.col("host_share"))
    by_path = materialize(
        around.select(
            "host", "path", ((F.col("good") + m * F.col("host_share")) / (F.col("n") + m)).alias("path_share")
        ),
        "path-shares",
    )
    return share, by_host, by_path


def add_site_quality(
    rows: DataFrame, docs: DataFrame, labels: DataFrame, host: str = HOST, path: str = PATH, bound: int = SAMPLE_ROWS
) -> DataFrame:
    """``rows`` (text, host, path and anything else) plus text_evidence, host_share, path_share
    and p_good; ``docs`` and ``labels`` are what is learnt from."""
    sites = docs.select("doc_id", F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"))
    known = sites.join(training_labels(labels, "quality"), "doc_id")
    share, by_host, by_path = site_posteriors(known)
    fitted = fit_text_evidence(docs, labels, bound)
    evidence = F.lit(0.0)
    scored = rows
    if fitted is not None:
        coefficients, intercept = fitted
        scored = rows.withColumn("x", statistics("text")["features"])
        terms = F.zip_with("x", F.array(*[F.lit(c) for c in coefficients]), lambda a, b: a * b)
        margin = F.aggregate(terms, F.lit(intercept), lambda acc, t: acc + t)
        evidence = F.greatest(F.lit(-MOST_EVIDENCE), F.least(F.lit(MOST_EVIDENCE), margin))
    scored = scored.withColumn("text_evidence", evidence).drop("x", "text")
    # The posteriors are read from files, so Spark knows their size: small ones are sent to the
    # rows, large ones are joined by a shuffle that splits hot hosts.
    by_host = by_host.withColumnRenamed("host", "h1")
    by_path = by_path.withColumnsRenamed({"host": "h2", "path": "p2"})
    placed = scored.join(by_host, F.col("host").eqNullSafe(F.col("h1")), "left").join(
        by_path, F.col("host").eqNullSafe(F.col("h2")) & F.col("path").eqNullSafe(F.col("p2")), "left"
    )
    prior = F.coalesce("path_share", "host_share", F.lit(share))
    odds = F.col("text_evidence") + F.log(prior / (1 - prior))
    return placed.withColumns(
        {
            "host_share": F.coalesce("host_share", F.lit(share)),
            "path_share": prior,
            "p_good": 1 / (1 + F.exp(-odds)),
        }
    ).drop("h1", "h2", "p2")


def _inputs(docs: DataFrame, host: str, path: str) -> list[Column]:
    return [
        F.col("text").cast("string").alias("text"),
        F.col(host).cast("string").alias("host"),
        F.col(path).cast("string").alias("path"),
    ]


def classify_by_site(
    docs: DataFrame, labels: DataFrame, host: str = HOST, path: str = PATH, bound: int = SAMPLE_ROWS
) -> DataFrame:
    """(doc_id, held_out, host_share, path_share, text_evidence, p_good, kept) per row of ``docs``.

    Labels of fold 0 are never learnt from.  A null or empty text has the evidence of its
    statistics, all zero; an unlabelled site has the posterior of the level above it.  Without
    labels of both classes the text says nothing and the prior is the smoothed global share.
    Repeated rows get equal results; other columns are not read.
    """
    rows = docs.select("doc_id", *_inputs(docs, host, path))
    scored = add_site_quality(rows, docs, labels, host, path, bound)
    return scored.select(
        "doc_id",
        (fold_number() == HELD_OUT_FOLD).alias("held_out"),
        "host_share",
        "path_share",
        "text_evidence",
        "p_good",
        (F.col("p_good") >= LEAST_PROBABILITY).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier keeps."""
    host, path = options.get("host", HOST), options.get("path", PATH)
    rows = docs.select(F.struct("*").alias(CARRIED), *_inputs(docs, host, path))
    return uncarry(add_site_quality(rows, docs, labels, **options).where(F.col("p_good") >= LEAST_PROBABILITY))

"""Quality rules: fixed limits and boosted trees over document statistics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from tablewright.llm.boosted_trees import FlatTrees, fit_trees
from tablewright.llm.doc_stats import COUNTS, FEATURES, count_matrix, features
from tablewright.llm.labelled import SAMPLE_ROWS, labelled_sample
from tablewright.llm.words import utf8

LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
#: A document that passes the limits is rejected if its probability of good quality is below this.
LEAST_PROBABILITY = 0.5
#: More of these never raises a document's score.
FALLING = ("symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "bang_rate", "same_next_rate", "top_rate")
REPORTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

MEASURED = T.StructType(
    [T.StructField(name, T.LongType()) for name in REPORTED] + [T.StructField("p_good", T.DoubleType())]
)
SAMPLED = T.StructType([T.StructField("features", T.ArrayType(T.DoubleType()))])


@F.arrow_udf(SAMPLED)
def statistics(texts: pa.Array) -> pa.Array:
    rows = features(count_matrix(utf8(texts)))
    return pa.array([{"features": r} for r in rows], to_arrow_type(SAMPLED))


def fit_quality_trees(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_ROWS) -> FlatTrees | None:
    """Trees for labels.quality over at most ``bound`` labelled training rows.

    Only the statistics of the sample come to the driver; ``len(FEATURES)`` numbers a row.
    """
    sample = labelled_sample(docs, labels, "quality", bound)
    rows = sample.select("doc_id", "label", "weight", statistics("text")["features"].alias("x"))
    seen = sorted(rows.collect())
    x = np.array([r.x for r in seen], dtype=np.float64).reshape(len(seen), len(FEATURES))
    y = np.array([min(r.label, 1) for r in seen], dtype=np.float64)
    weight = np.array([r.weight for r in seen], dtype=np.float64)
    return fit_trees(x, y, weight, [-1 if f in FALLING else 0 for f in FEATURES])


def measure(docs: DataFrame, trees: FlatTrees | None) -> DataFrame:
    """``docs`` plus one struct column of MEASURED."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    @F.arrow_udf(MEASURED)
    def measured(texts: pa.Array) -> pa.Array:
        matrix = count_matrix(utf8(texts))
        trees = shared.value
        p = trees.probability(features(matrix)) if trees is not None else np.ones(len(matrix))
        columns = [pa.array(matrix[:, COUNTS.index(name)]) for name in REPORTED] + [pa.array(p)]
        return pa.StructArray.from_arrays(columns, names=MEASURED.names)

    return docs.withColumn("measured", measured(F.col("text").cast("string")))


def apply_quality_rules(
    docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_ROWS, least_probability: float = LEAST_PROBABILITY
) -> DataFrame:
    """(doc_id, counts, base_failed, kept, p_good) for every row of ``docs`` (doc_id, text).

    A null or empty text has no words and fails the limits.  Without labels of both classes
    there are no trees: p_good is 1 and the limits alone decide.  Repeated rows get equal
    results; a document with several labels has the larger; other columns are not read.
    """
    trees = fit_quality_trees(docs, labels, bound)
    rows = measure(docs.select("doc_id", "text"), trees).select("doc_id", "measured.*")
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    return rows.select(
        "doc_id",
        *REPORTED,
        failed.alias("base_failed"),
        (~failed & (F.col("p_good") >= least_probability)).alias("kept"),
        "p_good",
    )

"""Bounded, repeatable samples of labelled documents for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablewright.llm.words import fold_number

#: Most labelled rows a classifier is fitted on, half of them for each class.
SAMPLE_ROWS = 20_000
HELD_OUT_FOLD = 0


def training_labels(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) of the training folds; null ids and labels are left out, and the larger
    label counts where a document has several."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    usable = usable.where(fold_number() != HELD_OUT_FOLD)
    return usable.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, text, label, weight): at most ``bound`` labelled ids, the first in hash order.

    Half of the bound goes to each class; the weight of a row is the number of labelled rows of
    its class that it stands for.  The ids are bounded, so they are sent to the documents.
    """
    known = training_labels(labels, label)
    totals = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    taken = None
    for c, n in sorted(totals.items()):
        order = [F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id")]
        some = known.where(F.col("label") == c).orderBy(*order).limit(bound // 2)
        some = some.withColumn("weight", F.lit(n / min(n, bound // 2)))
        taken = some if taken is None else taken.unionByName(some)
    if taken is None:
        taken = known.withColumn("weight", F.lit(1.0))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(taken), "doc_id")

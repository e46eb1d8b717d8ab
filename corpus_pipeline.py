"""Cleaning and mixing a corpus in five stages; each reads what the one before has written.

Every stage takes any documents (doc_id, text, source, lang and whatever else they hold) and all
but the last return the rows they keep unchanged, with all columns.  Repeated rows are judged
alike.  An empty table stays empty.  Columns with names that operators use are carried along.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.llm.decontaminate import drop_contaminated
from tablewright.llm.jaccard_join import keep_one
from tablewright.llm.site_quality import keep_good
from tablewright.llm.source_mix import mix_sources
from tablewright.llm.toxicity import keep_clean
from tablewright.plans.views import table
from tablewright.workspace import materialize

#: Most texts that Spark hands to Python at once.  Its 10,000 rows would be some 30 MB of whole texts, held
#: by the rows waiting in the JVM, the batch beside them and its copy in Python, for each task and operator.
TEXTS_AT_ONCE = 1_000
BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage in a session whose Arrow batches hold TEXTS_AT_ONCE rows at most; a smaller setting
    stays.  It lasts beyond the call, as the stage's rows are computed after it."""

    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not 0 < int(spark.conf.get(BATCH_KEY)) <= TEXTS_AT_ONCE:
            spark.conf.set(BATCH_KEY, str(TEXTS_AT_ONCE))
        return stage(spark, docs, sf_dir)

    return bounded


@small_batches
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the site-aware quality classifier keeps: probability 0.5 or more.

    A null or empty text is judged by its statistics, all 0, and its site; a null source or lang
    is a site like any other.
    """
    return keep_good(docs, table(spark, sf_dir, "labels"))


@small_batches
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not predicted to be toxic: score under 0.5, ties go.

    A null or empty text scores as a text without any similarity.
    """
    return keep_clean(docs, table(spark, sf_dir, "labels"))


@small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest doc_id, null last.

    Of several rows with that id one stays.  Texts that are null or hold no words all stay.
    """
    return keep_one(docs)


@small_batches
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not contaminated with benchmark passages.

    A null or empty text has no hits and stays.
    """
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@small_batches
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document it takes, with its words and how many of them are taken.

    Documents without words, null ones among them, take nothing and are left out.  A null source
    is a source, the last one in order.
    """
    mixed = mix_sources(docs)
    return mixed.where(F.col("taken") > 0)


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: Trained classifiers have no closed form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

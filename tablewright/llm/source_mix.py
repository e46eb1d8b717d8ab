"""Mixing sources to target weights by weighted fair queueing, without Python on the executors.

Every document gets a virtual finish time: the words of its source up to and including it,
in shuffled order, divided by the target of the source.  A source that is read again
continues its clock.  Sorting all documents by finish time interleaves the sources in
proportion to their targets at every prefix, and cutting the sorted stream at the budget
leaves every source within one document of its target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.llm.words import PLAIN_WORD
from tablewright.operators.ordering import ranked, running_totals
from tablewright.workspace import materialize

WEIGHTS = (3, 1, 2)
BUDGET_SHARE = 1.5
MAX_REPEATS = 2
SEED = 20


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(PLAIN_WORD)).cast("bigint")


def shuffle_key(doc_id: Column, seed: int) -> Column:
    """Position of a document in its source's shuffled order; rows with one id are ordered by size."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), doc_id.cast("string")))


def source_targets(
    sized: DataFrame, weights: Sequence[int], budget_share: float, max_repeats: int
) -> tuple[DataFrame, float]:
    """Per source: size and target; and the budget in words.

    The weights repeat over the sources in code point order, null last.  Sources reach their
    cap of ``max_repeats`` times their size in the order of cap per weight, so one running
    total over that order finds the level at which the remaining sources share the rest.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = ranked(totals, [F.col("source").asc_nulls_last()], name="place")
    choices = F.array(*[F.lit(float(w)) for w in weights])
    weighted = placed.select(
        "source",
        "source_size",
        "place",
        F.get(choices, F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int")).alias("weight"),
        (F.col("source_size") * max_repeats).cast("double").alias("cap"),
    )
    filled = running_totals(
        weighted.withColumn("__fill", F.col("cap") / F.col("weight")),
        ["__fill", "place"],
        {"caps": "cap", "weights": "weight"},
    )
    all_of = filled.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    budget = budget_share * float(all_of.words or 0)
    level = (F.lit(budget) - (F.col("caps") - F.col("cap"))) / (
        F.lit(all_of.weight) - (F.col("weights") - F.col("weight"))
    )
    open_ended = filled.withColumn("level", level).where(F.col("__fill") > F.col("level"))
    # One number: the level at the first source that stays below its cap.
    first_open = open_ended.agg(F.min_by("level", F.struct("__fill", "place")).alias("level")).first()
    share = F.col("cap")
    if first_open.level is not None:
        share = F.least(share, F.col("weight") * F.lit(first_open.level))
    return filled.select("source", "source_size", share.alias("target")), budget


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    budget_share: float = BUDGET_SHARE,
    max_repeats: int = MAX_REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row of ``docs``.

    ``docs`` needs doc_id, text and source; other columns are not read.  A null text has size
    0 and is taken 0 times; a null source is a source of its own, a null doc_id is shuffled as
    empty text.  Rows that repeat an id or a whole row are documents of their own, ordered by
    size within the id; a tie in finish time goes to the first source, then to the earlier
    document.  An empty table gives an empty mix.
    """
    sized = materialize(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sized"
    )
    targets, budget = source_targets(sized, weights, budget_share, max_repeats)
    keyed = sized.withColumn("__key", shuffle_key(F.col("doc_id"), seed))
    queued = running_totals(
        keyed, ["__key", "size"], {"served": "size", "nth": F.lit(1).cast("bigint")}, ["source"]
    )
    targets = targets.withColumnRenamed("source", "__source")
    planned = queued.join(targets, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source")
    rounds = planned.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
    clock = (F.col("round") * F.col("source_size") + F.col("served")) / F.nullif(F.col("target"), F.lit(0.0))
    timed = running_totals(
        rounds.withColumn("finish", clock),
        [F.col("finish").asc_nulls_last(), F.col("source").asc_nulls_last(), "nth", "round"],
        {"spent": "size"},
    )
    row = ["doc_id", "source", "size", "source_size", "target", "nth"]
    words = F.when(F.col("spent") <= F.lit(budget), F.col("size")).otherwise(0)
    return timed.groupBy(*row).agg(F.sum(words).alias("taken")).drop("nth")

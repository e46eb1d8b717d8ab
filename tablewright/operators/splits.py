"""Best single split of a numeric feature, the step a decision tree repeats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.operators.ordering import running_totals


def _by_value(df: DataFrame, features: Sequence[str], label: Column) -> DataFrame:
    """(feature, value, n, s): label totals per distinct value of each feature."""
    cells = [
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features
    ]
    return (
        df.select(F.inline(F.array(*cells)), label.alias("y"))
        .where(F.col("y").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count("y").alias("n"), F.sum("y").alias("s"))
    )


def _candidates(df: DataFrame, features: Sequence[str], label: Column) -> DataFrame:
    """One row per midpoint between neighbouring values, with totals left and right of it."""
    values = _by_value(df, features, label)
    running = running_totals(
        values, ["value"], {"n_left": "n", "s_left": "s"}, ["feature"], ("next_value", "value")
    )
    whole = running.groupBy("feature").agg(
        F.max("n_left").alias("n_all"), F.max_by("s_left", "n_left").alias("s_all")
    )
    return (
        running.where(F.col("next_value").isNotNull())
        .join(whole, "feature")
        .select(
            "feature",
            ((F.col("value") + F.col("next_value")) / 2.0).alias("threshold"),
            F.col("n_all").cast("double").alias("n"),
            F.col("n_left").cast("double").alias("nl"),
            (F.col("n_all") - F.col("n_left")).cast("double").alias("nr"),
            F.col("s_all").cast("double").alias("s"),
            F.col("s_left").cast("double").alias("sl"),
            (F.col("s_all") - F.col("s_left")).cast("double").alias("sr"),
        )
    )


def _best(candidates: DataFrame, gain: Column, digits: int) -> DataFrame:
    """The largest gain per feature; equal rounded gains go to the lowest threshold."""
    best = F.max(F.struct(F.round(gain, digits).alias("gain"), (-F.col("threshold")).alias("t")))
    return candidates.groupBy("feature").agg(best.alias("b")).select(
        "feature", (-F.col("b.t")).alias("threshold"), F.col("b.gain").alias("gain")
    )


def _gini(n: Column, positives: Column) -> Column:
    p = positives / n
    return F.lit(2.0) * p * (F.lit(1.0) - p)


def gini_best_split(
    df: DataFrame, features: Sequence[str], label: str = "label", positive=1, digits: int = 9
) -> DataFrame:
    """(feature, threshold, gain): largest drop in gini impurity for a two-class label."""
    hit = F.when(F.col(label) == F.lit(positive), 1).otherwise(0).cast("bigint")
    n, nl, nr, s, sl, sr = [F.col(c) for c in ("n", "nl", "nr", "s", "sl", "sr")]
    gain = _gini(n, s) - (nl / n) * _gini(nl, sl) - (nr / n) * _gini(nr, sr)
    return _best(_candidates(df, features, hit), gain, digits)


def variance_best_split(
    df: DataFrame, features: Sequence[str], label: str = "label", digits: int = 2
) -> DataFrame:
    """(feature, threshold, gain): largest drop in label variance.

    The drop needs only counts and sums: the squares of the parts less that of the whole.
    """
    y = F.col(label).cast("double")
    n, nl, nr, s, sl, sr = [F.col(c) for c in ("n", "nl", "nr", "s", "sl", "sr")]
    gain = (sl * sl / nl + sr * sr / nr - s * s / n) / n
    return _best(_candidates(df, features, y), gain, digits)

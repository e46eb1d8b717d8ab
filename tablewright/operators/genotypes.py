"""Reshape long (sample, variant, alt_count) rows into sample vectors for clustering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.operators.clustering import assign_clusters
from tablewright.operators.components import sample_components
from tablewright.operators.ordering import dense_ids
from tablewright.workspace import materialize

#: Variants of one block of a sample's vector.
BLOCK_WIDTH = 65_535


def semi_join_panel(calls: DataFrame, samples: DataFrame) -> DataFrame:
    """Calls of the samples listed in ``samples``."""
    return calls.join(samples.select("sample"), "sample", "left_semi")


def sample_count(calls: DataFrame) -> DataFrame:
    return calls.agg(F.count_distinct("sample").alias("n"))


def variant_frequency(calls: DataFrame) -> DataFrame:
    """(variant, n_samples, n_carriers): distinct samples called, and those with an alternate."""
    carrier = F.when(F.col("alt_count") > 0, F.col("sample"))
    per_call = calls.select("variant", "sample", carrier.alias("carrier"))
    once = per_call.groupBy("variant", "sample").agg(F.max("carrier").alias("carrier"))
    return once.groupBy("variant").agg(
        F.count("sample").alias("n_samples"), F.count("carrier").alias("n_carriers")
    )


def complete_variants(calls: DataFrame, min_call_rate: float = 1.0) -> DataFrame:
    """Variants called in at least this share of all samples; repeated calls count once."""
    total: Column = sample_count(calls).scalar()
    frequency = variant_frequency(calls)
    return frequency.where(F.col("n_samples") >= F.lit(min_call_rate) * total)


def filter_by_frequency(calls: DataFrame, low: int, high: int) -> DataFrame:
    """Calls of fully called variants whose number of carriers lies in [low, high]."""
    kept = complete_variants(calls).where(F.col("n_carriers").between(low, high))
    return calls.join(kept.select("variant"), "variant", "left_semi")


def filter_by_share(calls: DataFrame, low: float, high: float) -> DataFrame:
    """Calls of fully called variants whose carriers are a share in [low, high] of the samples.

    A share means the same for any number of samples.
    """
    carriers, samples = F.col("n_carriers"), F.col("n_samples")
    kept = complete_variants(calls).where((carriers >= F.lit(low) * samples) & (carriers <= F.lit(high) * samples))
    return calls.join(kept.select("variant"), "variant", "left_semi")


def varying_calls(calls: DataFrame) -> DataFrame:
    """Calls of fully called variants whose counts differ between samples.

    A variant that some samples carry and others do not always stays; one that every sample
    carries stays if the counts differ.  This depends on no number of samples or calls.
    """
    once = calls.groupBy("variant", "sample").agg(F.max("alt_count").alias("alt_count"))
    kept = (
        once.groupBy("variant")
        .agg(F.count("sample").alias("n_samples"), F.min("alt_count").alias("least"), F.max("alt_count").alias("most"))
        .where((F.col("n_samples") == sample_count(calls).scalar()) & (F.col("least") < F.col("most")))
    )
    return calls.join(kept.select("variant"), "variant", "left_semi")


def variant_matrix(calls: DataFrame, variants: Sequence[str]) -> DataFrame:
    """One row per sample and one integer column per variant of a stated list.

    A variant outside the list fails the job instead of vanishing.
    """
    known = F.col("variant").isin(list(variants))
    unknown = F.raise_error(F.concat(F.lit("variant not in the header: "), F.col("variant")))
    checked = calls.withColumn("variant", F.when(known, F.col("variant")).otherwise(unknown.cast("string")))
    return checked.groupBy("sample").pivot("variant", list(variants)).agg(F.max("alt_count"))


def variant_header(calls: DataFrame, most: int) -> list[str]:
    """The variants of the table in order, for a matrix of at most ``most`` columns."""
    found = [r.variant for r in calls.select("variant").distinct().orderBy("variant").limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} variants: use variant_vectors")
    return found


def variant_vectors(calls: DataFrame, width: int = BLOCK_WIDTH) -> DataFrame:
    """(sample, block, counts): alternate counts in variant order, 0 where a call is missing.

    Every variant is numbered once for all samples.  Every sample has every block.  Block b holds the variants numbered
    from b * width on, so an array is never longer than ``width`` and a sample with more
    variants than that has several blocks.
    """
    numbers = materialize(dense_ids(calls, "variant", "position"), "variant-numbers")
    n_variants = numbers.agg(F.count("*").alias("n")).first().n
    if not n_variants:
        return calls.select("sample", F.lit(0).alias("block"), F.array(F.lit(0.0)).alias("counts")).limit(0)
    placed = (
        calls.join(numbers, "variant")
        .groupBy("sample", "position")
        .agg(F.max("alt_count").alias("alt_count"))
        .select(
            "sample",
            F.floor(F.col("position") / width).cast("int").alias("block"),
            F.pmod("position", F.lit(width)).alias("at"),
            F.col("alt_count").cast("double").alias("value"),
        )
    )
    calls_in_order = F.array_sort(F.collect_list(F.struct("at", "value")))
    blocks = placed.groupBy("sample", "block").agg(calls_in_order.alias("cells"))
    length = F.least(F.lit(width), F.lit(n_variants) - F.col("block") * width)

    def with_gap(cell: Column, i: Column) -> Column:
        before = F.coalesce(F.get("cells", i - 1)["at"], F.lit(-1))
        return F.concat(_zeros(cell["at"] - before - 1), F.array(cell["value"]))

    last = F.element_at("cells", -1)["at"]
    counts = F.concat(F.flatten(F.transform("cells", with_gap)), _zeros(length - 1 - last))
    filled = blocks.select("sample", "block", counts.alias("counts"))
    # A sample without any call in a block has zeros there.
    last_block = (n_variants - 1) // width
    every = calls.select("sample").distinct().withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(last_block))))
    return every.join(filled, ["sample", "block"], "left").select(
        "sample", "block", F.coalesce("counts", _zeros(length)).alias("counts")
    )


def _zeros(n: Column) -> Column:
    return F.array_repeat(F.lit(0.0), n.cast("int"))


def sample_points(
    calls: DataFrame, samples: DataFrame, low: float | None = None, high: float | None = None, components: int = 5
) -> DataFrame:
    """(sample, features): restrict, filter, build vectors, take the components.

    ``low`` and ``high`` are shares of carriers among the samples.  Without them, the variants
    whose counts differ between the samples are taken.  It is an error if no variant is left.
    Each reduced table is written once, so the calls are read and joined a single time.
    """
    panel_calls = materialize(semi_join_panel(calls, samples), "panel-calls")
    whole = low is None and high is None
    if not whole and (low is None or high is None):
        raise ValueError("a range of shares has two ends")
    chosen = varying_calls(panel_calls) if whole else filter_by_share(panel_calls, low, high)
    chosen = materialize(chosen, "chosen-calls")
    if chosen.isEmpty():
        what = "differs between the samples" if whole else f"has a share of carriers from {low} to {high}"
        raise ValueError(f"no fully called variant {what}")
    points = sample_components(materialize(variant_vectors(chosen), "sample-vectors"), components)
    return points.select("sample", array_to_vector("pcs").alias("features"))


def population_clusters(
    calls: DataFrame,
    samples: DataFrame,
    low: float | None = None,
    high: float | None = None,
    components: int = 5,
    k: int = 2,
) -> DataFrame:
    """(sample, prediction): the samples clustered on the components of their variants, which
    ``sample_points`` chooses."""
    points = sample_points(calls, samples, low, high, components)
    return assign_clusters(points, k).select("sample", "prediction")

"""Projections, filters, joins, aggregates and set operations."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

from tablewright.operators.ordering import running_totals


# --- column choice -----------------------------------------------------------


def all_but(df: DataFrame, *columns: str) -> DataFrame:
    """Every column except the named ones; the label is named, not taken by position."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.drop(*columns)


def matching_columns(
    df: DataFrame,
    include: str = ".*",
    exclude: str | None = None,
    string_prefix: str | None = None,
) -> list[Column]:
    """Columns whose whole name matches ``include`` and not ``exclude``.

    With ``string_prefix`` the string columns among them are renamed by that prefix,
    which is how indexed categorical columns are named.
    """
    chosen: list[Column] = []
    for field in df.schema.fields:
        if not re.fullmatch(include, field.name):
            continue
        if exclude and re.fullmatch(exclude, field.name):
            continue
        c = F.col(f"`{field.name}`")
        if string_prefix and isinstance(field.dataType, StringType):
            c = c.alias(string_prefix + field.name)
        chosen.append(c)
    return chosen


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


# --- nulls -------------------------------------------------------------------


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: how many of its values are null, in one pass."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n_null")) for c in df.columns
    ]
    return counts.select(F.inline(F.array(*cells)))


def drops_any_row(df: DataFrame) -> DataFrame:
    """Whether dropping rows with a null would change the table: counted, not compared."""
    any_null = F.lit(False)
    for c in df.columns:
        any_null = any_null | F.col(f"`{c}`").isNull()
    return df.agg(
        F.count("*").alias("n_rows"), F.coalesce(F.bool_or(any_null), F.lit(False)).alias("changes")
    )


# --- joins -------------------------------------------------------------------


def keyed_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join that refuses to run without keys.  Spark picks the strategy from real sizes."""
    if not on:
        raise ValueError("a join needs keys; small grids are built with complete_grid")
    return left.join(right, on, how)


def complete_grid(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every pairing of the rows of two dimensions: the feature itself is the full grid."""
    return left.crossJoin(right)


def lookup(
    df: DataFrame, dimension: DataFrame, on: str | list[str], column: str, default
) -> DataFrame:
    """Left join that fills ``default`` where the dimension has no entry.

    The dimension has one row per key, as ``read_panel`` gives it; repeated keys repeat rows.
    """
    joined = df.join(dimension, on, "left")
    return joined.withColumn(column, F.coalesce(column, F.lit(default)))


# --- grouped reports ---------------------------------------------------------


def group_sums(df: DataFrame, by: str, sums: dict[str, str], total: str | None = None) -> DataFrame:
    """Grouped sums (output name to column), with their total when ``total`` names it."""
    aggs = [F.sum(c).alias(out) for out, c in sums.items()]
    if total is not None:
        whole = F.sum(next(iter(sums.values())))
        for c in list(sums.values())[1:]:
            whole = whole + F.sum(c)
        aggs.append(whole.alias(total))
    return df.groupBy(by).agg(*aggs)


def top_k(df: DataFrame, k: int, *order_by: Column) -> DataFrame:
    """The first ``k`` rows in an order that decides every tie."""
    return df.orderBy(*order_by).limit(k)


def rating_stats_by_item(ratings: DataFrame, items: DataFrame, rsd: float | None = None) -> DataFrame:
    """Highest and lowest rating and number of raters per item, with its title.

    Ratings compare as numbers.  Distinct raters are exact unless ``rsd`` asks for an
    estimate with that relative error.
    """
    raters = F.approx_count_distinct("user_id", rsd) if rsd else F.count_distinct("user_id")
    rating = F.col("rating").try_cast("int")
    stats = ratings.groupBy("item_id").agg(
        F.max(rating).alias("max_rating"),
        F.min(rating).alias("min_rating"),
        raters.alias("n_users"),
    )
    return stats.join(items.select("item_id", "title"), "item_id").select(
        "item_id", "title", "max_rating", "min_rating", "n_users"
    )


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Typed profile, one row per column, from a single aggregate."""
    stats = {
        "n": lambda c: F.count(c),
        "mean": lambda c: F.avg(c),
        "stddev": lambda c: F.stddev_samp(c),
        "min": lambda c: F.min(c),
        "max": lambda c: F.max(c),
    }
    return _profile(df, columns, stats, "double")


def describe_strings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    stats = {"n": lambda c: F.count(c), "min": lambda c: F.min(c), "max": lambda c: F.max(c)}
    return _profile(df, columns, stats, "string")


def _profile(df: DataFrame, columns: Sequence[str], stats: dict, value_type: str) -> DataFrame:
    aggs = []
    for c in columns:
        value = F.col(f"`{c}`").cast(value_type)
        aggs += [make(value).alias(f"{c}__{stat}") for stat, make in stats.items()]
    cells = [
        F.struct(
            F.lit(c).alias("column"), *[F.col(f"`{c}__{stat}`").alias(stat) for stat in stats]
        )
        for c in columns
    ]
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_distinct) for several columns from one scan.

    The values are first made distinct under their column name, which spreads one hot
    value or one hot column over all tasks before anything is counted.
    """
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
        for c in columns
    ]
    values = df.select(F.inline(F.array(*cells))).distinct()
    return values.groupBy("column").agg(F.count("value").alias("n_distinct"))


# --- groups as lists ---------------------------------------------------------


def sort_groups(
    df: DataFrame, key: str, order_by: Sequence[str], value: Column, chunk_items: int = 50_000
) -> DataFrame:
    """(key, chunk, members): each group in order, cut into runs of bounded length.

    Reading the chunks of a key in turn gives the whole group in order.  Copies of a
    member are counted before anything is sorted and written out again per chunk, so
    neither a hot group nor a member with very many copies gathers in one task.
    """
    runs = df.groupBy(key, *order_by, value.alias("__v")).agg(F.count("*").alias("__n"))
    placed = running_totals(runs, [*order_by, "__v"], {"__end": "__n"}, [key])
    size = F.lit(chunk_items)
    start, end = F.col("__end") - F.col("__n"), F.col("__end")

    def chunk_of(position: Column) -> Column:
        return F.floor(position / size)

    pieces = placed.select(
        key, "__v", start.alias("__start"), "__end",
        F.explode(F.sequence(chunk_of(start), chunk_of(end - 1))).alias("chunk"),
    )
    copies = F.least(F.col("__end"), (F.col("chunk") + 1) * size) - F.greatest(
        F.col("__start"), F.col("chunk") * size
    )
    run = F.struct(F.col("__end"), F.col("__v").alias("v"), copies.cast("int").alias("copies"))
    in_order = F.array_sort(F.collect_list(run))
    members = F.flatten(F.transform(in_order, lambda r: F.array_repeat(r["v"], r["copies"])))
    return pieces.groupBy(key, F.col("chunk").cast("int").alias("chunk")).agg(members.alias("members"))


def collect_groups(df: DataFrame, key: str, value: Column, chunk_items: int = 50_000) -> DataFrame:
    """(key, chunk, members): the rows of each group as sorted arrays of bounded length."""
    return sort_groups(df, key, [], value, chunk_items)

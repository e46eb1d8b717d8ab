"""Running totals and ranks over whole tables without a one-task window.

A window with no partition key, or with a hot one, runs in a single task.  Here the
rows are range-sorted across the cluster and written once; each sorted partition is a
block.  Totals run inside blocks in parallel, and the short list of block totals gives
each block its starting value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablewright.workspace import materialize

ROW = "__row"
BLOCK = "__block"

# Fixed value: monotonically_increasing_id keeps the partition number above this bit.
PARTITION_SHIFT = 33


def sorted_blocks(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """Sort globally and pin each row's block and position by writing the result."""
    ordered = df.orderBy(*order_by).withColumn(ROW, F.monotonically_increasing_id())
    return materialize(ordered, "sorted").withColumn(BLOCK, F.shiftright(ROW, PARTITION_SHIFT))


def running_totals(
    df: DataFrame,
    order_by: Sequence[str | Column],
    totals: dict[str, str | Column],
    partition_by: Sequence[str] = (),
    next_value: tuple[str, str] | None = None,
) -> DataFrame:
    """Inclusive running sums of ``totals`` (output name to input) in ``order_by`` order.

    ``next_value`` (output name, input column) also carries the following row's value
    within the partition.  Equal keys must have been aggregated into one row beforehand.
    """
    groups = list(partition_by)
    inputs = {f"__in_{out}": c for out, c in totals.items()}
    for name, c in inputs.items():
        df = df.withColumn(name, F.col(c) if isinstance(c, str) else c)
    # Sorting takes descending keys too, so the group columns simply come first.
    blocks = sorted_blocks(df, [*groups, *order_by])

    within = Window.partitionBy(*groups, BLOCK).orderBy(ROW)
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    columns = {out: F.sum(f"__in_{out}").over(so_far) for out in totals}

    block_aggs = [F.sum(name).alias(name) for name in inputs]
    if next_value:
        block_aggs.append(F.min_by(next_value[1], ROW).alias("__first"))
        columns[next_value[0]] = F.lead(next_value[1]).over(within)
    per_block = blocks.groupBy(*groups, BLOCK).agg(*block_aggs)

    by_block = Window.partitionBy(*groups).orderBy(BLOCK)
    before = by_block.rowsBetween(Window.unboundedPreceding, -1)
    starts = per_block.select(
        *[F.col(g).alias(f"__g_{g}") for g in groups],
        F.col(BLOCK).alias("__b"),
        F.lag(F.lit(True)).over(by_block).alias("__continues"),
        F.lead(F.lit(True)).over(by_block).alias("__continued"),
        *[F.sum(name).over(before).alias(f"__start{name}") for name in inputs],
        *([F.lead("__first").over(by_block).alias("__next_first")] if next_value else []),
    ).where(F.col("__continues") | F.col("__continued"))
    # Rows are sorted by group first, so only a block's first and last group can reach
    # into another block: at most two rows per sorted partition remain, however many
    # groups there are, and sending them to every task spares the rows another shuffle.
    match = F.col(BLOCK) == F.col("__b")
    for g in groups:
        match = match & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    joined = blocks.withColumns(columns).join(F.broadcast(starts), match, "left")

    result: dict[str, Column] = {
        out: F.col(out) + F.coalesce(F.col(f"__start__in_{out}"), F.lit(0)) for out in totals
    }
    if next_value:
        result[next_value[0]] = F.coalesce(next_value[0], "__next_first")
    kept = [c for c in df.columns if c not in inputs]
    return joined.select(*kept, *[c.alias(name) for name, c in result.items()])


def ranked(
    df: DataFrame,
    order_by: Sequence[str | Column],
    partition_by: Sequence[str] = (),
    name: str = "rank",
) -> DataFrame:
    """Add the 1-based position of each row; ``order_by`` must decide every tie."""
    if not partition_by:
        return _numbered(df, order_by, name)
    return running_totals(df, order_by, {name: F.lit(1).cast("bigint")}, partition_by)


def _numbered(df: DataFrame, order_by: Sequence[str | Column], name: str) -> DataFrame:
    """Positions over the whole table: rows before the block, plus the place inside it.

    Only the block sizes are added up, one per sorted partition; no row is shuffled again.
    """
    blocks = sorted_blocks(df, order_by)
    sizes = blocks.groupBy(BLOCK).agg(F.count("*").alias("__size"))
    before = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col(BLOCK), F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start")
    )
    inside = F.col(ROW) - F.shiftleft(F.col(BLOCK), PARTITION_SHIFT)
    placed = blocks.join(F.broadcast(starts), BLOCK)
    return placed.select(*df.columns, (F.col("__start") + inside + 1).alias(name))


def dense_ids(df: DataFrame, key: str, name: str = "id") -> DataFrame:
    """(key, id): consecutive integers from 0 for the distinct keys, in key order."""
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    return ranked(keys, [key], name="__rank").select(
        key, (F.col("__rank") - 1).cast("int").alias(name)
    )

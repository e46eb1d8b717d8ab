"""Connected components of large graphs by alternating stars, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablewright.workspace import materialize

MOST_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node it knows."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b")
    return moved.select(F.col("m").alias("a"), F.col("a").alias("b")).unionByName(
        moved.select(F.col("m").alias("a"), "b")
    ).where("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); a component is named by its smallest
    node.  Each round is written out, so lineage stays short and a lost executor costs a round."""
    current = materialize(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges"
    )
    before = None
    for _ in range(MOST_ROUNDS):
        current = materialize(_small_star(_large_star(current)).distinct(), "stars")
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return current.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(roots)

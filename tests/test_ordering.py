from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import ordering, relational


def _hot_rows(n: int = 600) -> list[tuple[str | None, int, int]]:
    """A third of the rows share one group; one group has no name."""
    rows = []
    for i in range(n):
        group = "hot" if i % 3 == 0 else None if i % 7 == 0 else f"g{i % 11}"
        rows.append((group, (i * 37) % 1009, i % 13 - 5))
    return rows


def test_running_totals_match_brute_force(spark, many_blocks):
    rows = _hot_rows()
    df = spark.createDataFrame(rows, "g string, k int, v int")
    out = ordering.running_totals(
        df, ["k"], {"s": "v", "c": F.lit(1)}, ["g"], next_value=("nk", "k")
    ).collect()
    assert len(out) == len(rows)
    for r in out:
        upto = [v for g, k, v in rows if g == r.g and k <= r.k]
        later = [k for g, k, _ in rows if g == r.g and k > r.k]
        assert (r.s, r.c, r.nk) == (sum(upto), len(upto), min(later, default=None))


def test_sorting_used_several_blocks(spark, many_blocks):
    df = spark.createDataFrame(_hot_rows(), "g string, k int, v int")
    assert ordering.sorted_blocks(df, ["k"]).select(ordering.BLOCK).distinct().count() > 1


def test_descending_totals_without_groups(spark, many_blocks):
    df = spark.range(1, 501).withColumn("v", F.col("id"))
    out = {r.id: r.s for r in ordering.running_totals(df, [F.desc("id")], {"s": "v"}).collect()}
    assert out == {i: sum(range(i, 501)) for i in range(1, 501)}


def test_ranks_are_a_permutation(spark, many_blocks):
    df = spark.range(0, 1000).select(((F.col("id") * 7919) % 1000).alias("k"))
    out = {r.k: r["rank"] for r in ordering.ranked(df, ["k"]).collect()}
    assert out == {k: k + 1 for k in range(1000)}


def test_dense_ids_follow_key_order(spark, many_blocks):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",)], "k string")
    assert {(r.k, r.id) for r in ordering.dense_ids(df, "k").collect()} == {("a", 0), ("b", 1), ("c", 2)}


def test_sorted_groups_in_chunks(spark, many_blocks):
    rows = [(("hot" if i % 3 == 0 else f"g{i % 4}"), i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, k int").repartition(7)
    out = relational.sort_groups(df, "g", ["k"], F.col("k"), chunk_items=10).collect()
    assert max(len(r.members) for r in out) <= 10
    for g in {g for g, _ in rows}:
        chunks = sorted((r.chunk, r.members) for r in out if r.g == g)
        assert [k for _, m in chunks for k in m] == sorted(k for h, k in rows if h == g)


def test_copies_of_one_member_are_spread(spark, many_blocks):
    rows = [("hot", 7)] * 500 + [("hot", k) for k in range(20)] + [("g", 1)] * 3
    df = spark.createDataFrame(rows, "g string, k int").repartition(6)
    out = relational.sort_groups(df, "g", ["k"], F.col("k"), chunk_items=16).collect()
    assert max(len(r.members) for r in out) <= 16
    for g in ("hot", "g"):
        chunks = sorted((r.chunk, r.members) for r in out if r.g == g)
        assert [k for _, m in chunks for k in m] == sorted(k for h, k in rows if h == g)


def test_collected_groups_are_whole_and_bounded(spark):
    rows = [(("hot" if i % 3 == 0 else None if i % 5 == 0 else f"g{i % 4}"), f"i{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, k string")
    out = relational.collect_groups(df, "g", F.col("k"), chunk_items=100).collect()
    assert max(len(r.members) for r in out) <= 100
    for g in {g for g, _ in rows}:
        members = [k for r in out if r.g == g for k in r.members]
        assert sorted(members) == sorted(k for h, k in rows if h == g)

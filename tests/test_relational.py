from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tablewright.functions import scalars
from tablewright.operators import relational


@pytest.fixture(scope="module")
def gaps(spark):
    return spark.createDataFrame([(1, "a", 2.0), (2, None, 3.0), (3, "b", None), (4, None, 5.0)], "k int, s string, x double")


def test_null_profile(gaps):
    assert {r["column"]: r.n_null for r in relational.null_profile(gaps).collect()} == {"k": 0, "s": 2, "x": 1}
    assert relational.drops_any_row(gaps).first().changes is True
    assert relational.drops_any_row(gaps.na.drop()).first().changes is False
    assert relational.drops_any_row(gaps.where("k > 9")).first().asDict() == {"n_rows": 0, "changes": False}


def test_column_choice(gaps):
    assert relational.all_but(gaps, "x").columns == ["k", "s"]
    with pytest.raises(ValueError):
        relational.all_but(gaps, "nope")
    assert gaps.select(relational.matching_columns(gaps, exclude="k|label", string_prefix="idx_")).columns == ["idx_s", "x"]


def test_joins_need_keys(gaps):
    with pytest.raises(ValueError):
        relational.keyed_join(gaps, gaps, [])


def test_grid_pairs_every_row(spark):
    a, b = spark.range(30), spark.range(1200).withColumnRenamed("id", "j")
    assert relational.complete_grid(a, b).distinct().count() == 36_000


def test_lookup_default(spark, gaps):
    names = spark.createDataFrame([(1, "one")], "k int, name string")
    got = {r.k: r.name for r in relational.lookup(gaps.select("k"), names, "k", "name", "Unknown").collect()}
    assert got == {1: "one", 2: "Unknown", 3: "Unknown", 4: "Unknown"}


def test_group_sums_with_total(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 4.0), ("b", 5.0, 6.0)], "g string, x double, y double")
    got = {r.g: r.t for r in relational.group_sums(df, "g", {"sx": "x", "sy": "y"}, "t").collect()}
    assert got == {"a": 10.0, "b": 11.0}


def test_profiles(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (4, None)], "x int, s string")
    r = relational.describe_numeric(df, ["x"]).first()
    assert (r.n, r["min"], r["max"]) == (3, 1.0, 4.0) and r.stddev == pytest.approx(1.5275252)
    assert tuple(relational.describe_strings(df, ["s"]).first()) == ("s", 2, "a", "b")


def test_distinct_counts_ignore_nulls(gaps):
    assert {r["column"]: r.n_distinct for r in relational.distinct_counts(gaps, ["k", "s"]).collect()} == {"k": 4, "s": 2}


def test_approximate_raters(spark):
    rows = [("i", str(u), "5") for u in range(5000)]
    ratings = spark.createDataFrame([(u, i, r) for i, u, r in rows], "user_id string, item_id string, rating string")
    items = spark.createDataFrame([("i", "t")], "item_id string, title string")
    exact = relational.rating_stats_by_item(ratings, items).first()
    rough = relational.rating_stats_by_item(ratings, items, rsd=0.02).first()
    assert exact.n_users == 5000 and rough.n_users == pytest.approx(5000, rel=0.1)


def test_scalars(spark):
    df = spark.createDataFrame([(-2147483648, "9", ["REF", "ALT", "NO_CALL"]), (5, "x", [])], "n int, s string, a array<string>")
    got = df.select(
        scalars.non_negative_hash("s", 100).alias("h"), scalars.to_type("s", "int").alias("i"),
        scalars.alternate_count("a").alias("c"), scalars.string_key("n", "s").alias("k"),
        scalars.ratio(F.lit(1.0), F.lit(0.0)).alias("r"), scalars.rounded(F.lit(-0.0000001)).alias("z"),
    ).collect()
    assert all(0 <= r.h < 100 for r in got)
    assert [r.i for r in got] == [9, None] and [r.c for r in got] == [2, 0]
    assert got[0].k == "-2147483648:9" and got[0].r is None and str(got[0].z) == "0.0"


def test_sql_text_over_registered_views(spark, small):
    """The reports as SQL text give the rows of the registered queries."""
    from tablewright.plans import views
    from tablewright.plans.catalog import QUERIES

    views.register(spark, small)
    stats = spark.sql(
        """WITH profile AS (SELECT item_id, max(INT(rating)) AS max_rating, min(INT(rating)) AS min_rating,
                                   count(DISTINCT user_id) AS n_users
                            FROM ratings GROUP BY item_id)
           SELECT item_id, title, max_rating, min_rating, n_users
           FROM profile JOIN items USING (item_id) ORDER BY n_users DESC, item_id"""
    )
    assert stats.collect() == QUERIES["rating_stats_by_item"](spark, small).collect()
    assert spark.sql("SELECT max(rating) AS m FROM ratings").first().m == "9"
    top = spark.sql("SELECT user_id, count(*) AS n FROM ratings GROUP BY user_id ORDER BY n DESC, user_id LIMIT 10")
    assert top.collect() == QUERIES["most_active_users"](spark, small).collect()
    total = spark.sql("SELECT churn, sum(n_urgent) AS s FROM customer_account GROUP BY churn").collect()
    assert sorted(map(tuple, total)) == sorted(map(tuple, QUERIES["group_sum"](spark, small).collect()))

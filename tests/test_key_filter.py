from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tablewright.operators import key_filter
from tablewright.operators.key_filter import filter_size, filter_words, filtered_semi_join, may_hold


@pytest.fixture
def calls(spark):
    # Every third row stands twice; some keys are null.
    rows = spark.range(6000).select(
        F.when(F.col("id") % 50 != 0, F.concat(F.lit("s"), F.col("id") % 2000)).alias("sample"), (F.col("id") % 7).alias("site"), "id"
    )
    return rows.unionAll(rows.where("id % 3 = 0"))


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("most_bits", [key_filter.MOST_BITS, 64, 0])
def test_rows_are_those_of_a_plain_semi_join(spark, calls, monkeypatch, most_bits):
    monkeypatch.setattr(key_filter, "MOST_BITS", most_bits)
    panel = spark.range(0, 400, 3).select(F.concat(F.lit("s"), F.col("id")).alias("sample"))
    panel = panel.unionAll(panel).unionAll(spark.createDataFrame([(None,), ("nobody",)], "sample string"))
    want = calls.join(panel, "sample", "left_semi")
    assert _rows(filtered_semi_join(calls, panel, ["sample"])) == _rows(want)


def test_several_key_columns(spark, calls):
    panel = spark.createDataFrame([("s1", 1), ("s2", 2), ("s3", 0), (None, 1)], "sample string, site long")
    want = calls.join(panel, ["sample", "site"], "left_semi")
    assert _rows(filtered_semi_join(calls, panel, ["sample", "site"])) == _rows(want)


def test_few_other_rows_pass(spark):
    keys = spark.range(5000).select((F.col("id") * 1_000_003).alias("k"))
    size = filter_size(5000)
    words = filter_words(keys, *size)
    assert len(words.first().words) * 64 == size[0]
    tested = spark.range(200_000).select((F.col("id") * 1_000_003).alias("k")).where(may_hold(words.scalar(), ["k"], *size))
    passed = tested.count()
    assert tested.where(F.col("k") < 5000 * 1_000_003).count() == 5000
    assert passed - 5000 < 0.02 * 195_000


def test_sizes():
    assert filter_size(0) is None and filter_size(1) == (64, 7)
    bits, hashes = filter_size(1_000_000)
    assert bits == 2**24 and hashes == 7
    assert filter_size(10_000_000) == (2**26, 5)
    assert filter_size(2**26) is None


def test_empty_sides_and_other_types(spark, calls):
    none = spark.createDataFrame([], "sample string")
    assert filtered_semi_join(calls, none, ["sample"]).count() == 0
    assert filtered_semi_join(calls.limit(0), spark.createDataFrame([("s1",)], "sample string"), ["sample"]).count() == 0
    with pytest.raises(ValueError, match="types"):
        filtered_semi_join(calls, spark.createDataFrame([(1,)], "id int"), ["id"])

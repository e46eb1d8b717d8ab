from __future__ import annotations

import hashlib
from collections import Counter

import pytest

from tablewright.operators.fingerprints import differing_buckets, table_fingerprint

ROWS = [(1, "a"), (1, "a"), (2, None), (None, ""), (None, None), (12, "3:x")]
TYPES = "k int, s string"


def text(row):
    return "".join("n" if v is None else f"{len(str(v))}:{v}" for v in row)


def test_equals_digests_by_hand(spark):
    want: dict[int, list[int]] = {}
    for row in ROWS:
        m = hashlib.md5(text(row).encode()).hexdigest()
        parts = [int(m[i : i + 8], 16) for i in range(0, 32, 8)]
        at = want.setdefault(parts[0] % 4, [0, 0, 0, 0])
        for i, x in enumerate([1, *parts[1:]]):
            at[i] += x
    got = {r.bucket: [r.n_rows, int(r.sum_a), int(r.sum_b), int(r.sum_c)] for r in table_fingerprint(spark.createDataFrame(ROWS, TYPES), 4).collect()}
    assert got == want


def test_order_of_rows_and_columns_does_not_matter(spark):
    left = spark.createDataFrame(ROWS, TYPES)
    right = spark.createDataFrame([r[::-1] for r in ROWS[::-1]], "s string, k int").repartition(5)
    assert differing_buckets(left, right).count() == 0


@pytest.mark.parametrize("other", [ROWS[1:], ROWS + ROWS[:1], ROWS[:2] + [(2, "")] + ROWS[3:], []])
def test_differing_rows_are_found_in_their_buckets(spark, other):
    found = differing_buckets(spark.createDataFrame(ROWS, TYPES), spark.createDataFrame(other, TYPES), 64)
    a, b = Counter(ROWS), Counter(other)
    changed = [*(a - b), *(b - a)]
    want = {int(hashlib.md5(text(r).encode()).hexdigest()[:8], 16) % 64 for r in changed}
    assert {r.bucket for r in found.collect()} == want


def test_nested_values_and_clashing_names(spark):
    types = "`a.b` array<int>, m map<string,int>, s struct<x:int,y:string>, z binary, side int"
    rows = [([1, None], {"p": 1, "q": 2}, (1, None), b"\x00", 1), (None, None, None, None, None)]
    again = [([1, None], {"q": 2, "p": 1}, (1, None), b"\x00", 1), (None, None, None, None, None)]
    left = spark.createDataFrame(rows, types)
    assert differing_buckets(left, spark.createDataFrame(again, types)).count() == 0
    assert differing_buckets(left, left.limit(0)).selectExpr("sum(n_left)").first()[0] == 2


def test_other_columns_are_refused_and_empty_tables_have_no_buckets(spark):
    empty = spark.createDataFrame([], TYPES)
    assert table_fingerprint(empty).count() == 0 and differing_buckets(empty, empty).count() == 0
    with pytest.raises(ValueError, match="columns differ"):
        differing_buckets(empty, spark.createDataFrame([], "k bigint, s string"))

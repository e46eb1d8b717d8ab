"""Every registered query on the small tables: equal to its SQL, or at least non-empty."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.harness import SAME_TYPE, compare

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def test_every_statement_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, small, duck, name):
    assert compare(QUERIES[name](spark, small), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, small, name):
    df = QUERIES[name](spark, small)
    assert set(dict(df.dtypes).values()) <= set(SAME_TYPE)
    assert df.count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["item_id", "title", "max_rating", "min_rating", "n_users"]
    assert df.count() > 0

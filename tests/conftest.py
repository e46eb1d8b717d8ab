from __future__ import annotations

import os

import pytest

from tests.harness import local_session, tables_in_duckdb

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def duck():
    return tables_in_duckdb(SMALL)


@pytest.fixture
def many_blocks(spark):
    """Keep sorted partitions apart, so that small data has several blocks too."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)

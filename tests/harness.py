"""Session, SQL engine and row comparison shared by the tests and the check tool."""

from __future__ import annotations

import math
import os

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark type name -> the DuckDB type it must be stated as.
SAME_TYPE = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def local_session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tables_in_duckdb(folder: str) -> duckdb.DuckDBPyConnection:
    duck = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return duck


def _key(row: tuple) -> tuple:
    return tuple("" if v is None else repr(v) for v in row)


def _plain(v):
    return None if isinstance(v, float) and math.isnan(v) else v


def compare(df: DataFrame, duck: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between the two results, or None when nothing does."""
    names = sorted(df.columns)
    types = dict(df.dtypes)
    got = sorted((tuple(_plain(r[n]) for n in names) for r in df.collect()), key=_key)
    result = duck.execute(sql)
    columns = [(c[0], str(c[1])) for c in result.description]
    position = {n: i for i, (n, _) in enumerate(columns)}
    if sorted(position) != names:
        return f"columns {names} against {sorted(position)}"
    for n, t in columns:
        if SAME_TYPE.get(types[n]) != t:
            return f"type of {n}: {types[n]} against {t}"
    want = sorted((tuple(_plain(r[position[n]]) for n in names) for r in result.fetchall()), key=_key)
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"row {g} against {w} in {names}"
    return None

"""Shared scratch folder: written tables that cut lineage and outlive lost executors.

The folder is the one the cluster names in ``spark.checkpoint.dir``.  Only a local
session that names none gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from math import ceil, sqrt

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

#: Rows that fill the one partition of a small table that fits pass over many times.
PARTITION_ROWS = 2_500

_local_root: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """Folder, visible to every executor, under which this application writes."""
    return f"{_base(spark)}/tablewright-{spark.conf.get('spark.app.id', 'session')}"


def lasting_path(spark: SparkSession, name: str) -> str:
    """A folder of this name that a later application finds again."""
    return f"{_base(spark)}/tablewright-{name}"


def _base(spark: SparkSession) -> str:
    base = spark.conf.get(CHECKPOINT_KEY, None)
    return (_local_scratch(spark) if base is None else base).rstrip("/")


def _local_scratch(spark: SparkSession) -> str:
    global _local_root
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tablewright-")
    return _local_root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nothing has been written to yet."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def kept(
    df: DataFrame, spread_by: list[str] | None = None, n_rows: int | None = None, partition_rows: int = PARTITION_ROWS
) -> Iterator[DataFrame]:
    """``df`` held in memory and on disk while a fit passes over it several times.

    Nothing depends on the stored copy: a share lost with its executor is computed again.
    With ``spread_by``, a unique key, rows are laid out by that key in as many partitions as
    their number asks for, ``n_rows`` or else counted, and sorted inside them, before the one copy
    is stored.  Fits that draw by position then see the same layout whatever the cores and the
    session, and the many passes over a small table are not spread over a whole cluster.  The
    partitions and the rows of each grow alike: 1 for 2,500 rows, or ``partition_rows``, 20 for a million.
    """
    if spread_by:
        df = laid_out(df, spread_by, n_rows, partition_rows)
    stored = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield stored
    finally:
        stored.unpersist()


def laid_out(
    df: DataFrame,
    spread_by: list[str],
    n_rows: int | None = None,
    partition_rows: int = PARTITION_ROWS,
    then_by: Sequence[str] = (),
) -> DataFrame:
    """``df`` dealt by key as ``kept`` stores it.  Where several rows have one key, ``then_by`` names
    the columns that order them; otherwise their order is that of their arrival."""
    # Only the keys are read to count.
    n_rows = df.select(*spread_by).count() if n_rows is None else n_rows
    width = max(1, ceil(sqrt(n_rows / partition_rows)))
    return df.repartition(width, *spread_by).sortWithinPartitions(*spread_by, *then_by)


def fits_at_once(stored: DataFrame) -> int:
    """Fits to run side by side on a stored table: more where one fit's tasks are few."""
    return max(4, 16 // stored.rdd.getNumPartitions())


@contextmanager
def named_cache(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` under a name that SQL text can use, kept in memory and on disk until the block ends.

    Results that outlive the block are to be written inside it.
    """
    spark = df.sparkSession
    df.createOrReplaceTempView(name)
    spark.catalog.cacheTable(name, StorageLevel.MEMORY_AND_DISK)
    try:
        yield spark.table(name)
    finally:
        spark.catalog.uncacheTable(name)
        spark.catalog.dropTempView(name)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet in the scratch folder and read it back.

    Later stages then start from files, so values that depend on how the data was
    partitioned (row positions, sampled range bounds) can never be drawn again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

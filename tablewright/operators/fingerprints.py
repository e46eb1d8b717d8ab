"""Whether two tables hold the same rows, without sorting or joining them.

Every row falls into a bucket by its digest; a bucket is summed up as its number of rows and
three sums of other parts of the digests.  The sums do not depend on the order of rows, and
repeated rows count as often as they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StructField, StructType

BUCKETS = 64
# Fixed value: hexadecimal digits of one part of a digest; an md5 has four parts.
PART_DIGITS = 8
SUMS = ("sum_a", "sum_b", "sum_c")


def _text(field: StructField) -> Column:
    c = F.col("`" + field.name.replace("`", "``") + "`")
    if isinstance(field.dataType, MapType):
        c = F.array_sort(F.map_entries(c))
    if isinstance(field.dataType, (ArrayType, MapType, StructType)):
        return F.to_json(c, {"ignoreNullFields": "false"})
    return F.hex(c) if isinstance(field.dataType, BinaryType) else c.cast("string")


def row_text(df: DataFrame) -> Column:
    """All columns by name as one text: each value behind its length, a null as a bare sign, so
    that no two different rows share a text."""
    texts = [_text(f) for f in sorted(df.schema.fields, key=lambda f: f.name)]
    return F.concat(
        F.lit(""), *[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("n")) for t in texts]
    )


def _digests(df: DataFrame, buckets: int) -> DataFrame:
    """(bucket, sum_a, sum_b, sum_c) of each row; sums are decimals, which no table overflows."""
    digest = df.select(F.md5(row_text(df).cast("binary")).alias("digest"))

    def part(i: int) -> Column:
        return F.conv(F.substring("digest", PART_DIGITS * i + 1, PART_DIGITS), 16, 10)

    return digest.select(
        F.pmod(part(0).cast("bigint"), F.lit(buckets)).cast("int").alias("bucket"),
        *[part(i).cast("decimal(10,0)").alias(name) for i, name in enumerate(SUMS, 1)],
    )


def table_fingerprint(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n_rows, sum_a, sum_b, sum_c as text): a row per bucket that has rows.

    One pass; a task sends at most ``buckets`` rows, whatever the skew.  An empty table has none.
    """
    return _digests(df, buckets).groupBy("bucket").agg(
        F.count("*").alias("n_rows"), *[F.sum(s).cast("string").alias(s) for s in SUMS]
    )


def differing_buckets(left: DataFrame, right: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n_left, n_right) of the buckets in which the tables differ; none if they are equal.

    Tables are equal when every row occurs equally often in both.  One pass over each side.
    Columns are matched by name; their names and types must be the same.
    """
    types = [sorted((f.name, f.dataType.simpleString()) for f in df.schema.fields) for df in (left, right)]
    if types[0] != types[1]:
        raise ValueError(f"columns differ: {types[0]} against {types[1]}")
    sides = _digests(left, buckets).withColumn("side", F.lit(1)).unionAll(
        _digests(right, buckets).withColumn("side", F.lit(-1))
    )
    both = sides.groupBy("bucket").agg(
        F.count_if(F.col("side") == 1).alias("n_left"),
        F.count_if(F.col("side") == -1).alias("n_right"),
        *[F.sum(F.col("side") * F.col(s)).alias(s) for s in SUMS],
    )
    same = F.col("n_left") == F.col("n_right")
    for s in SUMS:
        same = same & (F.col(s) == 0)
    return both.where(~same).select("bucket", "n_left", "n_right")

"""Scalar column expressions, all evaluated inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType

# Fixed value: the first eight hexadecimal digits of an md5 span this many integers.
MD5_PREFIX_SPAN = 4294967296.0

# Fixed value: the allele name that does not count as an alternate.
REFERENCE_ALLELE = "REF"


def column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def md5_prefix(text: Column) -> Column:
    """The first 32 bits of the md5 of ``text`` as a non-negative bigint."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def unit_hash(keys: list[str | Column], seed: int, purpose: str) -> Column:
    """A repeatable number in [0, 1) for each key: the same on any partitioning.

    Each ``purpose`` draws its own numbers, so a fold number says nothing about the
    split or sample a row was drawn into even when all of them use one seed.
    """
    parts = [column(k).cast("string") for k in keys]
    return md5_prefix(F.concat_ws(":", F.lit(f"{seed}:{purpose}"), *parts)) / F.lit(MD5_PREFIX_SPAN)


def string_key(*parts: str | Column) -> Column:
    """Join the parts of a composite key with ':'."""
    return F.concat_ws(":", *[column(p).cast("string") for p in parts])


def non_negative_hash(c: str | Column, buckets: int = 2147483647) -> Column:
    """Murmur3 of ``c`` folded into [0, buckets); ``abs`` would overflow on the least int."""
    return F.pmod(F.hash(column(c)), F.lit(buckets)).cast("int")


def alternate_count(alleles: str | Column) -> Column:
    """How many entries of an allele list differ from the reference allele."""
    return F.size(F.filter(column(alleles), lambda a: a != F.lit(REFERENCE_ALLELE)))


def to_type(c: str | Column, data_type: str | DataType) -> Column:
    """Cast that turns malformed text into null instead of failing the job."""
    return column(c).try_cast(data_type)


def ratio(num: Column, den: Column) -> Column:
    """Division that gives null on a zero denominator."""
    return num / F.nullif(den, F.lit(0.0))


def rounded(c: str | Column, digits: int = 6) -> Column:
    """Round a double and turn -0.0 into 0.0."""
    return F.round(column(c).cast("double"), digits) + F.lit(0.0)

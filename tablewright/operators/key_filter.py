"""Semi-join against a large list of keys, thinned out in the scan by a Bloom filter.

The filter is sized from the measured number of keys, built as an aggregate of 64-bit words and
tested with built-in bit functions right after the scan.  What passes meets the exact join, so
the rows are those of a plain semi-join; only fewer of them are shuffled.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.workspace import materialize

BITS_A_KEY = 10
MOST_HASHES = 7
#: The filter travels to every executor: 8 MB at most.
MOST_BITS = 2**26
#: With fewer bits for a key too many other rows would pass; the exact join then works alone.
LEAST_BITS_A_KEY = 4


def filter_size(n_keys: int) -> tuple[int, int] | None:
    """(bits, hashes) for so many keys; None where a filter within MOST_BITS would not help."""
    if not n_keys or n_keys * LEAST_BITS_A_KEY > MOST_BITS:
        return None
    bits = min(MOST_BITS, max(64, 2 ** math.ceil(math.log2(n_keys * BITS_A_KEY))))
    return bits, max(1, min(MOST_HASHES, round(bits / n_keys * math.log(2))))


def _positions(columns: list[str], bits: int, hashes: int) -> list[Column]:
    """Bits of a key: two hashes give all positions, taken modulo first so that no sum overflows."""
    first = F.pmod(F.xxhash64(*columns), F.lit(bits))
    step = F.pmod(F.xxhash64(*columns, F.lit(1)), F.lit(bits))
    return [F.pmod(first + i * step, F.lit(bits)) for i in range(hashes)]


def filter_words(keys: DataFrame, bits: int, hashes: int) -> DataFrame:
    """One row with ``words``, the filter as an array of longs.  Tasks send each word once at most."""
    positions = keys.select(F.explode(F.array(*_positions(keys.columns, bits, hashes))).alias("p"))
    words = positions.select(
        F.expr("p div 64").alias("id"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("bit")
    )
    filled = words.groupBy("id").agg(F.bit_or("bit").alias("word"))
    every = keys.sparkSession.range(bits // 64).join(filled, "id", "left")
    ordered = F.array_sort(F.collect_list(F.struct("id", F.coalesce("word", F.lit(0)).alias("word"))))
    return every.agg(F.transform(ordered, lambda x: x["word"]).alias("words"))


def may_hold(words: Column, columns: list[str], bits: int, hashes: int) -> Column:
    """Whether a row's key may be among those of the filter; true for every key that is."""
    tests = [
        F.getbit(F.get(words, F.floor(p / 64).cast("int")), (p % 64).cast("int")) == 1
        for p in _positions(columns, bits, hashes)
    ]
    return reduce(and_, tests)


def filtered_semi_join(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The rows of ``df`` whose columns ``on`` are among the rows of ``keys``, all columns.

    Keys may repeat and number any; types of the key columns must agree.  A key with a null
    matches nothing.  Rows of ``df`` that repeat all stay.
    """
    types = [[dict(side.dtypes)[c] for c in on] for side in (df, keys)]
    if types[0] != types[1]:
        raise ValueError(f"types of the keys differ: {types[0]} against {types[1]}")
    distinct = materialize(keys.select(*on).dropna().distinct(), "keys")
    size = filter_size(distinct.count())
    passed = df if size is None else df.where(may_hold(filter_words(distinct, *size).scalar(), on, *size))
    return passed.join(distinct, on, "left_semi")

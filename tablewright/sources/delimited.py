"""Delimited text in and out, literal rows, wide numeric files."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, NumericType, StructType


def read_delimited(
    spark: SparkSession,
    path: str,
    *,
    header: bool,
    sep: str = ",",
    schema: StructType | str | None = None,
    infer: bool = False,
    max_columns: int | None = None,
) -> DataFrame:
    """Scan delimited text.

    With ``schema`` the file is read once under declared types.  ``infer`` costs one
    more pass to pick int, double or string per column.  With neither, every column
    is a string.  Whether the files carry a header line is always stated.
    """
    if schema is not None and infer:
        raise ValueError("give a schema or ask for inference, not both")
    reader = spark.read.option("header", header).option("sep", sep)
    if max_columns is not None:
        reader = reader.option("maxColumns", max_columns)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer)
    return reader.csv(path)


def write_delimited(
    df: DataFrame, path: str, *, header: bool, sep: str = ",", single_file: bool = False
) -> str:
    """Write delimited text, one file per partition unless ``single_file`` is asked for.

    ``single_file`` sends every row through one task, so it is for small exports.
    """
    out = df.coalesce(1) if single_file else df
    out.write.option("header", header).option("sep", sep).csv(path)
    return path


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """A few rows stated in the program as a table."""
    return spark.createDataFrame(list(rows), schema)


def spread_array(df: DataFrame, array: str, width: int, prefix: str) -> DataFrame:
    """Turn an array column into ``width`` columns named ``prefix0`` onwards."""
    kept = [c for c in df.columns if c != array]
    return df.select(*kept, *[F.col(array)[i].alias(f"{prefix}{i}") for i in range(width)])


def fold_numeric(df: DataFrame, keep: Sequence[str], name: str = "features") -> DataFrame:
    """Gather every numeric column outside ``keep`` into one array<double> column.

    A file with tens of thousands of columns is unwieldy as a wide row; as one array
    the plan stays a few columns wide however many features the file has.
    """
    numeric: list[Column] = [
        F.col(f"`{f.name}`").cast(DoubleType())
        for f in df.schema.fields
        if isinstance(f.dataType, NumericType) and f.name not in keep
    ]
    return df.select(*keep, F.array(*numeric).alias(name))


def read_wide_numeric(
    spark: SparkSession, path: str, keep: Sequence[str], *, sep: str = ",", name: str = "features"
) -> DataFrame:
    """Scan a wide numeric file straight into ``keep`` (strings) and one array<double>.

    The header line, the same in all files, is read once; each record is split on the
    executors in a single pass, so neither the plan nor an inference grows with the columns.
    A field may stand in quotes, with quotes inside it doubled, but not span lines.  What is
    no number is null, as are fields that a short record lacks; a long record's rest is left out.
    """
    lines = spark.read.text(path)
    first = lines.where((F.col("_metadata.file_block_start") == 0) & (F.col("value") != "")).first()
    if first is None:
        raise ValueError(f"{path} has no header line")
    names = next(csv.reader([first.value], delimiter=sep))
    kept = {k: names.index(k) for k in keep}
    quoted, plain = '"(?:[^"]++|"")*+"', f"[^{re.escape(sep)}]*+"
    # A separator in front makes every field, also an empty first one, a match of some length.
    field = f"{re.escape(sep)}({quoted}|{plain})"
    records = lines.where(~F.col("value").isin(first.value, "")).select(
        F.regexp_extract_all(F.concat(F.lit(sep), "value"), F.lit(field), 1).alias("fields")
    )

    def bare(c: Column) -> Column:
        inner = F.replace(c.substr(F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
        return F.when(c.startswith('"') & c.endswith('"') & (F.length(c) >= 2), inner).otherwise(c)

    def value(c: Column) -> Column:
        return bare(c).try_cast(DoubleType())

    width = len(names) - len(kept)
    others = F.filter("fields", lambda x, i: ~i.isin(list(kept.values()))) if kept else F.col("fields")
    padded = F.concat(F.transform(others, value), F.array_repeat(F.lit(None).cast(DoubleType()), width))
    return records.select(
        *[F.nullif(bare(F.get("fields", F.lit(i))), F.lit("")).alias(k) for k, i in kept.items()],
        F.slice(padded, 1, width).alias(name),
    )

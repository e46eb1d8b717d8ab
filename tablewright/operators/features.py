"""Feature assembly, label indexing, dimensionality reduction, covariance."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, PCAModel, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from tablewright.operators.ordering import ranked
from tablewright.operators.relational import distinct_counts, string_columns


def assemble(df: DataFrame, inputs: Sequence[str], output: str = "features") -> DataFrame:
    """Add a vector column; a null or NaN input fails rather than vanishing."""
    return VectorAssembler(inputCols=list(inputs), outputCol=output).transform(df)


def vector_from_array(df: DataFrame, array: str, output: str = "features") -> DataFrame:
    return df.withColumn(output, array_to_vector(F.col(array)))


def vector_elements(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Replace a vector column by one double column per element."""
    kept = [c for c in df.columns if c != vector]
    values = df.withColumn(vector, vector_to_array(vector))
    return values.select(*kept, *[F.col(vector)[i].alias(n) for i, n in enumerate(names)])


# --- label indices -----------------------------------------------------------


def label_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n, index): most frequent value first, ties in value order.

    The index is a table, so a vocabulary of any size stays on the executors.  Nulls
    get no index.  Pass a union of tables to index a shared vocabulary.
    """
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
        for c in columns
    ]
    counts = (
        df.select(F.inline(F.array(*cells)))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    placed = ranked(counts, [F.desc("n"), F.asc("value")], ["column"], name="__rank")
    return placed.select(
        "column", "value", "n", (F.col("__rank") - 1).cast("double").alias("index")
    )


def apply_label_index(
    df: DataFrame, index: DataFrame, column: str, output: str, skip_invalid: bool = False
) -> DataFrame:
    """Add the index of ``column``; values without one are null, or skipped on request."""
    entries = index.where(F.col("column") == column).select(
        F.col("value").alias(column), F.col("index").alias(output)
    )
    return df.join(entries, column, "inner" if skip_invalid else "left")


def narrow_columns(df: DataFrame, columns: Sequence[str], limit: int) -> list[str]:
    """The columns with at most ``limit`` distinct values, in their given order."""
    wide = {r["column"] for r in wide_columns(df, columns, limit).collect()}
    return [c for c in columns if c not in wide]


def wide_columns(df: DataFrame, columns: Sequence[str] | None = None, limit: int = 100) -> DataFrame:
    """(column, n_distinct) of the columns with more than ``limit`` distinct values."""
    names = list(columns) if columns is not None else string_columns(df)
    return distinct_counts(df, names).where(F.col("n_distinct") > limit)


def apply_label_indices(df: DataFrame, index: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``idx_`` columns for all of ``columns`` from one shared index, a join for each."""
    for c in columns:
        df = apply_label_index(df, index, c, f"idx_{c}")
    return df


def indexers(columns: Sequence[str], invalid: str = "error") -> StringIndexer:
    """One indexer stage over several categorical columns, for use inside a pipeline.

    Spark keeps a fitted indexer's vocabulary on the driver; ``label_index`` gives the same
    numbers as a table for vocabularies that grow with the data.
    """
    return StringIndexer(
        inputCols=list(columns), outputCols=[f"idx_{c}" for c in columns], handleInvalid=invalid
    )


def fit_feature_pipeline(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = ()
) -> PipelineModel:
    """Index the categorical columns and assemble everything into ``features``."""
    stages = [indexers(categorical)] if categorical else []
    names = [*numeric, *[f"idx_{c}" for c in categorical]]
    stages.append(VectorAssembler(inputCols=names, outputCol="features"))
    return Pipeline(stages=stages).fit(df)


# --- principal components and covariance -------------------------------------


def fit_pca(df: DataFrame, k: int, features: str = "features", output: str = "pcs") -> PCAModel:
    return PCA(k=k, inputCol=features, outputCol=output).fit(df)


def fixed_width_rows(arrays: pa.ListArray, width: int) -> np.ndarray:
    """The arrays as rows of a matrix; one that is null, holds a null or has another length fails."""
    lengths = np.array([-1 if n is None else n for n in pc.list_value_length(arrays).to_pylist()])
    flat = arrays.flatten()
    if (lengths != width).any() or flat.null_count:
        raise ValueError(f"every array must have {width} numbers")
    return flat.to_numpy(zero_copy_only=False).reshape(-1, width)


def covariance(df: DataFrame, array: str) -> DataFrame:
    """(i, j, cov): sample covariance of every pair of elements of an array column.

    One pass finds the mean vector.  In the next each task multiplies its own centred
    batches and emits a single d-by-d partial sum, so what is shuffled depends on the
    number of partitions and never on the number of rows.
    """
    known = df.select(F.col(array).cast("array<double>").alias(array)).where(F.col(array).isNotNull())
    mean = Summarizer.mean(array_to_vector(F.col(array)))
    shape = known.agg(F.count(array).alias("n"), mean.alias("mean")).first()
    if shape.n < 2:
        raise ValueError("covariance needs at least two rows")
    centre, n = shape["mean"].toArray(), shape.n
    d = len(centre)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            rows = fixed_width_rows(batch.column(0), d) - centre
            total += rows.T @ rows
        yield pa.RecordBatch.from_pydict({"gram": pa.array([total.ravel()], pa.list_(pa.float64()))})

    grams = known.mapInArrow(partial, "gram array<double>")
    cells = grams.select(F.posexplode("gram").alias("cell", "value"))
    return cells.groupBy("cell").agg(F.sum("value").alias("total")).select(
        F.floor(F.col("cell") / d).cast("int").alias("i"),
        F.pmod("cell", F.lit(d)).cast("int").alias("j"),
        (F.col("total") / F.lit(float(n - 1))).alias("cov"),
    )

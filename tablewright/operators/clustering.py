"""K-means fits, sweeps over k, and single steps from given centres."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tablewright.operators.features import fixed_width_rows
from tablewright.operators.metrics import silhouette
from tablewright.workspace import fits_at_once, kept

# Fixed value: seed of every k-means fit.
KMEANS_SEED = 12345

# Centres that move by no more than this share of the largest number rest; no limit of steps.
RESTING = 1e-12
ANY_STEPS = 2**31 - 1

# The cluster counts of a sweep.
SWEEP = range(2, 21)


def fit_kmeans(df: DataFrame, k: int, features: str = "features", seed: int = KMEANS_SEED) -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol=features).fit(df)


def settled_kmeans(df: DataFrame, k: int, features: str = "features", seed: int = KMEANS_SEED) -> KMeansModel:
    """A fit whose steps go on until its centres rest, however many steps the rows ask for.

    A row that changes its cluster moves a centre by far more than ``RESTING`` of the largest
    number; sums that tasks hand over in another order move it by less, so steps do end.
    """
    sizes = F.transform(vector_to_array(features), F.abs)
    largest = df.agg(F.max(F.array_max(sizes)).alias("largest")).first().largest
    return KMeans(k=k, seed=seed, featuresCol=features, maxIter=ANY_STEPS, tol=RESTING * (largest or 0.0)).fit(df)


def assign_clusters(df: DataFrame, k: int, features: str = "features") -> DataFrame:
    return fit_kmeans(df, k, features).transform(df)


def pca_kmeans(df: DataFrame, components: int, k: int, features: str = "features") -> DataFrame:
    """Project on principal components, cluster there, return the rows with both columns."""
    stages = [
        PCA(k=components, inputCol=features, outputCol="pcs"),
        KMeans(k=k, seed=KMEANS_SEED, featuresCol="pcs"),
    ]
    return Pipeline(stages=stages).fit(df).transform(df)


def sweep_clusters(
    df: DataFrame,
    ks: Iterable[int] = SWEEP,
    features: str = "features",
    parallelism: int | None = None,
    with_silhouette: bool = True,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """(k, cost, silhouette): one fit per k serves both numbers.

    The vectors are kept in memory while independent fits run side by side; a lost
    executor only means that its share is read again.
    """
    spark = df.sparkSession
    with kept(df.select(*(spread_by or []), features), spread_by) as vectors:

        @inheritable_thread_target(spark)
        def one(k: int) -> tuple[int, float, float | None]:
            model = fit_kmeans(vectors, k, features)
            score = silhouette(model.transform(vectors), features) if with_silhouette else None
            return k, float(model.summary.trainingCost), score

        with ThreadPool(parallelism or fits_at_once(vectors)) as pool:
            rows = pool.map(one, list(ks), chunksize=1)
    return spark.createDataFrame(rows, "k int, cost double, silhouette double")


def lowest_id_centres(df: DataFrame, id_column: str, array: str, k: int) -> np.ndarray:
    """The vectors with the ``k`` lowest ids, as the starting centres."""
    rows = df.select(id_column, array).orderBy(id_column).limit(k).collect()
    return np.array([r[1] for r in rows], dtype=float)


def assign_nearest(df: DataFrame, array: str, centres: np.ndarray) -> DataFrame:
    """Add the nearest centre and the squared distance to it; ties go to the lowest centre.

    Only the centres travel to the tasks.  Each task handles Arrow batches of its own
    rows with array arithmetic, and no row is moved.
    """
    k, d = centres.shape

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = fixed_width_rows(batch.column(batch.schema.get_field_index(array)), d)
            distances = np.empty((len(rows), k))
            for c in range(k):
                gap = rows - centres[c]
                distances[:, c] = np.einsum("ij,ij->i", gap, gap)
            cluster = distances.argmin(axis=1).astype(np.int32)
            cost = distances[np.arange(len(rows)), cluster]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cluster), pa.array(cost)],
                names=[*batch.schema.names, "cluster", "cost"],
            )

    schema = StructType(
        [*df.schema.fields, StructField("cluster", IntegerType()), StructField("cost", DoubleType())]
    )
    return df.mapInArrow(nearest, schema)


def lloyd_step(df: DataFrame, array: str, centres: np.ndarray) -> DataFrame:
    """(cluster, n, centre): one round of assignment and averaging.

    The means are combined inside each task before anything is shuffled.
    """
    assigned = assign_nearest(df.select(array), array, centres)
    mean = Summarizer.mean(array_to_vector(F.col(array)))
    return assigned.groupBy("cluster").agg(F.count("*").alias("n"), mean.alias("m")).select(
        "cluster", "n", vector_to_array("m").alias("centre")
    )


def within_cluster_cost(df: DataFrame, array: str, centres: np.ndarray) -> DataFrame:
    """Sum of squared distances to the nearest of the given centres."""
    return assign_nearest(df.select(array), array, centres).agg(F.sum("cost").alias("wcss"))

"""Cross-validated search whose finished fits are kept in a table on shared storage.

A fit of one grid point without one fold is a row of the ledger as soon as it is done.  A search
that is started again, after a lost driver or with a wider grid, fits only what its ledger lacks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Params
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.operators.fingerprints import table_fingerprint
from tablewright.operators.sampling import assign_folds
from tablewright.operators.tuning import FOLDS, fit_and_judge, param_maps
from tablewright.workspace import kept, materialize

LEDGER = "point string, fold int, metric double"


def described(stage: Params) -> str:
    """Class and parameters of an estimator or evaluator; the stages of a pipeline."""
    if isinstance(stage, Pipeline):
        return " | ".join(map(described, stage.getStages()))
    params = sorted((p.name, repr(v)) for p, v in stage.extractParamMap().items())
    return f"{type(stage).__name__} {params}"


def point_text(point: dict) -> str:
    return ", ".join(sorted(f"{p.name}={v!r}" for p, v in point.items()))


def search_folder(root: str, folded: DataFrame, estimator: Estimator, evaluator: Evaluator) -> tuple[str, list[int]]:
    """The folder that only searches with these rows, folds, starting parameters and metric share,
    and the number of rows of each fold."""
    plain = folded.withColumn("features", vector_to_array("features"))
    buckets = sorted(map(tuple, table_fingerprint(plain).collect()))
    sizes = folded.groupBy("fold").agg(F.count("*").alias("n")).orderBy("fold").collect()
    facts = [folded.sparkSession.version, str(buckets), described(estimator), described(evaluator)]
    return f"{root.rstrip('/')}/{hashlib.sha256(chr(10).join(facts).encode()).hexdigest()[:32]}", [r.n for r in sizes]


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """(point, fold, metric) of the finished fits; a fit that two drivers made counts once."""
    return spark.read.schema(LEDGER).parquet(folder).groupBy("point", "fold").agg(F.max("metric").alias("metric"))


def append_fits(spark: SparkSession, folder: str, rows: Sequence[tuple[str, int, float]]) -> None:
    """Rows become visible together when the write is committed."""
    spark.createDataFrame(list(rows), LEDGER).coalesce(1).write.mode("append").parquet(folder)


def run_fits(
    spark: SparkSession,
    fits: Iterable[tuple[str, int, Callable[[], float]]],
    record: Callable[[list[tuple[str, int, float]]], None],
    parallelism: int,
) -> None:
    """Runs ``fits`` (point, fold, fit) some at a time and records each soon after it ends.

    Every fold's jobs go to a pool of their own, which a fair scheduler serves in turn.  When a
    fit fails, those not begun are given up, those that end are recorded, and the error is raised.
    """

    def run(fold: int, fit: Callable[[], float]) -> float:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fold-{fold}")
        return fit()

    with ThreadPoolExecutor(parallelism) as pool:
        open_fits = {pool.submit(inheritable_thread_target(spark)(run), fold, fit): (point, fold) for point, fold, fit in fits}
        failed = None
        while open_fits:
            ended, _ = wait(open_fits, return_when=FIRST_COMPLETED)
            named = [(open_fits.pop(f), f) for f in ended]
            for _, f in named:
                if not f.cancelled() and f.exception() is not None and failed is None:
                    failed = f.exception()
                    for other in open_fits:
                        other.cancel()
            rows = [(*name, f.result()) for name, f in named if not f.cancelled() and f.exception() is None]
            if rows:
                record(rows)
    if failed is not None:
        raise failed


def cross_validate_resumable(
    df: DataFrame,
    keys: list[str],
    estimator: Estimator,
    evaluator: Evaluator,
    axes: dict[str, Sequence],
    root: str,
    folds: int = FOLDS,
    seed: int = 12345,
    parallelism: int = 4,
) -> CrossValidatorModel:
    """Searches the grid as ``tuning.cross_validate`` does, with a ledger under ``root``.

    ``root`` is a folder on shared storage that outlives the driver.  The ledger belongs to the
    rows themselves: other rows, folds or parameters start another one.  A fold without rows is
    an error.  The rows (keys, label, features) are laid out by key in partitions that follow their
    number, so that fits of a small table are not spread over a whole cluster.
    """
    spark = df.sparkSession
    folded = materialize(assign_folds(df, keys, folds, seed).select(*keys, "label", "features", "fold"), "search-rows")
    folder, sizes = search_folder(root, folded, estimator, evaluator)
    if len(sizes) < folds:
        raise ValueError(f"only {len(sizes)} of {folds} folds have rows")
    append_fits(spark, folder, [])
    done = {(r.point, r.fold): r.metric for r in read_ledger(spark, folder).collect()}
    maps = param_maps(estimator, axes)
    names = [point_text(p) for p in maps]

    def record(rows: list[tuple[str, int, float]]) -> None:
        append_fits(spark, folder, rows)
        done.update({(point, fold): metric for point, fold, metric in rows})

    with kept(folded, spread_by=keys, n_rows=sum(sizes)) as stored:

        def fit(point: dict, fold: int) -> Callable[[], float]:
            return lambda: fit_and_judge(stored, estimator, evaluator, point, fold)

        missing = [
            (name, fold, fit(point, fold))
            for fold in range(folds)
            for name, point in zip(names, maps)
            if (name, fold) not in done
        ]
        run_fits(spark, missing, record, parallelism)
        metrics = np.array([[done[name, fold] for fold in range(folds)] for name in names])
        means = metrics.mean(axis=1)
        best = int(means.argmax() if evaluator.isLargerBetter() else means.argmin())
        model = CrossValidatorModel(
            estimator.fit(stored, maps[best]), avgMetrics=means.tolist(), stdMetrics=metrics.std(axis=1).tolist()
        )
    for param, value in ((model.estimator, estimator), (model.evaluator, evaluator), (model.estimatorParamMaps, maps)):
        model.set(param, value)
    return model


def ledger_report(spark: SparkSession, root: str) -> DataFrame:
    """(search, point, n_folds, least, mean, most): finished fits of all searches under ``root``."""
    rows = spark.read.schema(LEDGER).option("recursiveFileLookup", "true").parquet(root)
    search = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    once = rows.select(search.alias("search"), "*").groupBy("search", "point", "fold").agg(F.max("metric").alias("metric"))
    return once.groupBy("search", "point").agg(
        F.count("*").alias("n_folds"),
        F.min("metric").alias("least"),
        F.avg("metric").alias("mean"),
        F.max("metric").alias("most"),
    )

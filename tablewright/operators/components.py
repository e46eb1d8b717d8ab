"""Principal components of many samples by block subspace iteration on the executors.

Samples times variants is cut into tiles of bounded size.  Multiplying by the centred matrix
and back again is one sum over samples for each block of variants and one sum over variants for
each chunk of samples; only matrices with a few columns and no row per sample reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablewright.operators.ordering import dense_ids
from tablewright.workspace import materialize

#: Samples of a chunk and variants of a tile: a tile has at most 16 MB.
CHUNK = 2_000
TILE = 1_000
#: Directions carried beyond those asked for, so that the iteration settles fast.
SPARE = 12
MOST_ROUNDS = 300
#: Share of the largest by which a round may still move a settled component's variance.
SETTLED = 1e-13
#: A variance settles with the square of its direction's error, so the rounds that it took are
#: followed by more, as a share, until the direction is as near.
FURTHER = 0.7


def _matrix(values: pa.Array, columns: int) -> np.ndarray:
    return values.values.to_numpy(zero_copy_only=False).reshape(-1, columns)


def tiles(vectors: DataFrame, ids: DataFrame) -> DataFrame:
    """(block, part, chunk, rows, cells): the samples of a chunk at the variants of a tile.

    ``vectors`` has sample, block and counts, ``ids`` numbers the samples from 0.  A block wider
    than a tile is cut into parts.
    """
    placed = vectors.join(ids, "sample").withColumn("chunk", F.floor(F.col("id") / CHUNK).cast("int"))
    parts = F.sequence(F.lit(0), F.floor((F.size("counts") - 1) / TILE).cast("int"))
    cut = F.transform(parts, lambda p: F.struct(p.alias("part"), F.slice("counts", p * TILE + 1, TILE).alias("x")))
    cells = placed.select("block", "chunk", (F.col("id") % CHUNK).cast("int").alias("at"), F.inline(cut))

    def pack(table: pa.Table) -> pa.Table:
        at = table.column("at").to_numpy()
        x = np.stack(table.column("x").to_pylist())[np.argsort(at)]
        one = {c: pa.array([table.column(c)[0].as_py()], pa.int32()) for c in ("block", "part", "chunk")}
        return pa.table({**one, "rows": pa.array([np.sort(at)], pa.list_(pa.int32())), "cells": pa.array([x.ravel()], pa.list_(pa.float64()))})

    packed = cells.groupBy("block", "part", "chunk").applyInArrow(
        pack, "block int, part int, chunk int, rows array<int>, cells array<double>"
    )
    return materialize(packed, "tiles")


def _summed(products: DataFrame, by: list[str]) -> DataFrame:
    """(by, m): the element-wise sums of the matrices of a group, first inside each task."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None
        for batch in batches:
            for *k, m in zip(*[batch.column(c).to_pylist() for c in by], (np.asarray(r) for r in batch.column("m").to_numpy(zero_copy_only=False))):
                if k != key:
                    if key is not None:
                        yield row(key, total)
                    key, total = k, m.copy()
                else:
                    total += m
        if key is not None:
            yield row(key, total)

    def row(key, total):
        columns = {c: pa.array([v], pa.int32()) for c, v in zip(by, key)}
        return pa.RecordBatch.from_pydict({**columns, "m": pa.array([total], pa.list_(pa.float64()))})

    schema = ", ".join(f"{c} int" for c in by) + ", m array<double>"
    once = products.sortWithinPartitions(*by).mapInArrow(add, schema)
    return once.repartition(*by).sortWithinPartitions(*by).mapInArrow(add, schema)


def _towards_variants(stored: DataFrame, q: DataFrame, k: int) -> DataFrame:
    """(block, part, m): for each variant of a tile the sum over samples of cells times directions."""

    def multiply(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rows = np.asarray(batch.column("rows")[i].values)
                x = _matrix(batch.column("cells")[i], 1).reshape(len(rows), -1)
                m = x.T @ _matrix(batch.column("q")[i], k)[rows]
                at = {c: batch.column(c).slice(i, 1) for c in ("block", "part")}
                yield pa.RecordBatch.from_pydict({**at, "m": pa.array([m.ravel()], pa.list_(pa.float64()))})

    joined = stored.join(q, "chunk").select("block", "part", "rows", "cells", "q")
    return _summed(joined.mapInArrow(multiply, "block int, part int, m array<double>"), ["block", "part"])


def _towards_samples(stored: DataFrame, y: DataFrame, k: int) -> DataFrame:
    """(chunk, m): for each sample of a chunk the sum over variants of cells times ``y``."""

    def multiply(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rows = np.asarray(batch.column("rows")[i].values)
                x = _matrix(batch.column("cells")[i], 1).reshape(len(rows), -1)
                m = np.zeros((batch.column("size")[i].as_py(), k))
                m[rows] = x @ _matrix(batch.column("m")[i], k)
                yield pa.RecordBatch.from_pydict({"chunk": batch.column("chunk").slice(i, 1), "m": pa.array([m.ravel()], pa.list_(pa.float64()))})

    joined = stored.join(y, ["block", "part"]).select("chunk", "rows", "cells", "m", "size")
    return _summed(joined.mapInArrow(multiply, "chunk int, m array<double>"), ["chunk"])


def _per_chunk(chunks: DataFrame, name: str, fn) -> DataFrame:
    """(chunk, q): ``fn`` of each chunk's matrix."""

    def run(batches):
        for batch in batches:
            for i, m in enumerate(batch.column(name)):
                q = fn(np.asarray(m.values)).ravel()
                yield pa.RecordBatch.from_pydict({"chunk": batch.column("chunk").slice(i, 1), "q": pa.array([q], pa.list_(pa.float64()))})

    return chunks.select("chunk", name).mapInArrow(run, "chunk int, q array<double>")


def _driver_sum(chunks: DataFrame, name: str, fn, size: int) -> np.ndarray:
    """The sum over chunks of a small matrix made of each."""

    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            for m in batch.column(name):
                total += fn(np.asarray(m.values))
        yield pa.RecordBatch.from_pydict({"i": np.arange(size, dtype=np.int32), "v": total})

    rows = chunks.select(name).mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size)
    for r in rows:
        out[r.i] = r.v
    return out


def _centred_products(z: DataFrame, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Means of the columns and the products of the centred columns with each other."""
    sums = _driver_sum(z, "m", lambda m: m.reshape(-1, k).sum(axis=0), k)
    mean = sums / n
    gram = _driver_sum(z, "m", lambda m: ((c := m.reshape(-1, k) - mean).T @ c).ravel(), k * k).reshape(k, k)
    return mean, (gram + gram.T) / 2


def sample_components(vectors: DataFrame, components: int, spare: int = SPARE, settled: float = SETTLED) -> DataFrame:
    """(sample, pcs): the samples on their first principal components, from (sample, block, counts).

    Every block has the same length of counts in all samples, and each sample every block.  The
    directions are iterated until they settle; with fewer samples than directions one round is
    exact.  A component beyond the rank of the table is zero; the sign of a component is such
    that its entry of largest size, the first of them by sample, is positive.
    """
    ids = materialize(dense_ids(vectors, "sample"), "sample-ids")
    n = ids.count()
    spark = vectors.sparkSession
    if not n:
        return spark.createDataFrame([], "sample string, pcs array<double>")
    k = min(n, components + spare)
    sizes = ids.groupBy(F.floor(F.col("id") / CHUNK).cast("int").alias("chunk")).agg(F.count("*").cast("int").alias("size"))
    sizes = materialize(sizes, "chunk-sizes")
    stored = materialize(tiles(vectors, ids).join(sizes, "chunk"), "sized-tiles")

    def start(batches):
        for batch in batches:
            for c, s in zip(batch.column("chunk").to_pylist(), batch.column("size").to_pylist()):
                q = np.random.default_rng([7, c]).normal(size=s * k)
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([c], pa.int32()), "m": pa.array([q], pa.list_(pa.float64()))})

    z = materialize(sizes.mapInArrow(start, "chunk int, m array<double>"), "directions")
    before, last = np.zeros(k), MOST_ROUNDS
    for done in range(1, MOST_ROUNDS + 1):
        mean, gram = _centred_products(z, n, k)
        values, turn = np.linalg.eigh(gram)
        # Directions without length, as with fewer independent samples, are left at zero.
        size = np.where(values > max(values[-1], 0) * 1e-15, np.sqrt(np.maximum(values, 1e-300)), np.inf)
        to_unit = turn / size

        def unit(m, mean=mean, to_unit=to_unit):
            return (m.reshape(-1, k) - mean) @ to_unit

        q = materialize(_per_chunk(z, "m", unit), "unit-directions")
        z = materialize(_towards_samples(stored, _towards_variants(stored, q, k), k), "directions")
        # Q'GQ: its eigenvalues are those of the table on the span of the directions.
        both = q.join(z, "chunk")
        cross = _cross(both, k)
        found, mix = np.linalg.eigh((cross + cross.T) / 2)
        top = found[::-1][:components]
        if last == MOST_ROUNDS and np.abs(top - before[: len(top)]).max() <= settled * max(top[0], 1e-300):
            last = done + int(FURTHER * done) + 1
        if k == n or done >= last:
            break
        before = top
    order = np.argsort(found)[::-1][:components]
    scale = mix[:, order] * np.sqrt(np.maximum(found[order], 0.0))

    width = len(order)
    placed = _per_chunk(q, "q", lambda m: m.reshape(-1, k) @ scale)
    one = lambda i: F.struct(i.cast("int").alias("at"), F.slice("q", i.cast("int") * width + 1, width).alias("pcs"))
    rows = placed.select("chunk", F.inline(F.transform(F.sequence(F.lit(0), F.floor(F.size("q") / width) - 1), one)))
    by_id = rows.select((F.col("chunk") * CHUNK + F.col("at")).cast("int").alias("id"), "pcs")
    named = materialize(by_id.join(ids, "id"), "placed")
    entries = [F.get("pcs", F.lit(j)) for j in range(width)]
    largest = [F.max_by(F.signum(e), F.struct(F.abs(F.round(e, 9)), -F.col("id"))) for e in entries]
    tops = named.agg(*[c.alias(f"s{j}") for j, c in enumerate(largest)]).first()
    signs = F.array(*[F.lit(1.0 if (s is None or s >= 0) else -1.0) for s in tops])
    return named.select("sample", F.zip_with("pcs", signs, lambda a, b: a * b).alias("pcs"))


def _cross(both: DataFrame, k: int) -> np.ndarray:
    """The products of the unit directions with what they have become."""

    def run(batches):
        total = np.zeros(k * k)
        for batch in batches:
            for q, m in zip(batch.column("q"), batch.column("m")):
                total += (np.asarray(q.values).reshape(-1, k).T @ np.asarray(m.values).reshape(-1, k)).ravel()
        yield pa.RecordBatch.from_pydict({"i": np.arange(k * k, dtype=np.int32), "v": total})

    rows = both.select("q", "m").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(k * k)
    for r in rows:
        out[r.i] = r.v
    return out.reshape(k, k)

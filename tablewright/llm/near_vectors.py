"""Near-duplicate vectors by range search in a robust-pruned graph built on overlapping shards.

Equal vectors are one vector with a number of copies.  Vectors are cut into shards around
centres, level by level, until a shard is small; a vector also goes to the shard of its next
nearest centres, so shards overlap.  Each shard builds a flat robust-pruned graph, and the
lists that a vector has in its shards are united.  Every vector is then searched for in each of
its shards: greedily from the medoid, and on through everything within the range.  What is
found lies in shards of its own, and those it has not been in yet are visited next, from what
was found there, until no visit is left.  A link is counted where the vector that was found is
at home, so once.  Last, a sample of vectors is held against all others, and if too few of
their links were found the search is made again, wider.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.llm import vector_graph as vg
from tablewright.llm.components import components
from tablewright.workspace import materialize

THRESHOLD = 0.9
#: Vectors at home in a shard at most, unless their directions are the same.
MOST = 1024
#: Vectors that centres are fitted on, centres of a level, and rounds of fitting.
FITTED, BRANCHES, ROUNDS = 4096, 64, 8
LEVELS = 12
#: Vectors sent to their centres by one task, and vectors that visit a shard in one task.
DEALT, VISITORS = 10_000, 2_000
QUERIES = 512
#: Shards a vector is in besides its own, for each level; open vectors of a greedy search.
OVERLAP, BEAM = 1, 12
#: Vectors of the audit, the share of their links to be found, and searches to reach it.
AUDITED, RECALL, SEARCHES = 1000, 0.97, 3
LEAST_RECALL = 0.9

MEMBER = "uid long, shard string, home boolean, embedding array<double>"
FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64()), ("shard", pa.string())])
FOUND_DDL = "a long, b long, links long, shard string"


def usable(embedding: str | Column) -> Column:
    """Whether a vector has a direction: no null or non-finite component, and not all zero."""
    e = F.col(embedding) if isinstance(embedding, str) else embedding
    finite = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(e, lambda v: v != 0.0), F.lit(False))


def unit_vectors(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of an Arrow list column of one length, as vectors of length one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)
    if not len(x):
        return x
    # First by the largest component, so that no square overflows or vanishes.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("nd,nd->n", x, x))[:, None]


def distinct_vectors(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows: vec_id, k1, k2), k1 null without a direction, and the different vectors:
    (uid, k1, k2, copies, first_id, embedding)."""
    e = F.col("embedding").cast("array<double>")
    rows = vectors.select("vec_id", e.alias("embedding"))
    rows = rows.withColumn("ok", usable("embedding")).select(
        "vec_id",
        F.when(F.col("ok"), F.xxhash64("embedding")).alias("k1"),
        F.when(F.col("ok"), F.xxhash64(F.lit(1), "embedding")).alias("k2"),
        "embedding",
    )
    different = rows.where("k1 is not null").groupBy("k1", "k2").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("first_id"), F.any_value("embedding").alias("embedding")
    )
    numbered = different.withColumn("uid", F.monotonically_increasing_id())
    return rows.drop("embedding"), materialize(numbered, "vectors")


# --- shards ------------------------------------------------------------------


def fit_centres(x: np.ndarray, branches: int, seed: int = 3) -> np.ndarray:
    """Spherical k-means from arbitrary vectors."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(branches, len(x)), replace=False)]
    for _ in range(ROUNDS):
        nearest = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        length = np.sqrt((sums * sums).sum(axis=1))
        some = length > 1e-9
        centres[some] = sums[some] / length[some][:, None]
    return centres


def _split_level(members: DataFrame, sizes: DataFrame, level: int, overlap: int) -> DataFrame:
    """The members of the shards named in ``sizes`` (shard, size), sent on to smaller shards."""
    inside = members.join(sizes, "shard")
    drawn = inside.where(F.pmod(F.xxhash64("uid", F.lit(level)), F.col("size")) < FITTED)

    def fit(table: pa.Table) -> pa.Table:
        size = table.column("size")[0].as_py()
        centres = fit_centres(unit_vectors(table.column("embedding")), min(BRANCHES, max(2, -(-2 * size // MOST))))
        return pa.table({"shard": [table.column("shard")[0].as_py()], "size": [size], "centres": [centres.ravel().tolist()]})

    fitted = materialize(drawn.groupBy("shard").applyInArrow(fit, "shard string, size long, centres array<double>"), "centres")
    parts = F.greatest(F.lit(1), F.ceil(F.col("size") / DEALT)).cast("int")
    dealt = inside.withColumn("part", F.pmod(F.xxhash64("uid"), parts).cast("int")).drop("size")
    copies = fitted.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).select("shard", "part", "centres")

    def send(rows: pa.Table, centres: pa.Table) -> pa.Table:
        empty = pa.table({"uid": pa.array([], pa.int64()), "shard": pa.array([], pa.string()), "home": pa.array([], pa.bool_()), "embedding": pa.array([], pa.list_(pa.float64()))})
        if not rows.num_rows or not centres.num_rows:
            return empty
        x = unit_vectors(rows.column("embedding"))
        c = np.array(centres.column("centres")[0].as_py()).reshape(-1, x.shape[1])
        near = np.argsort(-(x @ c.T), axis=1, kind="stable")[:, : 1 + overlap]
        home = np.array(rows.column("home").to_pylist(), bool)
        at = rows.column("shard")[0].as_py()
        # A vector at home here is also sent to its next centres; a guest to its nearest only.
        picks = [(np.arange(len(x)), near[:, 0], home)]
        picks += [(np.flatnonzero(home), near[home, k], np.zeros(home.sum(), bool)) for k in range(1, near.shape[1])]
        line = np.concatenate([p[0] for p in picks])
        chosen = rows.take(pa.array(line))
        return pa.table(
            {
                "uid": chosen.column("uid"),
                "shard": pa.array([f"{at}.{k}" for k in np.concatenate([p[1] for p in picks])], pa.string()),
                "home": pa.array(np.concatenate([p[2] for p in picks])),
                "embedding": chosen.column("embedding"),
            }
        )

    sent = dealt.groupBy("shard", "part").cogroup(copies.groupBy("shard", "part")).applyInArrow(send, MEMBER)
    # A guest may come to one shard on two ways, or to its own.
    return sent.groupBy("uid", "shard").agg(F.max("home").alias("home"), F.any_value("embedding").alias("embedding"))


def overlapping_shards(vectors: DataFrame, overlap: int = OVERLAP) -> DataFrame:
    """(uid, shard, home, embedding): every vector at home in one shard and a guest in a few.

    Shards with more than MOST at home are split again; one that no longer gets smaller, as its
    vectors have one direction, stays as it is.
    """
    whole = F.size("embedding").cast("string")
    members = vectors.select("uid", whole.alias("shard"), F.lit(True).alias("home"), "embedding")
    settled: DataFrame | None = None
    for level in range(LEVELS):
        sizes = members.where("home").groupBy("shard").agg(F.count("*").alias("size"))
        large = sizes.where(F.col("size") > MOST)
        if large.isEmpty():
            break
        small = members.join(large, "shard", "left_anti")
        settled = small if settled is None else settled.unionByName(small)
        members = materialize(_split_level(members, large, level, overlap), "members")
    return members if settled is None else materialize(settled.unionByName(members), "members")


# --- graph and search --------------------------------------------------------


def united_lists(members: DataFrame) -> DataFrame:
    """(uid, neighbours): the lists of a vector in the graphs of its shards, united."""

    def build(table: pa.Table) -> pa.Table:
        x = unit_vectors(table.column("embedding"))
        uids = table.column("uid").to_numpy()
        lists = vg.both_ways(vg.robust_prune(x), x)
        return pa.table(
            {"uid": uids, "neighbours": pa.array([uids[row[row >= 0]] for row in lists], pa.list_(pa.int64()))}
        )

    built = members.select("shard", "uid", "embedding").groupBy("shard").applyInArrow(build, "uid long, neighbours array<long>")
    return built.groupBy("uid").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"))


class _Shard:
    """The vectors of one shard with their united lists, as far as those stay inside it."""

    def __init__(self, table: pa.Table, threshold: float, beam: int):
        order = np.argsort(table.column("uid").to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        self.uids = table.column("uid").to_numpy()
        self.x = unit_vectors(table.column("embedding"))
        self.copies = table.column("copies").to_numpy()
        homes = table.column("home_shard").combine_chunks().dictionary_encode()
        self.places, self.home_place = homes.dictionary.to_pylist(), homes.indices.to_numpy().astype(np.int64)
        self.at_home = np.array([p == table.column("shard")[0].as_py() for p in self.places], bool)[self.home_place]
        lists = table.column("neighbours").combine_chunks()
        a = np.repeat(np.arange(len(self.uids)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        b = self._places(lists.flatten().to_numpy(zero_copy_only=False))
        width = int(np.bincount(a[b >= 0], minlength=1).max()) if len(a) else 1
        self.lists = vg._as_lists(a[b >= 0], b[b >= 0], self.x, max(1, width))
        self.threshold, self.beam = threshold, beam

    def _places(self, uids: np.ndarray) -> np.ndarray:
        """Where each uid is in the shard, -1 if it is not."""
        at = np.minimum(np.searchsorted(self.uids, uids), len(self.uids) - 1)
        return np.where(self.uids[at] == uids, at, -1)

    def search(self, uids: np.ndarray, queries: np.ndarray, seeds: list[list[int]]) -> pa.Table:
        """Rows (a, null, links, null) of counted links, (a, b, null, null) of a set of links that
        joins what is linked, and (a, b, null, shard) of visits to be made, with what was found."""
        parts: list[pa.Table] = []

        def add(a, b=None, links=None, shard=None):
            columns = [pa.nulls(len(a), f.type) if c is None else pa.array(c, f.type) for f, c in zip(FOUND, (a, b, links, shard))]
            parts.append(pa.Table.from_arrays(columns, schema=FOUND))

        here = self._places(uids)
        # Groups of linked vectors: those of the shard, and visitors behind them.
        node = np.where(here >= 0, here, len(self.uids) + np.arange(len(uids)))
        names = np.concatenate([self.uids, uids])
        group = np.arange(len(names))
        for at in range(0, len(uids), QUERIES):
            s = slice(at, at + QUERIES)
            own, spot = uids[s], here[s]
            starts = [
                np.unique(np.array([p for p in (h, *self._places(np.array(more, np.int64))) if p >= 0], np.int64))
                for h, more in zip(spot, seeds[s])
            ]
            q, v = vg.range_search(queries[s], self.x, self.lists, starts, self.threshold, self.beam)
            q, v = q[v != spot[q]], v[v != spot[q]]
            home = self.at_home[v]
            links = np.bincount(q[home], weights=self.copies[v[home]], minlength=len(own)).astype(np.int64)
            add(own[links > 0], links=links[links > 0])
            group = _joined(group, node[s][q], v)
            # What is at home elsewhere is where its home is to be visited.
            q, v = q[~home], v[~home]
            _, first = np.unique(q * np.int64(len(self.places)) + self.home_place[v], return_index=True)
            add(own[q[first]], self.uids[v[first]], shard=[self.places[k] for k in self.home_place[v[first]]])
        tied = np.flatnonzero(group != np.arange(len(group)))
        add(names[group[tied]], names[tied])
        return pa.concat_tables(parts)


def _joined(group: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Groups, named by their first member, after joining those of each pair."""
    while True:
        x, y = group[a], group[b]
        apart = x != y
        if not apart.any():
            return group
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        onto = np.arange(len(group))
        np.minimum.at(onto, np.maximum(x, y), np.minimum(x, y))
        while (onto != onto[onto]).any():
            onto = onto[onto]
        group = onto[group]


def _search_members(nodes: DataFrame, threshold: float, beam: int) -> DataFrame:
    def search(table: pa.Table) -> pa.Table:
        shard = _Shard(table, threshold, beam)
        return shard.search(shard.uids, shard.x, [[]] * len(shard.uids))

    return nodes.groupBy("shard").applyInArrow(search, FOUND_DDL)


def _search_visitors(nodes: DataFrame, visits: DataFrame, threshold: float, beam: int) -> DataFrame:
    """``visits``: (uid, shard, seeds, embedding)."""
    sizes = visits.groupBy("shard").agg(F.count("*").alias("n"))
    parts = F.ceil(F.col("n") / VISITORS).cast("int")
    dealt = visits.join(sizes, "shard").withColumn("part", F.pmod(F.xxhash64("uid"), parts).cast("int")).drop("n")
    copies = nodes.join(sizes, "shard").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("n")

    def search(table: pa.Table, visitors: pa.Table) -> pa.Table:
        if not table.num_rows or not visitors.num_rows:
            return FOUND.empty_table()
        x = unit_vectors(visitors.column("embedding"))
        return _Shard(table, threshold, beam).search(visitors.column("uid").to_numpy(), x, visitors.column("seeds").to_pylist())

    return copies.groupBy("shard", "part").cogroup(dealt.groupBy("shard", "part")).applyInArrow(search, FOUND_DDL)


def search_links(vectors: DataFrame, threshold: float, overlap: int, beam: int) -> DataFrame:
    """Rows of ``_Shard.search`` from all rounds, written out."""
    members = overlapping_shards(vectors, overlap)
    lists = materialize(united_lists(members), "lists")
    homes = members.where("home").select("uid", F.col("shard").alias("home_shard"))
    nodes = materialize(
        members.drop("home").join(homes, "uid").join(lists, "uid", "left").join(vectors.select("uid", "copies"), "uid"), "nodes"
    )
    found = materialize(_search_members(nodes, threshold, beam), "found")
    been = nodes.select("uid", "shard")
    rounds = found
    while True:
        asked = found.where("shard is not null").select(F.col("a").alias("uid"), "shard", "b")
        visits = asked.groupBy("uid", "shard").agg(F.min("b").alias("b")).join(been, ["uid", "shard"], "left_anti")
        visits = materialize(visits, "visits")
        if visits.isEmpty():
            return rounds
        visitors = visits.join(vectors.select("uid", "embedding"), "uid").select("uid", "shard", F.array("b").alias("seeds"), "embedding")
        found = materialize(_search_visitors(nodes, visitors, threshold, beam), "found")
        rounds = rounds.unionByName(found)
        been = been.unionByName(visits.select("uid", "shard"))


# --- audit -------------------------------------------------------------------


def audit_sample(vectors: DataFrame, n: int = AUDITED) -> list:
    """At most ``n`` vectors, the first in hash order."""
    return vectors.orderBy(F.xxhash64("uid"), "uid").limit(n).select("uid", "embedding").collect()


def true_links(vectors: DataFrame, sample: list, threshold: float) -> dict[int, int]:
    """uid of each sampled vector: its links with all others, by comparing it with every vector."""
    by_width: dict[int, list] = {}
    for r in sample:
        by_width.setdefault(len(r.embedding), []).append(r)
    held = {w: (np.array([r.uid for r in rs]), unit_vectors(pa.array([r.embedding for r in rs]))) for w, rs in by_width.items()}
    shared = vectors.sparkSession.sparkContext.broadcast(held)

    def compare(batches):
        for batch in batches:
            widths = batch.column("embedding").value_lengths().to_numpy(zero_copy_only=False)
            for w, (uids, queries) in shared.value.items():
                some = batch.filter(pa.array(widths == w))
                if not some.num_rows:
                    continue
                near = queries @ unit_vectors(some.column("embedding")).T >= threshold
                near &= uids[:, None] != some.column("uid").to_numpy()[None, :]
                yield pa.RecordBatch.from_arrays([pa.array(uids), pa.array(near @ some.column("copies").to_numpy())], ["uid", "links"])

    counted = vectors.select("uid", "embedding", "copies").mapInArrow(compare, "uid long, links long")
    return {r.uid: r.links for r in counted.groupBy("uid").agg(F.sum("links").alias("links")).collect()}


def recall_of(found: DataFrame, truth: dict[int, int]) -> float:
    """The share of the sampled vectors' links that were found; 1 if they have none."""
    if not sum(truth.values()):
        return 1.0
    spark = found.sparkSession
    wanted = spark.createDataFrame(list(truth.items()), "a long, want long")
    got = found.where("links is not null").join(F.broadcast(wanted), "a").groupBy("a").agg(F.sum("links").alias("n"))
    return sum(min(r.n, truth[r.a]) for r in got.collect()) / sum(truth.values())


# --- the operator ------------------------------------------------------------


def link_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame, float]:
    """(rows, different vectors with n_links and component_id, measured recall)."""
    rows, different = distinct_vectors(vectors)
    sample = audit_sample(different)
    truth = true_links(different, sample, threshold) if sample else {}
    for wider in range(SEARCHES):
        found = search_links(different, threshold, OVERLAP + wider, BEAM << wider)
        recall = recall_of(found, truth)
        if recall >= RECALL:
            break
    if recall < LEAST_RECALL:
        raise RuntimeError(f"only {recall:.3f} of the links of a sample were found")
    links = found.where("links is not null").groupBy(F.col("a").alias("uid")).agg(F.sum("links").alias("links"))
    edges = found.where("links is null and shard is null").select("a", "b")
    classes = components(edges).select(F.col("node").alias("uid"), "component")
    joined = (
        different.select("uid", "k1", "k2", "copies", "first_id")
        .join(links, "uid", "left")
        .join(classes, "uid", "left")
        .withColumn("component", F.coalesce("component", "uid"))
    )
    names = joined.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = joined.join(names, "component").select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    return rows, named, recall


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding).

    Two vectors are linked if their cosine, in double precision, is at least ``threshold``.
    n_links counts the linked rows, equal vectors included; component_id is the smallest vec_id
    that links lead to, and the row that bears it is kept.  Vectors of different lengths of
    list are never linked; nor is one that is null, empty, zero or has a null or non-finite
    component: it is a component of its own.  Rows with a null id count as vectors but name no
    component, unless they are alone.  Other columns are not read.

    Links of the audited sample that were found are at least LEAST_RECALL, or the job fails; no
    pair below the threshold is ever linked.
    """
    rows, named, _ = link_vectors(vectors, threshold)
    component = F.when(F.col("k1").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return rows.join(named, ["k1", "k2"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )

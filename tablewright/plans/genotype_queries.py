"""Queries over genotype reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.operators import clustering, genotypes, relational
from tablewright.plans import views
from tablewright.plans.oracle_views import over
from tablewright.plans.registry import query
from tablewright.plans.source_queries import POPULATIONS, panel
from tablewright.sources.genotype_text import panel_samples
from tablewright.workspace import materialize

# The range that a variant's share of carriers must lie in, over all samples and
# over those that are clustered.
LOW, HIGH = 0.36, 0.96
CLUSTERED_LOW, CLUSTERED_HIGH = 0.05, 0.95

# The variants that become matrix columns.
VARIANTS = [f"chr1:Brand#{i}" for i in range(1, 26)]

# Fixed value: the longest list one row of a collected group holds.
CHUNK_ITEMS = 50_000


def stored_calls(spark: SparkSession, d: str) -> DataFrame:
    """The calls written once, for the queries that pass over them several times."""
    return materialize(views.genotype(spark, d), "calls")


_IN = ", ".join(f"'{p}'" for p in POPULATIONS)
_FREQ = """, total AS (SELECT count(DISTINCT sample) AS n FROM genotype),
             freq AS (SELECT variant, count(DISTINCT sample) AS n_samples,
                             count(DISTINCT CASE WHEN alt_count > 0 THEN sample END) AS n_carriers
                      FROM genotype GROUP BY variant)"""


@query(
    "semi_join_panel",
    over(
        "genotype panel",
        f"""SELECT sample, variant, alt_count FROM genotype
            WHERE sample IN (SELECT sample FROM panel WHERE population IN ({_IN}))""",
    ),
)
def semi_join_panel(spark: SparkSession, d: str) -> DataFrame:
    chosen = panel_samples(panel(spark, d), POPULATIONS)
    return genotypes.semi_join_panel(views.genotype(spark, d), chosen)


@query(
    "lookup_join_default",
    over(
        "genotype panel",
        f"""SELECT g.sample, variant, alt_count, coalesce(population, 'Unknown') AS population
            FROM genotype g LEFT JOIN (SELECT * FROM panel WHERE population IN ({_IN})) p
              ON g.sample = p.sample""",
    ),
)
def lookup_join_default(spark: SparkSession, d: str) -> DataFrame:
    chosen = panel_samples(panel(spark, d), POPULATIONS)
    return relational.lookup(views.genotype(spark, d), chosen, "sample", "population", "Unknown")


@query("sample_count", over("genotype", "SELECT count(DISTINCT sample) AS n FROM genotype"))
def sample_count(spark: SparkSession, d: str) -> DataFrame:
    return genotypes.sample_count(views.genotype(spark, d))


@query("variant_frequency", over("genotype", _FREQ + " SELECT variant, n_samples, n_carriers FROM freq"))
def variant_frequency(spark: SparkSession, d: str) -> DataFrame:
    return genotypes.variant_frequency(views.genotype(spark, d))


@query(
    "having_complete_groups",
    over("genotype", _FREQ + " SELECT variant FROM freq WHERE n_samples = (SELECT n FROM total)"),
)
def having_complete_groups(spark: SparkSession, d: str) -> DataFrame:
    return genotypes.complete_variants(stored_calls(spark, d)).select("variant")


@query(
    "filter_by_frequency",
    over(
        "genotype",
        _FREQ
        + f""" SELECT sample, variant, alt_count FROM genotype
               WHERE variant IN (SELECT variant FROM freq WHERE n_samples = (SELECT n FROM total)
                                 AND n_carriers >= CAST({LOW} AS DOUBLE) * n_samples
                                 AND n_carriers <= CAST({HIGH} AS DOUBLE) * n_samples)""",
    ),
)
def filter_by_frequency(spark: SparkSession, d: str) -> DataFrame:
    kept = genotypes.filter_by_share(stored_calls(spark, d), LOW, HIGH)
    return kept.select("sample", "variant", "alt_count")


_MEMBER = "variant || '=' || CAST(alt_count AS VARCHAR)"


@query(
    "group_collect",
    over(
        "genotype",
        f""", c AS (SELECT sample, {_MEMBER} AS member,
                      row_number() OVER (PARTITION BY sample ORDER BY {_MEMBER}) AS pos FROM genotype)
           SELECT sample, CAST(floor((pos - 1) / {CHUNK_ITEMS}.0) AS INT) AS chunk,
                  string_agg(member, ',' ORDER BY pos) AS members
           FROM c GROUP BY 1, 2""",
    ),
)
def group_collect(spark: SparkSession, d: str) -> DataFrame:
    member = F.concat_ws("=", "variant", F.col("alt_count").cast("string"))
    groups = relational.collect_groups(views.genotype(spark, d), "sample", member, CHUNK_ITEMS)
    return groups.select("sample", "chunk", F.array_join("members", ",").alias("members"))


@query(
    "sort_within_group",
    over(
        "genotype",
        f""", c AS (SELECT sample, variant, alt_count, {_MEMBER} AS member,
                      row_number() OVER (PARTITION BY sample ORDER BY alt_count, variant) AS pos
                    FROM genotype)
           SELECT sample, CAST(floor((pos - 1) / {CHUNK_ITEMS}.0) AS INT) AS chunk,
                  string_agg(member, ',' ORDER BY pos) AS members
           FROM c GROUP BY 1, 2""",
    ),
)
def sort_within_group(spark: SparkSession, d: str) -> DataFrame:
    member = F.concat_ws("=", "variant", F.col("alt_count").cast("string"))
    groups = relational.sort_groups(
        views.genotype(spark, d), "sample", ["alt_count", "variant"], member, CHUNK_ITEMS
    )
    return groups.select("sample", "chunk", F.array_join("members", ",").alias("members"))


@query(
    "variant_matrix",
    over(
        "genotype",
        "SELECT sample, "
        + ", ".join(f"max(CASE WHEN variant = '{v}' THEN alt_count END) AS b{i}" for i, v in enumerate(VARIANTS, 1))
        + " FROM genotype GROUP BY sample",
    ),
)
def variant_matrix(spark: SparkSession, d: str) -> DataFrame:
    matrix = genotypes.variant_matrix(views.genotype(spark, d), VARIANTS)
    return matrix.withColumnsRenamed({v: f"b{i}" for i, v in enumerate(VARIANTS, 1)})


@query(
    "variant_vectors",
    over(
        "genotype",
        """, grid AS (SELECT s.sample, v.variant FROM (SELECT DISTINCT sample FROM genotype) s
                      CROSS JOIN (SELECT DISTINCT variant FROM genotype) v)
           SELECT sample, CAST(0 AS INT) AS block,
                  string_agg(CAST(coalesce(alt_count, 0) AS VARCHAR), ',' ORDER BY variant) AS counts
           FROM grid LEFT JOIN genotype USING (sample, variant) GROUP BY sample""",
    ),
)
def variant_vectors(spark: SparkSession, d: str) -> DataFrame:
    vectors = genotypes.variant_vectors(stored_calls(spark, d))
    text = F.transform("counts", lambda x: x.cast("int").cast("string"))
    return vectors.select("sample", "block", F.array_join(text, ",").alias("counts"))


@query("population_sweep")
def population_sweep(spark: SparkSession, d: str) -> DataFrame:
    """(k, cost, silhouette) on the components of the samples' variants."""
    chosen = panel_samples(panel(spark, d), POPULATIONS)
    points = genotypes.sample_points(views.relative_genotype(spark, d), chosen)
    points = materialize(points, "sample-points")
    # A silhouette needs fewer clusters than points.
    most = points.count() - 1
    ks = [k for k in clustering.SWEEP if k <= most]
    return clustering.sweep_clusters(points, ks, spread_by=["sample"])


@query("population_clusters")
def population_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Samples of the chosen populations, clustered on five components of their variants."""
    chosen = panel_samples(panel(spark, d), POPULATIONS)
    calls = views.relative_genotype(spark, d)
    clusters = genotypes.population_clusters(calls, chosen)
    return clusters.join(chosen, "sample").select("sample", "population", F.col("prediction").alias("cluster"))


@query("population_range_clusters")
def population_range_clusters(spark: SparkSession, d: str) -> DataFrame:
    """The whole chain with the range: semi-join, full calls, share of carriers, vectors, clusters."""
    chosen = panel_samples(panel(spark, d), POPULATIONS)
    clusters = genotypes.population_clusters(views.relative_genotype(spark, d), chosen, CLUSTERED_LOW, CLUSTERED_HIGH)
    return clusters.join(chosen, "sample").select("sample", "population", F.col("prediction").alias("cluster"))

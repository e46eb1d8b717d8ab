"""Queries over sources and sinks."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.functions.scalars import rounded
from tablewright.operators import estimators, fingerprints
from tablewright.plans import views
from tablewright.plans.oracle_views import over
from tablewright.plans.registry import query
from tablewright.sources import delimited, genotype_text, models
from tablewright.workspace import materialize, named_cache, scratch_path

# The populations a panel is restricted to.
POPULATIONS = ["AMERICA", "ASIA", "EUROPE"]

# Weight of each order priority.
PRIORITY_WEIGHTS = [
    ("1-URGENT", 5.0),
    ("2-HIGH", 4.0),
    ("3-MEDIUM", 3.0),
    ("4-NOT SPECIFIED", 2.0),
    ("5-LOW", 1.0),
]

ACCOUNT_SCHEMA = (
    "cust_id bigint, nation int, plan string, acctbal double, n_orders bigint, "
    "total_price double, n_urgent bigint, churn string"
)


@query(
    "scan_csv_inferred",
    "SELECT CAST(p_partkey AS INT) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
)
def scan_csv_inferred(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "part-csv")
    delimited.write_delimited(views.table(spark, d, "part"), path, header=True)
    return delimited.read_delimited(spark, path, header=True, infer=True)


@query(
    "scan_csv_semicolon",
    "SELECT CAST(s_suppkey AS INT) AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
)
def scan_csv_semicolon(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "supplier-csv")
    delimited.write_delimited(views.table(spark, d, "supplier"), path, header=True, sep=";")
    return delimited.read_delimited(spark, path, header=True, sep=";", infer=True)


@query("scan_csv_strings", over("ratings", "SELECT user_id, item_id, rating FROM ratings"))
def scan_csv_strings(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "ratings-csv")
    delimited.write_delimited(views.ratings(spark, d), path, header=True, sep=";")
    return delimited.read_delimited(spark, path, header=True, sep=";")


@query(
    "scan_csv_schema",
    over(
        "customer_account",
        "SELECT cust_id, nation, plan, acctbal, n_orders, round(total_price, 2) AS total_price, "
        "n_urgent, churn FROM customer_account",
    ),
)
def scan_csv_schema(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "account-csv")
    delimited.write_delimited(views.customer_account(spark, d), path, header=False)
    back = delimited.read_delimited(spark, path, header=False, schema=ACCOUNT_SCHEMA)
    return back.withColumn("total_price", rounded("total_price", 2))


@query(
    "scan_csv_wide",
    over("expression", "SELECT vec_id, round(list_sum(embedding), 6) + 0.0 AS dim_sum FROM expression"),
)
def scan_csv_wide(spark: SparkSession, d: str) -> DataFrame:
    vectors = views.expression(spark, d).drop("label")
    width = vectors.agg(F.max(F.size("embedding")).alias("w")).first().w
    wide = delimited.spread_array(vectors, "embedding", width, "gene_")
    path = scratch_path(spark, "wide-csv")
    delimited.write_delimited(wide, path, header=True)
    folded = delimited.read_wide_numeric(spark, path, ["vec_id"])
    total = F.aggregate("features", F.lit(0.0), lambda a, x: a + x)
    return folded.select(F.col("vec_id").cast("bigint").alias("vec_id"), rounded(total).alias("dim_sum"))


@query(
    "genotype_long",
    over(
        "genotype",
        """, p AS (SELECT sample, CAST(split_part(variant, '#', 2) AS BIGINT) AS pos, alt_count
                   FROM genotype),
           every AS (SELECT s.sample, v.pos FROM (SELECT DISTINCT sample FROM p) s
                     CROSS JOIN (SELECT DISTINCT pos FROM p) v)
        SELECT sample, concat('chr1:', pos - 1, ':', pos) AS variant,
               CAST(coalesce(alt_count, 2) AS INT) AS alt_count
        FROM every LEFT JOIN p USING (sample, pos)""",
    ),
)
def genotype_long(spark: SparkSession, d: str) -> DataFrame:
    """Variant-call text written from the genotype view, parsed back on the executors.

    A call that is not in the text counts as two alleles other than the reference.
    """
    calls = views.genotype(spark, d).select(
        "sample",
        F.split("variant", ":")[0].alias("contig"),
        F.split("variant", "#")[1].cast("bigint").alias("pos"),
        "alt_count",
    )
    calls = materialize(calls, "calls")
    samples = [r.sample for r in calls.select("sample").distinct().orderBy("sample").collect()]
    path = genotype_text.write_genotypes(calls, samples, scratch_path(spark, "calls-text"))
    return genotype_text.sample_variants(genotype_text.read_genotypes(spark, path))


@query(
    "genotype_files",
    over(
        "genotype panel",
        """, p AS (SELECT g.sample, population, CAST(split_part(variant, '#', 2) AS BIGINT) AS pos, alt_count
                   FROM genotype g JOIN panel USING (sample)
                   WHERE population IN ('AMERICA', 'ASIA', 'EUROPE')),
           every AS (SELECT population, sample, pos
                     FROM (SELECT DISTINCT population, sample FROM p) s
                     JOIN (SELECT DISTINCT population, pos FROM p) v USING (population))
        SELECT sample, concat('chr1:', pos - 1, ':', pos) AS variant,
               CAST(coalesce(alt_count, 2) AS INT) AS alt_count
        FROM every LEFT JOIN p USING (population, sample, pos)""",
    ),
)
def genotype_files(spark: SparkSession, d: str) -> DataFrame:
    """Variant-call text in a folder for each chosen population, so with different samples, read as one."""
    calls = views.genotype(spark, d).join(panel(spark, d), "sample").select(
        "sample",
        "population",
        F.split("variant", ":")[0].alias("contig"),
        F.split("variant", "#")[1].cast("bigint").alias("pos"),
        "alt_count",
    )
    calls = materialize(calls, "population-calls")
    paths = []
    for population in POPULATIONS:
        own = calls.where(F.col("population") == population).drop("population")
        samples = [r.sample for r in own.select("sample").distinct().orderBy("sample").collect()]
        paths.append(genotype_text.write_genotypes(own, samples, scratch_path(spark, "population-text")))
    return genotype_text.sample_variants(genotype_text.read_genotypes(spark, paths))


def panel(spark: SparkSession, d: str) -> DataFrame:
    """The population panel, written as text lines and parsed back."""
    path = scratch_path(spark, "panel-text")
    views.population_panel(spark, d).write.text(path)
    return genotype_text.read_panel(spark, path)


@query(
    "panel_parse",
    """WITH p AS (SELECT concat('S', CAST(n_nationkey AS VARCHAR)) AS sample,
                         split_part(r_name, ' ', 1) AS population
                  FROM nation JOIN region ON n_regionkey = r_regionkey)
       SELECT sample, population, count(c_custkey) AS n_customers
       FROM p LEFT JOIN customer ON sample = concat('S', CAST(c_nationkey AS VARCHAR))
       GROUP BY sample, population""",
)
def panel_parse(spark: SparkSession, d: str) -> DataFrame:
    """The parsed panel with the number of customers behind each sample."""
    customers = (
        views.table(spark, d, "customer")
        .groupBy(F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("sample"))
        .agg(F.count("*").alias("n"))
    )
    return panel(spark, d).join(customers, "sample", "left").select(
        "sample", "population", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_customers")
    )


@query(
    "literal_rows",
    """SELECT priority, weight, count(*) AS n_orders, round(sum(weight), 2) AS total_weight
       FROM orders JOIN (VALUES ('1-URGENT', 5.0::DOUBLE), ('2-HIGH', 4.0), ('3-MEDIUM', 3.0),
                                ('4-NOT SPECIFIED', 2.0), ('5-LOW', 1.0)) AS w(priority, weight)
         ON o_orderpriority = priority
       GROUP BY priority, weight""",
)
def literal_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows stated in the program, joined to the orders after those are counted."""
    weights = delimited.literal_rows(spark, PRIORITY_WEIGHTS, "priority string, weight double")
    counts = (
        views.table(spark, d, "orders")
        .groupBy(F.col("o_orderpriority").alias("priority"))
        .agg(F.count("*").alias("n_orders"))
    )
    return counts.join(weights, "priority").select(
        "priority", "weight", "n_orders", rounded(F.col("weight") * F.col("n_orders"), 2).alias("total_weight")
    )


@query("csv_sink_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_sink_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    customer = views.table(spark, d, "customer")
    path = scratch_path(spark, "customer-csv")
    delimited.write_delimited(customer, path, header=False)
    return delimited.read_delimited(spark, path, header=False, schema=customer.schema)


@query(
    "model_roundtrip",
    over("priced_lines", "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM priced_lines"),
)
def model_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose prediction changes after the fitted model is saved and loaded back."""
    names = ["l_quantity", "l_discount", "p_size"]
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(
        views.priced_lines(spark, d)
    ).select("features", "label")
    model = estimators.make("linear_regress").fit(rows)
    path = models.save_model(model, scratch_path(spark, "linear-model"))
    again = models.reload_model(model, path).setPredictionCol("reloaded")
    both = again.transform(model.transform(rows))
    return both.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("prediction") != F.col("reloaded")).alias("n_different"),
    )


@query(
    "table_shape",
    over("ratings", "SELECT count(*) AS n_rows, CAST(3 AS BIGINT) AS n_cols FROM ratings"),
)
def table_shape(spark: SparkSession, d: str) -> DataFrame:
    df = views.ratings(spark, d)
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_cols"))


@query(
    "preview_ordered",
    over(
        "customer_account",
        "SELECT cust_id, plan, acctbal, n_orders, churn FROM customer_account ORDER BY cust_id LIMIT 10",
    ),
)
def preview_ordered(spark: SparkSession, d: str) -> DataFrame:
    accounts = views.customer_account(spark, d)
    return accounts.select("cust_id", "plan", "acctbal", "n_orders", "churn").orderBy("cust_id").limit(10)


_REPORT = """SELECT plan, churn, count(*) AS n_customers, sum(n_orders) AS n_orders
             FROM {view} GROUP BY plan, churn"""


@query(
    "sql_text_report",
    over(
        "customer_account",
        "SELECT plan, churn, count(*) AS n_customers, CAST(sum(n_orders) AS BIGINT) AS n_orders "
        "FROM customer_account GROUP BY plan, churn",
    ),
)
def sql_text_report(spark: SparkSession, d: str) -> DataFrame:
    """SQL text over the registered views."""
    views.register(spark, d)
    return spark.sql(_REPORT.format(view="customer_account"))


@query(
    "cached_table_reports",
    over(
        "customer_account",
        """, r AS (SELECT plan, churn, count(*) AS n_customers, CAST(sum(n_orders) AS BIGINT) AS n_orders
                   FROM customer_account GROUP BY plan, churn)
        SELECT plan, churn, n_customers, n_orders FROM r UNION ALL
        SELECT 'all', 'all', count(*), CAST(sum(n_orders) AS BIGINT) FROM customer_account""",
    ),
)
def cached_table_reports(spark: SparkSession, d: str) -> DataFrame:
    """Two reports by SQL text over one cached, named table; the cache is given back with the result."""
    with named_cache(views.customer_account(spark, d), "cached_account") as accounts:
        total = accounts.agg(F.count("*").alias("n_customers"), F.sum("n_orders").alias("n_orders"))
        total = total.select(F.lit("all").alias("plan"), F.lit("all").alias("churn"), "n_customers", "n_orders")
        return materialize(spark.sql(_REPORT.format(view="cached_account")).unionByName(total), "cached-reports")


_DIGESTS = """, t AS (SELECT user_id, item_id, rating, count(*) AS n FROM ratings GROUP BY ALL),
    texts AS (SELECT n, md5(concat(length(item_id), ':', item_id, length(rating), ':', rating,
                                   length(user_id), ':', user_id)) AS m FROM t),
    digests AS (SELECT n, CAST(CAST(('0x' || substr(m, 1, 8)) AS BIGINT) % 64 AS INT) AS bucket,
                       CAST(('0x' || substr(m, 9, 8)) AS BIGINT) AS a,
                       CAST(('0x' || substr(m, 17, 8)) AS BIGINT) AS b,
                       CAST(('0x' || substr(m, 25, 8)) AS BIGINT) AS c FROM texts)"""


@query(
    "table_fingerprint",
    over(
        "ratings",
        _DIGESTS
        + """ SELECT bucket, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(a * n) AS VARCHAR) AS sum_a,
                     CAST(sum(b * n) AS VARCHAR) AS sum_b, CAST(sum(c * n) AS VARCHAR) AS sum_c
              FROM digests GROUP BY bucket""",
    ),
)
def table_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return fingerprints.table_fingerprint(views.ratings(spark, d))


@query(
    "differing_buckets",
    over(
        "ratings",
        _DIGESTS
        + """ SELECT bucket, CAST(sum(n) AS BIGINT) AS n_left, count(*) AS n_right
              FROM digests GROUP BY bucket HAVING max(n) > 1""",
    ),
)
def differing_buckets(spark: SparkSession, d: str) -> DataFrame:
    """The ratings against their distinct rows: buckets that hold a repeated rating differ."""
    ratings = views.ratings(spark, d)
    return fingerprints.differing_buckets(ratings, ratings.distinct())


@query(
    "copy_is_equal",
    over("ratings", "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_differing FROM ratings"),
)
def copy_is_equal(spark: SparkSession, d: str) -> DataFrame:
    """Buckets in which the ratings differ from themselves written as text and read back."""
    ratings = materialize(views.ratings(spark, d), "ratings")
    path = delimited.write_delimited(ratings, scratch_path(spark, "ratings-copy"), header=True)
    back = delimited.read_delimited(spark, path, header=True)
    differing = fingerprints.differing_buckets(ratings, back).agg(F.count("*")).scalar()
    return ratings.agg(F.count("*").alias("n_rows")).withColumn("n_differing", differing)

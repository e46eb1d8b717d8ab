"""Derived views over a folder of parquet tables.

Each function reads only the columns its view needs; a query that uses fewer of
them has the rest pruned from the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Thresholds of the rule-based scorer that stands in for a model.
MIN_PERIODS = 20
LANGUAGE_BOUNDS = (("es", 0.095), ("en", 0.13), ("fr", 0.165))
DEFAULT_LANGUAGE = "de"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customer_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: plan, balance, order history before the cut, churn flag."""
    orders = table(spark, sf_dir, "orders")
    cut = orders.agg((F.max("o_orderdate") - F.expr("INTERVAL 180 DAY")).alias("cut")).scalar()
    early = F.col("o_orderdate") < cut
    history = orders.groupBy("o_custkey").agg(
        F.max("o_orderdate").alias("last_dt"),
        F.sum(F.when(early, 1).otherwise(0)).alias("n_orders"),
        F.sum(F.when(early, F.col("o_totalprice")).otherwise(0.0)).alias("total_price"),
        F.sum(F.when(early & F.col("o_orderpriority").like("1-%"), 1).otherwise(0)).alias("n_urgent"),
    )
    customer = table(spark, sf_dir, "customer")
    joined = customer.join(history, customer.c_custkey == history.o_custkey, "left")
    lapsed = F.col("last_dt").isNull() | (F.col("last_dt") < cut)
    return joined.select(
        F.col("c_custkey").alias("cust_id"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("plan"),
        F.col("c_acctbal").alias("acctbal"),
        F.coalesce("n_orders", F.lit(0)).cast("bigint").alias("n_orders"),
        F.coalesce("total_price", F.lit(0.0)).alias("total_price"),
        F.coalesce("n_urgent", F.lit(0)).cast("bigint").alias("n_urgent"),
        F.when(lapsed, "True").otherwise("False").alias("churn"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings triple, every column a string as a header-only CSV scan would give it."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("item_id"),
        F.ceil(F.col("l_quantity") / 5).cast("int").cast("string").alias("rating"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue side of the ratings."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("item_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("author"),
    )


def priced_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric regression table; the label is the last column."""
    lines = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    return lines.join(part, lines.l_partkey == part.p_partkey).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_quantity",
        "l_discount",
        "l_tax",
        "p_retailprice",
        F.col("p_size").cast("double").alias("p_size"),
        F.col("l_extendedprice").alias("label"),
    )


def doc_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Character counts of each labelled document, over the whole text."""
    labels = table(spark, sf_dir, "labels")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")

    def occurrences(ch: str):
        return (F.length("text") - F.length(F.replace("text", F.lit(ch), F.lit("")))).cast("double")

    features = documents.select(
        "doc_id",
        "lang",
        F.col("n_chars").cast("double").alias("n_chars"),
        occurrences(" ").alias("n_spaces"),
        occurrences(".").alias("n_periods"),
        (occurrences("e") / F.greatest(F.length("text"), F.lit(1))).alias("e_ratio"),
    )
    return labels.join(features, "doc_id").select(
        "doc_id", "lang", "quality", "toxic", "n_chars", "n_spaces", "n_periods", "e_ratio"
    )


def expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide numeric rows kept as one array column."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding")
    )


def genotype(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long sample-by-variant table of alternate counts 0 to 2.

    Lines are added up per supplier and brand before they meet the suppliers, so a
    supplier with a large share of all lines brings a few rows to that join.
    """
    lines = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    supplier = table(spark, sf_dir, "supplier")
    rare = (F.col("l_discount") >= 0.095) & (F.col("l_quantity") > 45)
    return (
        lines.join(part, lines.l_partkey == part.p_partkey)
        .groupBy("l_suppkey", "p_brand")
        .agg(F.sum(F.when(rare, 1).otherwise(0)).alias("n"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", "p_brand")
        .agg(F.sum("n").alias("n"))
        .select(
            F.concat(F.lit("S"), F.col("s_nationkey").cast("string")).alias("sample"),
            F.concat_ws(":", F.lit("chr1"), "p_brand").alias("variant"),
            F.least(F.lit(2), F.col("n")).cast("int").alias("alt_count"),
        )
    )


def relative_genotype(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``genotype``, with alternate counts that mean the same for any number of lines.

    The counts of ``genotype`` reach 2 in every sample once there are enough lines.  Here a sample
    has two alleles of a variant, its lines of even and of odd orders, and one is alternate where
    rare lines are a larger share of it than of all lines.
    """
    lines = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    supplier = table(spark, sf_dir, "supplier")
    rare = (F.col("l_discount") >= 0.095) & (F.col("l_quantity") > 45)
    share = lines.agg(F.count_if(rare) / F.count("*")).scalar()
    sums = [F.sum("n").alias("n"), F.sum("n_rare").alias("n_rare")]
    alleles = (
        lines.join(part, lines.l_partkey == part.p_partkey)
        .groupBy("l_suppkey", "p_brand", F.pmod("l_orderkey", F.lit(2)).alias("allele"))
        .agg(F.count("*").alias("n"), F.count_if(rare).alias("n_rare"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", "p_brand", "allele")
        .agg(*sums)
    )
    return alleles.groupBy("s_nationkey", "p_brand").agg(
        F.count_if(F.col("n_rare") > F.col("n") * share).cast("int").alias("alt_count")
    ).select(
        F.concat(F.lit("S"), F.col("s_nationkey").cast("string")).alias("sample"),
        F.concat_ws(":", F.lit("chr1"), "p_brand").alias("variant"),
        "alt_count",
    )


# The event types that become columns of the user matrix.
EVENT_TYPES = ("click", "view", "purchase", "signup", "error")


def user_event_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user, one summed value column per event type."""
    events = table(spark, sf_dir, "events")
    sums = [
        F.sum(F.when(F.col("event_type") == t, F.col("value")).otherwise(0.0)).alias(f"v_{t}")
        for t in EVENT_TYPES
    ]
    return events.groupBy("user_id").agg(*sums)


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a binary label, a score and a rule-based prediction."""
    return doc_features(spark, sf_dir).select(
        "doc_id",
        F.col("quality").cast("double").alias("label"),
        (F.col("n_periods") / F.col("n_chars")).alias("score"),
        F.when(F.col("n_periods") > MIN_PERIODS, 1.0).otherwise(0.0).alias("prediction"),
    )


def language_guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their language and a rule-based guess of it."""
    guess = F.lit(DEFAULT_LANGUAGE)
    for lang, bound in reversed(LANGUAGE_BOUNDS):
        guess = F.when(F.col("e_ratio") < bound, lang).otherwise(guess)
    return doc_features(spark, sf_dir).select(
        "doc_id", F.col("lang").alias("label"), guess.alias("prediction")
    )


def register(spark: SparkSession, sf_dir: str) -> None:
    """Name every view for SQL text: ``spark.sql`` can then query them by these names."""
    for name, build in {
        "customer_account": customer_account,
        "ratings": ratings,
        "items": items,
        "priced_lines": priced_lines,
        "documents_scored": scored_documents,
        "expression": expression,
        "genotype": genotype,
        "user_events": user_event_matrix,
    }.items():
        build(spark, sf_dir).createOrReplaceTempView(name)


def population_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample and population as one line of panel text each."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.concat(
            F.lit("S"), F.col("n_nationkey").cast("string"), F.lit("\t"), F.col("r_name")
        ).alias("value")
    )

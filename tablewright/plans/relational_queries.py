"""Queries over projections, filters, joins, aggregates and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.functions import scalars
from tablewright.functions.scalars import rounded
from tablewright.operators import key_filter, metrics, relational, sampling
from tablewright.plans import views
from tablewright.plans.oracle_views import over
from tablewright.plans.registry import query
from tablewright.plans.source_queries import POPULATIONS, panel
from tablewright.sources.delimited import literal_rows
from tablewright.sources.genotype_text import panel_samples
from tablewright.workspace import materialize

# The user and the lowest rating of the single-reader report.
READER, LOWEST_RATING = "7", 4

# The number of ratings a newly arrived user brings, and that user's id.
NEW_USER, NEW_RATINGS = "300000", [(str(item), "10") for item in range(1, 11)]


# --- columns and rows --------------------------------------------------------


@query("project_columns", over("customer_account", "SELECT cust_id, plan, churn FROM customer_account"))
def project_columns(spark: SparkSession, d: str) -> DataFrame:
    return views.customer_account(spark, d).select("cust_id", "plan", "churn")


@query(
    "rename_columns",
    over("customer_account", "SELECT cust_id, acctbal AS balance, n_orders AS order_count FROM customer_account"),
)
def rename_columns(spark: SparkSession, d: str) -> DataFrame:
    raw = views.customer_account(spark, d).select(
        "cust_id",
        F.col("acctbal").alias("Account balance (%)"),
        F.col("n_orders").alias("Order-Count"),
    )
    return raw.withColumnsRenamed({"Account balance (%)": "balance", "Order-Count": "order_count"})


@query(
    "derive_columns",
    over(
        "priced_lines",
        """SELECT l_orderkey, l_linenumber, l_partkey, round(label * (1 - l_discount), 4) + 0.0 AS net,
                  label / l_quantity AS unit_price
           FROM priced_lines""",
    ),
)
def derive_columns(spark: SparkSession, d: str) -> DataFrame:
    lines = views.priced_lines(spark, d).select(
        "l_orderkey", "l_linenumber", "l_partkey", "label", "l_discount", "l_quantity"
    )
    return lines.withColumns(
        {
            "net": rounded(F.col("label") * (1 - F.col("l_discount")), 4),
            "unit_price": F.col("label") / F.col("l_quantity"),
        }
    ).drop("label", "l_discount", "l_quantity")


@query(
    "drop_columns",
    over("customer_account", "SELECT cust_id, acctbal, n_orders, n_urgent, churn FROM customer_account"),
)
def drop_columns(spark: SparkSession, d: str) -> DataFrame:
    return views.customer_account(spark, d).drop("nation", "plan", "total_price")


@query(
    "select_all_but",
    over(
        "priced_lines",
        """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax, p_retailprice,
                  p_size FROM priced_lines""",
    ),
)
def select_all_but(spark: SparkSession, d: str) -> DataFrame:
    return relational.all_but(views.priced_lines(spark, d), "label")


@query(
    "select_by_pattern",
    over("priced_lines", "SELECT l_quantity, l_discount, l_tax FROM priced_lines"),
)
def select_by_pattern(spark: SparkSession, d: str) -> DataFrame:
    lines = views.priced_lines(spark, d)
    return lines.select(
        relational.matching_columns(lines, "l_.*", exclude=".*key|.*number", string_prefix="idx_")
    )


@query(
    "rename_strings_by_pattern",
    over("customer_account", "SELECT nation, plan AS idx_plan, churn AS idx_churn FROM customer_account"),
)
def rename_strings_by_pattern(spark: SparkSession, d: str) -> DataFrame:
    """Columns chosen by name, the string columns among them under their indexed names."""
    accounts = views.customer_account(spark, d)
    return accounts.select(relational.matching_columns(accounts, "nation|plan|churn", string_prefix="idx_"))


@query(
    "cast_columns",
    over(
        "ratings",
        """SELECT CAST(user_id AS INT) AS user_id, CAST(item_id AS INT) AS item_id,
                  CAST(rating AS DOUBLE) AS rating FROM ratings""",
    ),
)
def cast_columns(spark: SparkSession, d: str) -> DataFrame:
    return views.ratings(spark, d).select(
        scalars.to_type("user_id", "int").alias("user_id"),
        scalars.to_type("item_id", "int").alias("item_id"),
        scalars.to_type("rating", "double").alias("rating"),
    )


@query(
    "filter_conjunction",
    over("scored", "SELECT doc_id, label, prediction FROM scored WHERE prediction = 0 AND NOT (label = prediction)"),
)
def filter_conjunction(spark: SparkSession, d: str) -> DataFrame:
    scored = views.scored_documents(spark, d).select("doc_id", "label", "prediction")
    return scored.filter(F.col("prediction") == 0.0).filter(~(F.col("label") == F.col("prediction")))


@query(
    "filter_user_min_rating",
    over(
        "ratings items",
        f"""SELECT user_id, item_id, rating, title FROM ratings JOIN items USING (item_id)
            WHERE user_id = '{READER}' AND CAST(rating AS INT) > {LOWEST_RATING}""",
    ),
)
def filter_user_min_rating(spark: SparkSession, d: str) -> DataFrame:
    rating = scalars.to_type("rating", "int")
    one = views.ratings(spark, d).where((F.col("user_id") == READER) & (rating > LOWEST_RATING))
    titles = views.items(spark, d).select("item_id", "title")
    return relational.keyed_join(one, titles, "item_id").select("user_id", "item_id", "rating", "title")


_IN = ", ".join(f"'{p}'" for p in POPULATIONS)


@query(
    "filter_membership",
    f"""SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey WHERE split_part(r_name, ' ', 1) IN ({_IN})""",
)
def filter_membership(spark: SparkSession, d: str) -> DataFrame:
    """Customers of the nations whose population is one of the chosen set."""
    chosen = panel_samples(panel(spark, d), POPULATIONS)
    nation = views.table(spark, d, "nation").select(
        "n_nationkey", "n_name", F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("sample")
    )
    customer = views.table(spark, d, "customer")
    kept = nation.join(chosen, "sample", "left_semi")
    return customer.join(kept, customer.c_nationkey == kept.n_nationkey).select("c_custkey", "n_name")


def with_gaps(spark: SparkSession, d: str) -> DataFrame:
    """All customers left-joined to the lapsed ones, so that nulls appear."""
    accounts = views.customer_account(spark, d)
    lapsed = accounts.where(F.col("churn") == "True").select(
        "cust_id", F.col("n_orders").alias("lapsed_orders"), F.col("plan").alias("lapsed_plan")
    )
    return accounts.select("cust_id", "plan").join(lapsed, "cust_id", "left")


_GAPS = """, gaps AS (SELECT a.cust_id, a.plan, b.n_orders AS lapsed_orders, b.plan AS lapsed_plan
                      FROM customer_account a
                      LEFT JOIN (SELECT * FROM customer_account WHERE churn = 'True') b
                        ON a.cust_id = b.cust_id)"""


@query(
    "drop_null_rows",
    over(
        "customer_account",
        _GAPS + " SELECT * FROM gaps WHERE lapsed_orders IS NOT NULL AND lapsed_plan IS NOT NULL",
    ),
)
def drop_null_rows(spark: SparkSession, d: str) -> DataFrame:
    return with_gaps(spark, d).na.drop()


@query(
    "null_profile",
    over(
        "customer_account",
        _GAPS
        + """ SELECT 'cust_id' AS "column", count(*) - count(cust_id) AS n_null FROM gaps
              UNION ALL SELECT 'plan', count(*) - count(plan) FROM gaps
              UNION ALL SELECT 'lapsed_orders', count(*) - count(lapsed_orders) FROM gaps
              UNION ALL SELECT 'lapsed_plan', count(*) - count(lapsed_plan) FROM gaps""",
    ),
)
def null_profile(spark: SparkSession, d: str) -> DataFrame:
    return relational.null_profile(with_gaps(spark, d))


@query("distinct_values", over("customer_account", "SELECT DISTINCT plan FROM customer_account"))
def distinct_values(spark: SparkSession, d: str) -> DataFrame:
    return views.customer_account(spark, d).select("plan").distinct()


# --- joins -------------------------------------------------------------------


@query(
    "rating_stats_by_item",
    over(
        "ratings items",
        """SELECT item_id, title, max_rating, min_rating, n_users
           FROM (SELECT item_id, max(CAST(rating AS INT)) AS max_rating,
                        min(CAST(rating AS INT)) AS min_rating,
                        count(DISTINCT user_id) AS n_users
                 FROM ratings GROUP BY item_id) JOIN items USING (item_id)
           ORDER BY n_users DESC, item_id""",
    ),
)
def rating_stats_by_item(spark: SparkSession, d: str) -> DataFrame:
    stats = relational.rating_stats_by_item(views.ratings(spark, d), views.items(spark, d))
    return stats.orderBy(F.desc("n_users"), "item_id")


def item_mean_predictions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(truth, predictions) per (user, item): the mean rating given, and the item's mean.

    The sums per pair are written once: three later steps start from them, and column
    pruning would otherwise make each repeat the join of the two fact tables.
    """
    rated = views.ratings(spark, d).withColumn("r", scalars.to_type("rating", "int"))
    sums = rated.groupBy("user_id", "item_id").agg(F.sum("r").alias("s"), F.count("r").alias("n"))
    truth = materialize(sums, "rating-sums")
    item_mean = truth.groupBy("item_id").agg((F.sum("s") / F.sum("n")).alias("prediction"))
    predictions = truth.select("user_id", "item_id").join(item_mean, "item_id")
    return truth.select("user_id", "item_id", (F.col("s") / F.col("n")).alias("label")), predictions


_PAIRS = """, truth AS (SELECT user_id, item_id, avg(CAST(rating AS INT)) AS label FROM ratings
                        GROUP BY user_id, item_id),
              preds AS (SELECT item_id, avg(CAST(rating AS INT)) AS prediction FROM ratings
                        GROUP BY item_id)"""


@query(
    "join_composite_key",
    over(
        "ratings",
        _PAIRS
        + """ SELECT user_id, item_id, round(label, 6) + 0.0 AS label,
                     round(prediction, 6) + 0.0 AS prediction
              FROM truth JOIN preds USING (item_id)""",
    ),
)
def join_composite_key(spark: SparkSession, d: str) -> DataFrame:
    truth, predictions = item_mean_predictions(spark, d)
    return relational.keyed_join(predictions, truth, ["user_id", "item_id"]).select(
        "user_id", "item_id", rounded("label").alias("label"), rounded("prediction").alias("prediction")
    )


@query(
    "rmse_pairs",
    over(
        "ratings",
        _PAIRS
        + """ SELECT round(sqrt(avg((label - prediction) * (label - prediction))), 6) + 0.0 AS rmse
              FROM truth JOIN preds USING (item_id)""",
    ),
)
def rmse_pairs(spark: SparkSession, d: str) -> DataFrame:
    # The label rides along through the item join: one shuffle of the pairs instead of two.
    rated = views.ratings(spark, d).withColumn("r", scalars.to_type("rating", "int"))
    sums = rated.groupBy("user_id", "item_id").agg(F.sum("r").alias("s"), F.count("r").alias("n"))
    truth = materialize(sums, "rating-sums")
    item_mean = truth.groupBy("item_id").agg((F.sum("s") / F.sum("n")).alias("prediction"))
    both = truth.withColumn("label", F.col("s") / F.col("n")).join(item_mean, "item_id")
    return metrics.rmse(both).select(rounded("rmse").alias("rmse"))


@query(
    "cross_join",
    """WITH grid AS (SELECT r_regionkey, r_name, plan
                     FROM region CROSS JOIN (SELECT DISTINCT c_mktsegment AS plan FROM customer)),
       n AS (SELECT n_regionkey, c_mktsegment, count(*) AS n
             FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)
       SELECT r_name, plan, coalesce(n, 0) AS n_customers
       FROM grid LEFT JOIN n ON r_regionkey = n_regionkey AND plan = c_mktsegment""",
)
def cross_join(spark: SparkSession, d: str) -> DataFrame:
    """Customers per region and plan, pairings without any customer included."""
    customer = views.table(spark, d, "customer")
    nation = views.table(spark, d, "nation")
    region = views.table(spark, d, "region").select("r_regionkey", "r_name")
    plans = customer.select(F.col("c_mktsegment").alias("plan")).distinct()
    counts = (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .groupBy(F.col("n_regionkey").alias("r_regionkey"), F.col("c_mktsegment").alias("plan"))
        .agg(F.count("*").alias("n_customers"))
    )
    grid = relational.complete_grid(region, plans)
    filled = relational.lookup(grid, counts, ["r_regionkey", "plan"], "n_customers", 0)
    return filled.select("r_name", "plan", F.col("n_customers").cast("bigint").alias("n_customers"))


@query(
    "attach_labels",
    "SELECT d.doc_id, d.lang, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
)
def attach_labels(spark: SparkSession, d: str) -> DataFrame:
    documents = views.table(spark, d, "documents").select("doc_id", "lang")
    labels = views.table(spark, d, "labels").select("doc_id", "quality")
    return relational.keyed_join(documents, labels, "doc_id")


# --- aggregates --------------------------------------------------------------


@query("global_avg", over("priced_lines", "SELECT round(avg(label), 4) AS avg_label FROM priced_lines"))
def global_avg(spark: SparkSession, d: str) -> DataFrame:
    return views.priced_lines(spark, d).agg(F.avg("label").alias("m")).select(rounded("m", 4).alias("avg_label"))


@query("global_max", over("priced_lines", "SELECT max(l_quantity) AS max_qty FROM priced_lines"))
def global_max(spark: SparkSession, d: str) -> DataFrame:
    return views.priced_lines(spark, d).agg(F.max("l_quantity").alias("max_qty"))


@query(
    "max_string_vs_number",
    over(
        "ratings",
        "SELECT max(rating) AS max_as_string, max(CAST(rating AS INT)) AS max_as_number FROM ratings",
    ),
)
def max_string_vs_number(spark: SparkSession, d: str) -> DataFrame:
    """Text order puts '9' above '10'; the number column is the one to use."""
    return views.ratings(spark, d).agg(
        F.max("rating").alias("max_as_string"),
        F.max(scalars.to_type("rating", "int")).alias("max_as_number"),
    )


@query(
    "group_total_minutes",
    over(
        "user_event_matrix",
        """SELECT user_id % 2 AS flag,
                  round(sum(v_click) + sum(v_view) + sum(v_purchase) + sum(v_signup), 2) AS total
           FROM user_event_matrix GROUP BY user_id % 2""",
    ),
)
def group_total_minutes(spark: SparkSession, d: str) -> DataFrame:
    users = views.user_event_matrix(spark, d).withColumn("flag", F.col("user_id") % 2)
    names = ["v_click", "v_view", "v_purchase", "v_signup"]
    sums = relational.group_sums(users, "flag", {f"s_{n}": n for n in names}, total="total")
    return sums.select("flag", rounded("total", 2).alias("total"))


@query(
    "group_total_charge",
    over(
        "customer_account",
        """SELECT churn, round(sum(acctbal), 2) AS s_acctbal, round(sum(total_price), 2) AS s_price,
                  round(sum(acctbal) + sum(total_price), 2) AS total
           FROM customer_account GROUP BY churn ORDER BY total DESC""",
    ),
)
def group_total_charge(spark: SparkSession, d: str) -> DataFrame:
    sums = relational.group_sums(
        views.customer_account(spark, d), "churn", {"s_acctbal": "acctbal", "s_price": "total_price"}, "total"
    )
    return sums.select("churn", *[rounded(c, 2).alias(c) for c in ("s_acctbal", "s_price", "total")]).orderBy(
        F.desc("total"), "churn"
    )


@query("group_count", over("customer_account", "SELECT churn, count(*) AS n FROM customer_account GROUP BY churn"))
def group_count(spark: SparkSession, d: str) -> DataFrame:
    return views.customer_account(spark, d).groupBy("churn").agg(F.count("*").alias("n"))


@query(
    "group_sum",
    over(
        "customer_account",
        "SELECT churn, CAST(sum(n_urgent) AS BIGINT) AS s_urgent FROM customer_account GROUP BY churn",
    ),
)
def group_sum(spark: SparkSession, d: str) -> DataFrame:
    return relational.group_sums(views.customer_account(spark, d), "churn", {"s_urgent": "n_urgent"})


@query(
    "most_active_users",
    over(
        "ratings",
        "SELECT user_id, count(*) AS n FROM ratings GROUP BY user_id ORDER BY n DESC, user_id LIMIT 10",
    ),
)
def most_active_users(spark: SparkSession, d: str) -> DataFrame:
    counts = views.ratings(spark, d).groupBy("user_id").agg(F.count("*").alias("n"))
    return relational.top_k(counts, 10, F.desc("n"), F.asc("user_id"))


@query(
    "fact_cardinalities",
    over(
        "ratings",
        """SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users,
                  count(DISTINCT item_id) AS n_items FROM ratings""",
    ),
)
def fact_cardinalities(spark: SparkSession, d: str) -> DataFrame:
    return views.ratings(spark, d).agg(
        F.count("*").alias("n_ratings"),
        F.count_distinct("user_id").alias("n_users"),
        F.count_distinct("item_id").alias("n_items"),
    )


_LINE_COLUMNS = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size", "label"]


@query(
    "describe_numeric",
    over(
        "priced_lines",
        "\nUNION ALL\n".join(
            f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) + 0.0 AS mean,
                round(stddev_samp({c}), 4) + 0.0 AS stddev, min({c}) AS min, max({c}) AS max
                FROM priced_lines"""
            for c in _LINE_COLUMNS
        ),
    ),
)
def describe_numeric(spark: SparkSession, d: str) -> DataFrame:
    profile = relational.describe_numeric(views.priced_lines(spark, d), _LINE_COLUMNS)
    return profile.withColumns({"mean": rounded("mean", 4), "stddev": rounded("stddev", 4)})


@query(
    "describe_strings",
    over(
        "customer_account",
        "\nUNION ALL\n".join(
            f"""SELECT '{c}' AS "column", count({c}) AS n, min({c}) AS min, max({c}) AS max
                FROM customer_account"""
            for c in ("plan", "churn")
        ),
    ),
)
def describe_strings(spark: SparkSession, d: str) -> DataFrame:
    accounts = views.customer_account(spark, d)
    return relational.describe_strings(accounts, relational.string_columns(accounts))


# --- set operations ----------------------------------------------------------


@query(
    "union_vocabulary",
    over(
        "customer_account",
        "SELECT plan AS value, count(*) AS n FROM customer_account GROUP BY plan",
    ),
)
def union_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    """The shared vocabulary of a training and a test part, with its frequencies."""
    plans = views.customer_account(spark, d).select("cust_id", F.col("plan").alias("value"))
    train, test = sampling.train_test(plans, ["cust_id"], 0.8, 23579)
    return train.unionByName(test).groupBy("value").agg(F.count("*").alias("n"))


@query(
    "append_ratings",
    over(
        "ratings",
        f"""SELECT user_id, count(*) AS n
            FROM (SELECT user_id, item_id, rating FROM ratings
                  UNION ALL SELECT '{NEW_USER}', CAST(i AS VARCHAR), '10' FROM range(1, 11) t(i))
            GROUP BY user_id""",
    ),
)
def append_ratings(spark: SparkSession, d: str) -> DataFrame:
    more = literal_rows(
        spark, [(NEW_USER, *r) for r in NEW_RATINGS], "user_id string, item_id string, rating string"
    )
    every = views.ratings(spark, d).unionByName(more)
    return every.groupBy("user_id").agg(F.count("*").alias("n"))


# --- scalar functions --------------------------------------------------------


@query("hash_surrogate_key")
def hash_surrogate_key(spark: SparkSession, d: str) -> DataFrame:
    keys = views.items(spark, d).select(F.col("item_id").alias("key"))
    return keys.select("key", scalars.non_negative_hash("key").alias("id"), F.xxhash64("key").alias("id64"))


_MD5 = "CAST(('0x' || substr(md5(CAST({} AS VARCHAR)), 1, 8)) AS BIGINT)"


@query("md5_surrogate_key", f"SELECT CAST(p_partkey AS VARCHAR) AS key, {_MD5.format('p_partkey')} AS id FROM part")
def md5_surrogate_key(spark: SparkSession, d: str) -> DataFrame:
    keys = views.items(spark, d).select(F.col("item_id").alias("key"))
    return keys.select("key", scalars.md5_prefix(F.col("key")).alias("id"))


@query(
    "hash_collisions",
    over(
        "ratings",
        f"""SELECT count(DISTINCT item_id) AS n_distinct_keys,
                   count(DISTINCT {_MD5.format('item_id')}) AS n_distinct_ids FROM ratings""",
    ),
)
def hash_collisions(spark: SparkSession, d: str) -> DataFrame:
    """Distinct keys against distinct 32-bit ids: a difference means merged items."""
    keys = views.ratings(spark, d).select("item_id").distinct()
    ids = keys.groupBy(scalars.md5_prefix(F.col("item_id")).alias("id")).agg(F.count("*").alias("k"))
    return ids.agg(F.sum("k").alias("n_distinct_keys"), F.count("*").alias("n_distinct_ids"))


@query("abs_value", "SELECT c_custkey, abs(c_acctbal) AS abs_balance FROM customer")
def abs_value(spark: SparkSession, d: str) -> DataFrame:
    return views.table(spark, d, "customer").select("c_custkey", F.abs("c_acctbal").alias("abs_balance"))


@query(
    "composite_string_key",
    "SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey) AS key, l_quantity FROM lineitem",
)
def composite_string_key(spark: SparkSession, d: str) -> DataFrame:
    return views.table(spark, d, "lineitem").select(
        scalars.string_key("l_orderkey", "l_linenumber", "l_partkey").alias("key"), "l_quantity"
    )


@query("alt_allele_count", over("genotype", "SELECT sample, variant, alt_count FROM genotype"))
def alt_allele_count(spark: SparkSession, d: str) -> DataFrame:
    """Alternate counts recovered from allele lists."""
    calls = views.genotype(spark, d)
    alleles = F.concat(
        F.array_repeat(F.lit("REF"), 2 - F.col("alt_count")), F.array_repeat(F.lit("ALT"), F.col("alt_count"))
    )
    return calls.select("sample", "variant", alleles.alias("alleles")).select(
        "sample", "variant", scalars.alternate_count("alleles").cast("int").alias("alt_count")
    )


@query(
    "regex_predicate",
    """SELECT p_partkey, p_name, starts_with(p_name, 'small') AS is_small,
              regexp_matches(p_name, '^(small|red) .*(ring|widget)$') AS flag FROM part""",
)
def regex_predicate(spark: SparkSession, d: str) -> DataFrame:
    return views.table(spark, d, "part").select(
        "p_partkey",
        "p_name",
        F.col("p_name").startswith("small").alias("is_small"),
        F.col("p_name").rlike("^(small|red) .*(ring|widget)$").alias("flag"),
    )


@query(
    "semi_join_long_list",
    """SELECT l_orderkey, l_linenumber FROM lineitem
       WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def semi_join_long_list(spark: SparkSession, d: str) -> DataFrame:
    """Lines of urgent orders; a filter made of the orders' keys thins the lines out in their scan."""
    urgent = views.table(spark, d, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    lines = views.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return key_filter.filtered_semi_join(lines, urgent.select(F.col("o_orderkey").alias("l_orderkey")), ["l_orderkey"])

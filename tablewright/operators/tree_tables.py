"""Learned trees as tables of nodes, read from a saved model, and scoring by walking the tables.

A node row says where a row of features goes next, so any engine that can join and recurse can
score with the model; nothing here calls the model itself.
"""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablewright.sources.models import save_model
from tablewright.workspace import materialize, scratch_path

#: Most levels a walk goes down; Spark's own trees have at most 30 levels of splits.
MOST_LEVELS = 31


def tree_nodes(model: Model) -> DataFrame:
    """(tree, weight, node, feature, threshold, categories, left, right, value, impurity, n_rows).

    One row per node, numbered from the root, 0, in preorder.  An inner node has a feature and
    either a threshold (values up to it go left) or, for a feature with categories, the ones
    that go left; a leaf has neither and its children are null.  value is the node's own
    prediction, impurity and n_rows what the fit saw there.  The nodes come from the files of
    the saved model, not from the driver's copy, so a forest of any size is read as a table.
    """
    spark = SparkSession.active()
    path = save_model(model, scratch_path(spark, "tree-model"))
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:  # several trees: their weights stand beside them
        weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "metadata", "weight").drop("metadata")
        rows = data.select(F.col("treeID").alias("tree"), "nodeData.*").join(weights, "tree")
    else:
        rows = data.withColumns({"tree": F.lit(0), "weight": F.lit(1.0)})
    inner = F.col("leftChild") >= 0
    categorical = F.col("split.numCategories") >= 0
    listed = F.col("split.leftCategoriesOrThreshold")
    return rows.select(
        F.col("tree").cast("int").alias("tree"),
        F.col("weight").cast("double").alias("weight"),
        F.col("id").cast("int").alias("node"),
        F.when(inner, F.col("split.featureIndex")).cast("int").alias("feature"),
        F.when(inner & ~categorical, F.get(listed, F.lit(0))).alias("threshold"),
        F.when(inner & categorical, listed).alias("categories"),
        F.when(inner, F.col("leftChild")).cast("int").alias("left"),
        F.when(inner, F.col("rightChild")).cast("int").alias("right"),
        F.col("prediction").cast("double").alias("value"),
        F.col("impurity").cast("double").alias("impurity"),
        F.col("rawCount").cast("bigint").alias("n_rows"),
    )


def _packed(nodes: DataFrame) -> DataFrame:
    """(tree, weight, steps): each tree as one array with a node at the place of its number."""
    step = F.struct("node", "feature", "threshold", "categories", "left", "right", "value")
    return nodes.groupBy("tree", "weight").agg(F.array_sort(F.collect_list(step)).alias("steps"))


def _next(step: Column, features: Column) -> Column:
    value = F.get(features, step["feature"])
    goes_left = F.coalesce(value <= step["threshold"], F.array_contains(step["categories"], value))
    return F.when(goes_left, step["left"]).otherwise(step["right"])


def walk(rows: DataFrame, nodes: DataFrame, features: str = "features") -> DataFrame:
    """(the columns of ``rows``, tree, weight, leaf, value): the leaf each row ends at in each tree.

    ``features`` is an array of doubles.  The trees are as large as the model, whatever the rows,
    and reach them as one value; the walk is a fold over the levels inside the projection, so
    rows are neither joined by node nor shuffled.
    """
    trees = _packed(nodes).agg(F.array_sort(F.collect_list(F.struct("tree", "weight", "steps"))).alias("all"))
    depth = F.sequence(F.lit(1), F.lit(MOST_LEVELS))

    def ending(tree: Column) -> Column:
        def down(at: Column, _: Column) -> Column:
            step = F.get(tree["steps"], at)
            return F.when(step["left"].isNull(), at).otherwise(_next(step, F.col(features)))

        return F.struct(tree["tree"].alias("tree"), tree["weight"].alias("weight"), F.aggregate(depth, F.lit(0), down).alias("leaf"))

    def valued(tree: Column, end: Column) -> Column:
        return end.withField("value", F.get(tree["steps"], end["leaf"])["value"])

    met = rows.select("*", trees.scalar().alias("__trees"))
    ends = met.withColumn("__ends", F.transform("__trees", ending))
    return ends.select(*rows.columns, F.inline(F.zip_with("__trees", "__ends", valued)))


def leaf_counts(walked: DataFrame) -> DataFrame:
    """(tree, leaf, value, n): rows that end at each leaf."""
    return walked.groupBy("tree", "leaf", "value").agg(F.count("*").alias("n"))


def stored_nodes(model: Model) -> DataFrame:
    """``tree_nodes`` written once, for the queries that start from them several times."""
    return materialize(tree_nodes(model), "tree-nodes")

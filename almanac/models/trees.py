"""Fitted trees as a table of nodes, and what can be reckoned from rows that are routed down them."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.sources.staging import staging_path


def node_table(spark: SparkSession, model: Model) -> DataFrame:
    """Nodes of a tree ensemble: tree, node, prediction, left, right, feature, cuts, categories.

    A row goes left where its feature is at most the one cut, or, of a feature with categories, where it is one of the
    cuts. Leaves have nulls in left, right and feature. The model is saved and its own files are read.
    """
    path = staging_path(spark, "trees")
    model.write().save(path)
    inner = F.col("nodeData.leftChild") >= 0
    split = F.col("nodeData.split")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"), F.col("nodeData.prediction").alias("prediction"),
        F.when(inner, F.col("nodeData.leftChild")).alias("left"), F.when(inner, F.col("nodeData.rightChild")).alias("right"),
        F.when(inner, split["featureIndex"]).alias("feature"), split["leftCategoriesOrThreshold"].alias("cuts"),
        split["numCategories"].alias("categories"),
    )


def _value(rows: DataFrame, features: str, number: Column) -> Column:
    """A feature of a row by its number, from an array, a vector, or the stored columns of a sparse vector.

    A vector becomes an array, which suits narrow ones; wide ones are best given as stored.
    """
    kind = rows.schema[features].dataType
    if isinstance(kind, T.StructType):
        place = F.array_position(F.col(features)["indices"], number)
        return F.when(place > 0, F.get(F.col(features)["values"], place.cast("int") - 1)).otherwise(0.0)
    return F.get(vector_to_array(features) if isinstance(kind, VectorUDT) else F.col(features), number)


def routed(rows: DataFrame, nodes: DataFrame, features: str = "features") -> DataFrame:
    """Every row with every tree: tree, and path, the nodes that it passes from the root to a leaf.

    A level is a join with the nodes, which are few beside the rows. Nothing is grouped on the way, so no node or feature is
    one task's work. The depth and the number of trees, two numbers, are read on the driver.
    """
    inner = nodes.filter("feature IS NOT NULL").select(
        F.col("tree").alias("_tree"), F.col("node").alias("_node"), "left", "right", "feature", "cuts", "categories"
    )
    trees = nodes.agg(F.max("tree").alias("n")).head().n
    if trees is None:
        return rows.withColumns({"tree": F.lit(0), "path": F.array(F.lit(0))}).limit(0)
    walking = rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees)))).withColumn("path", F.array(F.lit(0)))
    value = _value(rows, features, F.col("feature"))
    left = F.when(F.col("categories") >= 0, F.array_contains("cuts", value)).otherwise(value <= F.col("cuts")[0])
    after = F.when(left, F.col("left")).otherwise(F.col("right"))
    for _ in range(_depth(nodes)):
        at = (F.col("tree") == F.col("_tree")) & (F.element_at("path", -1) == F.col("_node"))
        moved = F.when(F.col("feature").isNotNull(), F.concat("path", F.array(after))).otherwise(F.col("path"))
        walking = walking.join(inner, at, "left").withColumn("path", moved).select(*rows.columns, "tree", "path")
    return walking


def _depth(nodes: DataFrame) -> int:
    """Longest way from a root to a leaf: one join a level, on a table of nodes."""
    edges = nodes.filter("feature IS NOT NULL").select("tree", F.explode(F.array("left", "right")).alias("node"), F.col("node").alias("above"))
    depth, level = 0, nodes.filter("node = 0 AND feature IS NOT NULL").select("tree", "node")
    while not level.isEmpty():
        depth += 1
        below = edges.join(level.withColumnRenamed("node", "above"), ["tree", "above"]).select("tree", "node")
        level = below.join(nodes.filter("feature IS NOT NULL").select("tree", "node"), ["tree", "node"])
    return depth


def spread(n: Column, s: Column, ss: Column, kind: str) -> Column:
    """Impurity times rows of a node with n rows, sum s and sum of squares ss of its label.

    ``kind`` is "variance", or "gini" for labels of 0 and 1.
    """
    return 2 * (s - s * s / n) if kind == "gini" else ss - s * s / n


def split_gains(rows: DataFrame, nodes: DataFrame, label: str, kind: str, features: str = "features") -> DataFrame:
    """What each split takes away from the impurity of the rows that reach it: tree, node, feature, n, gain.

    Rows are summed per node on their path, which combines before its one shuffle; the sums of a node and of the two below
    it then give its gain. Unlike what the model keeps, it is about these rows, which may be others than it was fitted on.
    """
    y = F.col(label).cast("double")
    passed = routed(rows.select(features, y.alias("y")), nodes, features)
    sums = passed.select("tree", "y", F.explode("path").alias("node")).groupBy("tree", "node").agg(
        F.count("*").alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("ss")
    )
    impure = sums.select("tree", "node", "n", spread(F.col("n"), F.col("s"), F.col("ss"), kind).alias("impurity"))
    below = impure.select("tree", F.col("node").alias("child"), F.col("impurity").alias("rest"))
    children = nodes.filter("feature IS NOT NULL").select("tree", "node", "feature", F.explode(F.array("left", "right")).alias("child"))
    rest = children.join(below, ["tree", "child"], "left").groupBy("tree", "node", "feature").agg(
        F.sum(F.coalesce("rest", F.lit(0.0))).alias("rest")
    )
    return rest.join(impure, ["tree", "node"]).select(
        "tree", "node", "feature", "n", (F.col("impurity") - F.col("rest")).alias("gain")
    )


def importances(gains: DataFrame) -> DataFrame:
    """Share of each feature in the gains of its tree, averaged over the trees that split: feature, score."""
    per_tree = gains.groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
    totals = per_tree.groupBy("tree").agg(F.sum("gain").alias("total")).filter("total > 0")
    shares = per_tree.join(totals, "tree").groupBy("feature").agg(F.sum(F.col("gain") / F.col("total")).alias("share"))
    trees = totals.agg(F.count("*").alias("trees")).scalar()
    return shares.select("feature", (F.col("share") / trees).alias("score"))

"""Fitted trees as a relation of node rows, and scoring by joins with it.

A saved ensemble holds a row per node. Scoring starts every input row at the root of each tree and goes down
one level per join: a row meets the node it is at, compares one feature and moves to a child; rows at a leaf
stay. The node table's size is bounded by the ensemble (trees × 2^depth), not by the data; it is counted
before it is broadcast. Rows × trees are summed up where they are, before the one shuffle by row key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.operators.joins import broadcast_if_small

NODES = ("tree int, node int, feature int, threshold double, categories array<double>, left int, right int, "
         "value double, stats array<double>, weight double")


def node_rows(spark: SparkSession, model_path: str) -> DataFrame:
    """The node relation of a saved pipeline's tree ensemble; leaves have no feature and no children.

    A split has a threshold, or the categories that go left.
    """
    stage = f"{model_path}/stages/*Classifier_*"
    trees = spark.read.parquet(f"{stage}/treesMetadata").toDF("tree", "metadata", "weight").select("tree", "weight")
    data = spark.read.parquet(f"{stage}/data").toDF("tree", "data").select("tree", "data.*")
    inner = F.col("leftChild") >= 0
    part = lambda c: F.when(inner, c)
    ranged, sides = F.col("split.numCategories") == -1, F.col("split.leftCategoriesOrThreshold")
    return data.select(
        "tree", F.col("id").alias("node"), part(F.col("split.featureIndex")).alias("feature"),
        F.when(inner & ranged, sides[0]).alias("threshold"), F.when(inner & ~ranged, sides).alias("categories"),
        part(F.col("leftChild")).alias("left"), part(F.col("rightChild")).alias("right"),
        F.col("prediction").alias("value"), F.col("impurityStats").alias("stats"),
    ).join(trees, "tree").select([c.split()[0] for c in NODES.split(", ")])


def leaves(rows: DataFrame, nodes: DataFrame, depth: int, key: str = "key", features: str = "features") -> DataFrame:
    """key and leaf (tree, value, stats, weight) of every row in every tree; ``features`` is an array."""
    nodes = broadcast_if_small(nodes)
    splits = nodes.where("feature IS NOT NULL").select(
        F.col("tree").alias("_tree"), F.col("node").alias("_node"), "feature", "threshold", "categories", "left", "right")
    roots = sorted(r["tree"] for r in nodes.where("node = 0").select("tree").collect())
    at = rows.select(key, features, F.explode(F.lit(roots)).alias("tree"), F.lit(0).alias("node"))
    for _ in range(depth):
        here = at.join(splits, (F.col("tree") == F.col("_tree")) & (F.col("node") == F.col("_node")), "left")
        value = F.get(features, F.col("feature"))
        goes_left = F.when(F.col("categories").isNull(), value <= F.col("threshold")).otherwise(
            F.array_contains("categories", value))
        child = F.when(goes_left, F.col("left")).otherwise(F.col("right"))
        at = here.select(key, features, "tree", F.coalesce(child, F.col("node")).alias("node"))
    ends = nodes.where("feature IS NULL").select("tree", "node", "value", "stats", "weight")
    return at.drop(features).join(ends, ["tree", "node"]).drop("node")


def forest_scores(found: DataFrame, classes: int = 2, key: str = "key") -> DataFrame:
    """Prediction and chance of class 1: each tree's leaf votes by its shares of the classes."""
    share = [F.col("stats")[c] / F.aggregate("stats", F.lit(0.0), lambda a, s: a + s) for c in range(classes)]
    votes = found.groupBy(key).agg(*[F.sum(s).alias(f"v{c}") for c, s in enumerate(share)])
    names = [f"v{c}" for c in range(classes)]
    top = F.array_position(F.array(*names), F.array_max(F.array(*names))) - 1
    total = reduce(lambda a, b: a + b, [F.col(n) for n in names])
    return votes.select(key, top.cast("double").alias("prediction"), (F.col("v1") / total).alias("chance"))


def boosting_scores(found: DataFrame, key: str = "key") -> DataFrame:
    """Prediction and chance of class 1: the logistic of twice the weighted sum of the trees."""
    margin = found.groupBy(key).agg(F.sum(F.col("weight") * F.col("value")).alias("m"))
    return margin.select(
        key, F.when(F.col("m") > 0, 1.0).otherwise(0.0).alias("prediction"),
        (1.0 / (1.0 + F.exp(-2.0 * F.col("m")))).alias("chance"))


def relation_scores(model: PipelineModel, nodes: DataFrame, rows: DataFrame, key: str = "key") -> DataFrame:
    """key, prediction and chance by the node relation, as ``model.transform`` gives them."""
    classifier = model.stages[-1]
    featured = PipelineModel(model.stages[:-1]).transform(rows).select(key, vector_to_array("features").alias("features"))
    found = leaves(featured, nodes, classifier.getOrDefault("maxDepth"), key)
    return (boosting_scores if "GBT" in type(classifier).__name__ else forest_scores)(found, key=key)

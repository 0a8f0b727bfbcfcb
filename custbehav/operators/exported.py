"""Fitted models as rows, and what they determine, in plain joins and expressions.

The rows (centres and scales of the segments, nodes of the trees) are bounded by the models' parameters. They let any SQL
engine score users, and they check the fitted pipelines: a user's segment is the nearest centre, the probability of churn is
the mean of the leaves that the user reaches, and a feature's importance is its share of the trees' gains.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from custbehav.config import CHURN_FEATURES, CLUSTERING_FEATURES


def segment_centres(spark: SparkSession, pipeline: PipelineModel) -> DataFrame:
    """One row per cluster: its centre, and per feature the mean and deviation that scale a user to it."""
    _, scaler, model = pipeline.stages
    scale = [scaler.mean.toArray().tolist(), scaler.std.toArray().tolist()]
    rows = [(i, centre.tolist(), *scale) for i, centre in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cluster int, centre array<double>, means array<double>, deviations array<double>")


def nearest_centre(users: DataFrame, centres: DataFrame) -> DataFrame:
    """``user_id`` and the cluster whose centre is nearest, with its squared distance and that of the next one."""
    def distance(c: Column) -> Column:
        terms = []
        for i, name in enumerate(CLUSTERING_FEATURES):
            deviation = F.get(c["deviations"], F.lit(i))
            # A feature without deviation is scaled to zero.
            scaled = F.when(deviation == 0, 0e0).otherwise((F.col(name).cast("double") - F.get(c["means"], F.lit(i))) / deviation)
            terms.append((scaled - F.get(c["centre"], F.lit(i))) * (scaled - F.get(c["centre"], F.lit(i))))
        return reduce(lambda a, b: a + b, terms)

    known = centres.agg(F.sort_array(F.collect_list(F.struct("cluster", "centre", "means", "deviations"))).alias("_centres"))
    ranked = F.array_sort(F.transform("_centres", lambda c: F.struct(distance(c).alias("d"), c["cluster"].alias("cluster"))))
    placed = users.withColumn("_centres", known.scalar()).select("user_id", ranked.alias("r"))
    first, second = F.get("r", F.lit(0)), F.get("r", F.lit(1))
    return placed.select("user_id", first["cluster"].alias("nearest"), first["d"].alias("distance"), second["d"].alias("next_distance"))


def tree_nodes(pipeline: PipelineModel, path: str) -> DataFrame:
    """Save the forest below ``path`` and read its nodes: one row per tree and node, leaves without children."""
    forest = pipeline.stages[-1]
    forest.save(path)
    spark = SparkSession.getActiveSession()
    node = F.col("nodeData")
    total = F.aggregate(node["impurityStats"], F.lit(0e0), lambda acc, x: acc + x)
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"),
        F.when(node["leftChild"] >= 0, node["leftChild"]).alias("left"),
        F.when(node["leftChild"] >= 0, node["rightChild"]).alias("right"),
        F.when(node["leftChild"] >= 0, node["split"]["featureIndex"]).alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        (F.get(node["impurityStats"], F.lit(1)) / total).alias("share"),
        (node["gain"] * total).alias("gain"),
    )


def mean_of_trees(users: DataFrame, nodes: DataFrame, depth: int) -> DataFrame:
    """``user_id`` and the mean share of churners in the leaves the user reaches.

    Every user goes down all trees at once, a level per join; the nodes are broadcast, at most
    2 ** (depth + 1) per tree, so no user is moved before the last sum.
    """
    values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0e0)) for c in CHURN_FEATURES])
    trees = F.broadcast(nodes.select("tree").distinct())
    # The sides are all users and the trees of the model, whose number is a parameter.
    at = users.select("user_id", values.alias("x")).join(trees, F.lit(True)).withColumn("node", F.lit(0))
    for _ in range(depth):
        step = F.when(F.col("feature").isNull(), F.col("node")).when(
            F.get("x", F.col("feature")) <= F.col("threshold"), F.col("left")
        ).otherwise(F.col("right"))
        at = at.join(F.broadcast(nodes), ["tree", "node"]).select("user_id", "x", "tree", step.alias("node"))
    leaves = at.join(F.broadcast(nodes.select("tree", "node", "share")), ["tree", "node"])
    return leaves.groupBy("user_id").agg(F.avg("share").alias("mean_share"))


def importance_of_nodes(nodes: DataFrame) -> DataFrame:
    """Importance per feature used: its share of the gains, per tree and then over the trees."""
    splits = nodes.filter("feature is not null")
    per_tree = splits.groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
    totals = splits.groupBy("tree").agg(F.sum("gain").alias("total"))
    shares = per_tree.join(totals, "tree").groupBy("feature").agg(F.sum(F.col("gain") / F.col("total")).alias("share"))
    total = shares.agg(F.sum("share")).scalar()
    name = F.element_at(F.array(*[F.lit(c) for c in CHURN_FEATURES]), F.col("feature") + 1)
    return shares.select(name.alias("feature"), (F.col("share") / total).alias("importance"))

"""Customer segmentation: standardised features, K-means with restarts, silhouette, personas. All over all users."""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from custbehav.config import CLUSTERING_FEATURES, PipelineConfig
from custbehav.functions.columns import round_half_up

# Texts of the personas.
FALLBACK_STRATEGY = "Standard marketing campaign"
BUYERS_STRATEGY = "Retention and relevant product recommendations"
VIEWERS_STRATEGY = "Product discovery and first-purchase offers"
PERSONA = "Segment %d: avg purchases $%.2f, %.0f events"


@dataclass
class SegmentModel:
    pipeline: PipelineModel
    personas: DataFrame
    summary: DataFrame
    training_rows: int


def check_segment_input(features: DataFrame, cfg: PipelineConfig) -> int:
    """Number of users; refuses too few users or too few distinct feature vectors."""
    users = features.count()
    distinct = features.select(*CLUSTERING_FEATURES).distinct().limit(cfg.n_clusters).count()
    if users <= cfg.n_clusters or distinct < cfg.n_clusters:
        raise ValueError(
            f"{cfg.n_clusters} segments need more users than that and as many distinct feature vectors; there are {users} users"
        )
    return users


def _best_kmeans(scaled: DataFrame, cfg: PipelineConfig):
    """Restart with ``n_init`` seeds and keep the lowest cost. Small jobs, so several run at a time."""
    estimator = KMeans(k=cfg.n_clusters, featuresCol="scaled", predictionCol="cluster")
    starts = [{estimator.seed: cfg.seed + i} for i in range(cfg.n_init)]

    def fit(start):
        model = estimator.fit(scaled, start)
        return model.summary.trainingCost, start[estimator.seed], model

    with ThreadPool(min(8, cfg.n_init)) as pool:
        fitted = pool.map(inheritable_thread_target(scaled.sparkSession)(fit), starts)
    return min(fitted, key=lambda one: one[:2])[2]


def silhouette(points: DataFrame) -> float:
    """Mean silhouette with squared Euclidean distance over all rows (``scaled``, ``cluster``); 0 for one cluster.

    It takes sums per cluster only: one pass adds them up and one scores every row against them.
    """
    if points.select("cluster").distinct().limit(2).count() < 2:
        return 0.0
    evaluator = ClusteringEvaluator(featuresCol="scaled", predictionCol="cluster", distanceMeasure="squaredEuclidean")
    return evaluator.evaluate(points)


def scaling(features: DataFrame) -> PipelineModel:
    """Assembles the clustering features and scales them to mean 0 and sample deviation 1."""
    assembler = VectorAssembler(inputCols=list(CLUSTERING_FEATURES), outputCol="vector")
    scaler = StandardScaler(inputCol="vector", outputCol="scaled", withMean=True)
    return PipelineModel([assembler, scaler.fit(assembler.transform(features))])


def cluster_summary(assigned: DataFrame) -> DataFrame:
    """Users and mean behaviour per cluster."""
    mean = lambda name: round_half_up(F.avg(name), 2).alias(name)
    return assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("users"), mean("total_spent"), mean("total_events"), mean("events_per_day")
    )


def personas(summary: DataFrame) -> DataFrame:
    """Name and strategy per cluster, from the cluster's statistics and never from its number alone."""
    name = F.format_string(
        PERSONA, "cluster", "total_spent", F.rint("total_events")
    )
    strategy = F.when(F.col("total_spent") > 0, BUYERS_STRATEGY).otherwise(VIEWERS_STRATEGY)
    return summary.withColumns({"persona_name": name, "marketing_strategy": strategy})


def train_segments(features: DataFrame, cfg: PipelineConfig) -> SegmentModel:
    """Fit on all users of ``features``."""
    users = check_segment_input(features, cfg)
    wanted = features.select("user_id", *CLUSTERING_FEATURES)
    scaler = scaling(wanted)
    scaled = scaler.transform(wanted).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = _best_kmeans(scaled, cfg)
        assigned = model.transform(scaled)
        # A handful of rows that later jobs join: kept as a literal table instead of a plan over all users.
        rows = cluster_summary(assigned).orderBy("cluster").collect()
    finally:
        scaled.unpersist()
    spark = features.sparkSession
    summary = spark.createDataFrame(rows, "cluster int, users long, total_spent double, total_events double, events_per_day double")
    return SegmentModel(
        PipelineModel([*scaler.stages, model]), personas(summary), summary, users
    )


def assign_segments(users: DataFrame, pipeline: PipelineModel, known: DataFrame) -> DataFrame:
    """Add cluster, persona and strategy; ``known`` has one row per cluster, so no user is moved."""
    labels = known.select("cluster", "persona_name", "marketing_strategy")
    assigned = pipeline.transform(users).join(F.broadcast(labels), "cluster", "left")
    return assigned.select(
        *users.columns,
        F.col("cluster").alias("cluster_id"),
        F.coalesce("persona_name", F.format_string("Segment %d", "cluster")).alias("persona_name"),
        F.coalesce("marketing_strategy", F.lit(FALLBACK_STRATEGY)).alias("marketing_strategy"),
    )

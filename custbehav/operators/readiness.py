"""Whether cohorts of users can be trained on, all cohorts in one job, with the reason where one cannot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from custbehav.config import CLUSTERING_FEATURES, PipelineConfig

# Reasons of a refusal.
FEW_USERS = "not more users than segments"
FEW_VECTORS = "fewer distinct feature vectors than segments"
SEES_LABEL = "the features see the label period"
FEW_TO_LEARN = "fewer than ten users"
ONE_CLASS = "fewer than two users of a class"


def training_readiness(features: DataFrame, cohort: str, cfg: PipelineConfig) -> DataFrame:
    """Per cohort its users, distinct feature vectors and classes, and why it is refused for either model.

    ``features`` are those of the churn model. Users are first added up per cohort, class and feature vector, so a
    cohort that holds most users is reduced before it is counted; a null cohort is one of its own.
    """
    users = F.count(F.lit(1))
    vectors = features.groupBy(cohort, *CLUSTERING_FEATURES).agg(
        users.alias("users"),
        F.count_if(F.col("churned") == 1).alias("churned"),
        F.count_if(F.col("churned") == 0).alias("retained"),
        F.count_if(~F.col("feature_mode").eqNullSafe("held_out")).alias("leaking"),
    )
    sums = [F.sum(c).alias(c) for c in ("users", "churned", "retained", "leaking")]
    cohorts = vectors.groupBy(cohort).agg(*sums, F.count(F.lit(1)).alias("vectors"))
    segments = F.when(F.col("users") <= cfg.n_clusters, FEW_USERS).when(F.col("vectors") < cfg.n_clusters, FEW_VECTORS)
    churn = (
        F.when(F.col("leaking") > 0, SEES_LABEL)
        .when(F.col("churned") + F.col("retained") < 10, FEW_TO_LEARN)
        .when(F.least("churned", "retained") < 2, ONE_CLASS)
    )
    return cohorts.select(
        cohort, "users", "vectors", "churned", "retained",
        segments.alias("segment_refusal"), churn.alias("churn_refusal"),
    )

"""The stages from raw files to profiles, each reading and writing tables of one event store."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from custbehav.config import CLUSTERING_FEATURES, PipelineConfig
from custbehav.operators import churn, features, monitoring, profiles, recommend, segments, silhouette
from custbehav.plans import models
from custbehav.plans.export import export
from custbehav.plans.ingest import ingest
from custbehav.sources import versions
from custbehav.sources.store import EventStore


def run_etl(store: EventStore, folder: str, cfg: PipelineConfig, **options) -> list[dict]:
    """Load all sources and export the events."""
    results = ingest(store, folder, cfg, **options)
    export(store.events(), store.path("exports", "events"))
    return results


def run_ml(store: EventStore, cfg: PipelineConfig, sample_users: int | None = None) -> dict[str, dict]:
    """Feature tables, both models and the recommendation table, of all users unless a sample is asked for."""
    events = store.events()
    if events.isEmpty():
        raise RuntimeError("no events are stored yet: load sources first (run_etl)")
    described = store.replace_table("user_features", features.user_features(events, cfg, sample_size=sample_users))
    segmentation = segments.train_segments(described, cfg)
    assigned = segmentation.pipeline.transform(described.select("user_id", *CLUSTERING_FEATURES))
    scores = silhouette.mean_silhouettes(assigned.withColumn("vector", vector_to_array("scaled")), cfg)
    models.register_segments(store, segmentation, scores, cfg)

    held_out = store.replace_table(
        "churn_features", features.user_features(events, cfg, for_churn=True, sample_size=sample_users)
    )
    trained = churn.train_churn(held_out, cfg)
    cutoff = held_out.select(F.col("label_cutoff").cast("string")).first()[0]
    models.register_churn(store, trained, cutoff, cfg)

    store.replace_table("product_recommendations", recommend.top_products(events, cfg))
    return {"segmentation": {"silhouette_score": scores["silhouette_euclidean"], **scores}, "churn": trained.metrics}


def score_users(users: DataFrame, store: EventStore, cfg: PipelineConfig) -> DataFrame:
    """Serving features with segment, churn risk and recommendations added; no join moves a user."""
    pipeline, personas = models.load_segments(store, cfg)
    segmented = segments.assign_segments(users, pipeline, personas)
    risky = profiles.churn_report(churn.score_churn(segmented, models.load_churn(store, cfg)))
    return recommend.user_recommendations(risky, store.table("product_recommendations"), cfg)


def run_scoring(store: EventStore, cfg: PipelineConfig) -> DataFrame:
    """Customer-360 table of all users, ranged by user so that one profile is found in one file.

    The features are ranged when they are written; scoring keeps rows where they are, so each user is scored once.
    """
    ranged = features.serving_features(store.events(), cfg).repartitionByRange("user_id").sortWithinPartitions("user_id")
    users = store.replace_table("serving_features", ranged)
    return store.replace_table("customer_360", profiles.customer_360(score_users(users, store, cfg)))


def run_campaign(store: EventStore, requests: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """One row per request (``position, requested_id``) with its status and, where found, the campaign scores.

    Status is SUCCESS, NOT_FOUND or INVALID. A user who is asked for more than once is scored once and
    answered each time.
    """
    users = store.table("serving_features")
    wanted = requests.filter(profiles.valid_request(F.col("requested_id"))).select(
        F.col("requested_id").cast("bigint").alias("user_id")
    )
    chosen = users.join(wanted, "user_id", "left_semi")
    return profiles.resolve_requests(requests, profiles.campaign_scores(score_users(chosen, store, cfg)))


def run_monitoring(store: EventStore, cfg: PipelineConfig) -> DataFrame:
    """Write the health snapshot and return the open alerts."""
    events = store.events() if store.has_events() else None
    registry, run_log = store.log("registry"), store.log("run_log")
    tables = {
        "events": events, "ingestion_manifest": store.log("manifest"), "pipeline_metadata": run_log,
        "data_quality_reports": store.log("quality_log"), "model_performance": registry,
        "product_recommendations": store.table("product_recommendations"),
    }
    found = monitoring.alerts(events, registry, run_log, cfg)
    folders = {**{name: name for name in tables}, "ingestion_manifest": "manifest", "pipeline_metadata": "run_log",
               "data_quality_reports": "quality_log", "model_performance": "registry"}
    sizes = {name: versions.size(store.spark, store.path(folder)) for name, folder in folders.items()}
    counts = monitoring.with_sizes(monitoring.table_counts(tables), sizes)
    snapshot = monitoring.health_snapshot(counts, registry, found, cfg)
    versions.publish(snapshot.coalesce(1), store.path("monitoring", "latest_health"), "json")
    return found

"""Model registry: archived versions, their metrics, and the guard on the feature schema."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from custbehav.config import CHURN_FEATURES, CHURN_MODEL, CLUSTERING_FEATURES, SEGMENT_MODEL, PipelineConfig
from custbehav.operators.churn import ChurnModel
from custbehav.operators.segments import SegmentModel
from custbehav.operators.monitoring import latest_per_key
from custbehav.sources.store import EventStore


def register(
    store: EventStore, name: str, algorithm: str, pipeline: PipelineModel, metrics: dict[str, float],
    parameters: dict[str, str], cfg: PipelineConfig, personas: DataFrame | None = None,
) -> str:
    """Save a model under a new version; the registry row, written last, makes it current."""
    now = datetime.now(timezone.utc)
    version = now.strftime("%Y%m%dT%H%M%S%f")
    path = store.path("models", name, version)
    pipeline.save(f"{path}/pipeline")
    if personas is not None:
        personas.coalesce(1).write.parquet(f"{path}/personas")
    store.append_row(
        "registry", model_name=name, version=version, algorithm=algorithm, metrics=metrics, parameters=parameters,
        artifact_path=path, feature_schema_version=cfg.feature_schema_version, trained_at=now,
    )
    return version


def register_segments(store: EventStore, model: SegmentModel, scores: dict[str, float], cfg: PipelineConfig) -> str:
    """``scores`` are the silhouettes; the one of plain distances is the model's ``silhouette_score``."""
    return register(
        store, SEGMENT_MODEL, "KMeans", model.pipeline,
        {
            "silhouette_score": round(scores["silhouette_euclidean"], 4),
            "silhouette_squared": round(scores["silhouette_squared"], 4), "training_samples": float(model.training_rows),
        },
        {"n_clusters": str(cfg.n_clusters), "features": ",".join(CLUSTERING_FEATURES)}, cfg, model.personas,
    )


def register_churn(store: EventStore, model: ChurnModel, cutoff: str, cfg: PipelineConfig) -> str:
    return register(
        store, CHURN_MODEL, "RandomForestClassifier", model.pipeline, model.metrics,
        {
            "n_estimators": str(cfg.n_trees), "max_depth": str(cfg.tree_depth),
            "features": ",".join(CHURN_FEATURES), "label_cutoff": cutoff,
        },
        cfg,
    )


def current_models(registry: DataFrame) -> DataFrame:
    """Latest entry per model."""
    return latest_per_key(registry, "model_name", "version")


def load_verdicts(registry: DataFrame, names: tuple[str, ...], cfg: PipelineConfig) -> DataFrame:
    """Per wanted model its current entry and whether it can be loaded: LOADABLE, STALE or MISSING."""
    wanted = registry.sparkSession.createDataFrame([(name,) for name in names], "model_name string")
    entries = current_models(registry.join(F.broadcast(wanted), "model_name", "left_semi"))
    verdict = (
        F.when(F.col("version").isNull(), "MISSING")
        .when(F.col("feature_schema_version").eqNullSafe(cfg.feature_schema_version), "LOADABLE")
        .otherwise("STALE")
    )
    return wanted.join(entries, "model_name", "left").withColumn("verdict", verdict)


def current_path(store: EventStore, name: str, cfg: PipelineConfig) -> str:
    """Folder of the current version; refuses one trained on another feature schema."""
    entry = load_verdicts(store.log("registry"), (name,), cfg).first()
    if entry["verdict"] == "MISSING":
        raise LookupError(f"no version of {name} is registered")
    if entry["verdict"] == "STALE":
        raise RuntimeError(f"{name} was trained on another feature schema, train it anew")
    return entry["artifact_path"]


def load_segments(store: EventStore, cfg: PipelineConfig) -> tuple[PipelineModel, DataFrame]:
    path = current_path(store, SEGMENT_MODEL, cfg)
    return PipelineModel.load(f"{path}/pipeline"), store.spark.read.parquet(f"{path}/personas")


def load_churn(store: EventStore, cfg: PipelineConfig) -> PipelineModel:
    return PipelineModel.load(f"{current_path(store, CHURN_MODEL, cfg)}/pipeline")

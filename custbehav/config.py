"""Every constant of the engine in one frozen object."""

from __future__ import annotations

from dataclasses import dataclass

# Names that input files, models and reports must share.
EVENT_TYPES = ("view", "cart", "remove_from_cart", "purchase")
SOURCE_FILES = ("2019-Oct.csv", "2019-Nov.csv", "2019-Dec.csv", "2020-Jan.csv", "2020-Feb.csv")
CRITICAL_COLUMNS = ("event_time", "event_type", "product_id", "user_id")
CLUSTERING_FEATURES = ("total_events", "total_spent", "avg_spent", "unique_products", "events_per_day")
CHURN_FEATURES = (
    "total_events", "total_spent", "avg_spent", "unique_products", "total_views",
    "unique_categories", "days_active", "events_per_day", "purchase_rate",
)
SEGMENT_MODEL = "customer_segmentation_kmeans"
CHURN_MODEL = "churn_prediction_rf"


@dataclass(frozen=True)
class PipelineConfig:
    # Limits, rates and sizes that results must share with other runs of the same data.

    # Input
    source_files: tuple[str, ...] = SOURCE_FILES
    event_types: tuple[str, ...] = EVENT_TYPES
    min_event_date: str = "2019-10-01"
    max_event_date: str = "2020-02-29"
    min_session_length: int = 10
    rows_per_chunk: int = 100_000
    etl_version: str = "etl-v2"

    # Quality gate
    max_null_rate: float = 0.05
    min_price: float = 0.01
    min_type_rate: float = 0.95
    min_price_rate: float = 0.95
    min_date_rate: float = 0.95
    min_session_rate: float = 0.90
    outlier_quantile: float = 0.99

    # Features and models
    inactive_days: int = 30
    seed: int = 42
    feature_schema_version: str = "2.0"
    n_clusters: int = 5
    n_init: int = 10
    n_trees: int = 50
    tree_depth: int = 8
    test_share: float = 0.2

    # Recommendations and profiles
    top_n_per_category: int = 10
    recommended_items: int = 5
    default_category: str = "electronics"

    # Marts
    popular_brands: int = 3

"""Monitoring over the log tables: latest states, alerts, trends, table inventory, health snapshot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from custbehav.config import CHURN_MODEL, SEGMENT_MODEL, PipelineConfig

EXPECTED_MODELS = (SEGMENT_MODEL, CHURN_MODEL)


def latest_per_key(log: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the greatest ``order`` per key, as a map-side combined aggregate."""
    newest = F.max_by(F.struct(*log.columns), order).alias("_row")
    return log.groupBy(key).agg(newest).select("_row.*")


def run_history(log: DataFrame, limit: int = 20) -> DataFrame:
    return log.orderBy(F.desc("id")).limit(limit)


def table_counts(tables: dict[str, DataFrame | None]) -> DataFrame:
    """Row count per table; a table that does not exist yet counts 0."""
    existing = [df for df in tables.values() if df is not None]
    spark = existing[0].sparkSession

    def one(name: str, df: DataFrame | None) -> DataFrame:
        if df is None:
            return spark.createDataFrame([(name, 0)], "table_name string, row_count long")
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")

    return reduce(DataFrame.unionByName, [one(name, df) for name, df in tables.items()])


def with_sizes(counts: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """Add ``size_mb`` per table, from the bytes its files take, and the row ``store`` with the sums of all."""
    spark = counts.sparkSession
    known = spark.createDataFrame([(name, n / 1e6) for name, n in sizes.items()], "table_name string, size_mb double")
    tables = counts.join(known, "table_name", "left").fillna(0.0, subset=["size_mb"])
    total = tables.agg(F.sum("row_count").alias("row_count"), F.sum("size_mb").alias("size_mb"))
    return tables.unionByName(total.select(F.lit("store").alias("table_name"), "row_count", "size_mb"))


def schema_currency(registry: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Per expected model whether its latest entry exists and has the current feature schema."""
    spark = registry.sparkSession
    expected = spark.createDataFrame([(name,) for name in EXPECTED_MODELS], "model_name string")
    latest = latest_per_key(registry, "model_name", "version").select("model_name", "feature_schema_version")
    return expected.join(latest.withColumn("_known", F.lit(True)), "model_name", "left").select(
        "model_name",
        F.coalesce("_known", F.lit(False)).alias("registered"),
        F.coalesce(F.col("feature_schema_version") == cfg.feature_schema_version, F.lit(False)).alias("schema_current"),
    )


# Texts of the alerts.
NO_STORE = "Event store not found. ETL ingestion required."
NO_EVENTS = "Events table is currently empty."
MISSING_MODELS = "Missing trained model artifacts: "
STALE_MODELS = "Models need retraining for the current feature schema."
BAD_RUN = ". Inspect raw quality reports; invalid rows are excluded during cleaning."


def _alert(rows: DataFrame, severity: Column | str, component: Column | str, message: Column) -> DataFrame:
    as_column = lambda x: F.lit(x) if isinstance(x, str) else x
    return rows.select(
        as_column(severity).alias("severity"), as_column(component).alias("component"), message.alias("message")
    )


def alerts(events: DataFrame | None, registry: DataFrame, run_log: DataFrame | None, cfg: PipelineConfig) -> DataFrame:
    """Alerts of all rules. ``events`` and ``run_log`` are None while their tables do not exist."""
    spark = registry.sparkSession
    found = []
    if events is None:
        found.append(
            _alert(spark.range(1), "CRITICAL", "Database", F.lit(NO_STORE))
        )
    else:
        any_row = events.limit(1).agg(F.count(F.lit(1)).alias("n"))
        found.append(_alert(any_row.filter("n = 0"), "WARNING", "Database", F.lit(NO_EVENTS)))

    state = schema_currency(registry, cfg).agg(
        F.array_sort(F.collect_list(F.when(~F.col("registered"), F.col("model_name")))).alias("missing"),
        F.bool_and("schema_current").alias("current"),
    )
    found.append(
        _alert(
            state.filter(F.size("missing") > 0), "HIGH", "ModelRegistry",
            F.concat(F.lit(MISSING_MODELS), F.concat_ws(", ", "missing")),
        )
    )
    found.append(
        _alert(
            state.filter(~F.col("current")), "HIGH", "ModelSchema",
            F.lit(STALE_MODELS),
        )
    )
    if run_log is not None:
        bad = latest_per_key(run_log.select("id", "source_file", "status"), "source_file", "id").filter(
            F.col("status").isin("FAILED", "QUALITY_WARNING")
        )
        failed = F.col("status") == "FAILED"
        found.append(
            _alert(
                bad,
                F.when(failed, "HIGH").otherwise("WARNING"),
                F.when(failed, "ETLPipeline").otherwise("DataQualityGate"),
                F.concat(
                    "source_file", F.lit(": "), "status",
                    F.lit(BAD_RUN),
                ),
            )
        )
    return reduce(DataFrame.unionByName, found)


def quality_trend(quality_log: DataFrame, minimum: float = 95.0) -> DataFrame:
    """Completeness and valid sessions per source over time, in percent, beside the minimum."""
    return quality_log.select(
        "id",
        "source_file",
        (F.col("completeness_score") * F.lit(100e0)).alias("completeness_percent"),
        (F.col("valid_sessions_rate") * F.lit(100e0)).alias("valid_sessions_percent"),
        F.lit(minimum).alias("minimum_percent"),
    ).orderBy("id")


def latency_by_status(run_log: DataFrame) -> DataFrame:
    """Run time per source and status, in order of the runs."""
    return run_log.select("id", "source_file", "status", "execution_seconds").orderBy("id")


def health_snapshot(
    counts: DataFrame, registry: DataFrame, open_alerts: DataFrame, cfg: PipelineConfig, checked_at: Column | None = None
) -> DataFrame:
    """One nested row: table counts, model states and alerts, each list in order. ``checked_at`` is the clock, now by default."""
    as_list = lambda df: df.agg(F.sort_array(F.collect_list(F.struct(*df.columns)))).scalar()
    models = schema_currency(registry, cfg)
    return registry.sparkSession.range(1).select(
        F.date_format(F.current_timestamp() if checked_at is None else checked_at, "yyyy-MM-dd'T'HH:mm:ssXXX").alias("checked_at"),
        F.struct(as_list(counts).alias("tables"), as_list(models).alias("models")).alias("health"),
        as_list(open_alerts).alias("alerts"),
    )

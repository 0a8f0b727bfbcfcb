"""Data-quality reports and the gate, for any grouping of the rows.

Rows are first reduced to distinct rows with their number of copies. That one shuffle serves all
metrics: rates are copy-weighted sums, the duplicate count is copies beyond the first, and the price
quantile reads a further reduction to distinct prices.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from custbehav.config import CRITICAL_COLUMNS, PipelineConfig
from custbehav.functions.columns import is_number, ratio, round_half_up
from custbehav.functions.ordering import grouped_quantiles, join_null_safe
from custbehav.operators.cleaning import normal_columns, numeric_price, parsed_time, reject_reason
from custbehav.schema import RAW

RATES = (
    "completeness_score", *[f"null_rate_{c}" for c in CRITICAL_COLUMNS], "valid_event_types_rate",
    "price_valid_rate", "price_outlier_rate", "session_valid_rate", "valid_date_rate", "duplicate_rate",
)


def distinct_with_copies(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct rows (null-safe, within their group) and how often each occurs."""
    carried = [c for c in RAW.names if c in df.columns]
    return df.groupBy(*dict.fromkeys([*keys, *carried])).agg(F.count(F.lit(1)).alias("copies"))


def duplicate_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, and rows beyond the first of each set of equal rows, per group."""
    return distinct_with_copies(df, keys).groupBy(*keys).agg(
        F.sum("copies").alias("total_records"), F.sum(F.col("copies") - 1).alias("duplicate_count")
    )


def _in_date_range(df: DataFrame, cfg: PipelineConfig) -> Column:
    """Unlike cleaning, the gate accepts the whole last second of the last day."""
    time = parsed_time(df)
    return (time >= F.lit(cfg.min_event_date).cast("timestamp")) & (
        time < F.date_add(F.lit(cfg.max_event_date).cast("date"), 1).cast("timestamp")
    )


def _validity(df: DataFrame, cfg: PipelineConfig) -> dict[str, Column]:
    """Condition per rate; a column the input lacks counts as valid, but absent times as invalid."""
    has = set(df.columns)
    yes, no = F.lit(True), F.lit(False)
    conditions = {f"null_rate_{c}": F.col(c).isNull() if c in has else yes for c in CRITICAL_COLUMNS}
    conditions["valid_event_types_rate"] = F.col("event_type").isin(*cfg.event_types) if "event_type" in has else yes
    conditions["price_valid_rate"] = (
        is_number(numeric_price(df)) & (numeric_price(df) >= cfg.min_price) if "price" in has else yes
    )
    conditions["session_valid_rate"] = (
        F.length(F.col("user_session")) >= cfg.min_session_length if "user_session" in has else yes
    )
    conditions["valid_date_rate"] = _in_date_range(df, cfg) if "event_time" in has else no
    return conditions


def _outliers(rows: DataFrame, keys: list[str], cfg: PipelineConfig) -> DataFrame:
    """Per group: how many rows lie strictly above the interpolated price quantile.

    Prices that are no numbers are dropped by their count, not by a filter on the price: the optimizer
    would move such a filter in front of the reduction to distinct rows and run that twice.
    """
    price = numeric_price(rows)
    prices = (
        rows.withColumn("_price", price)
        .groupBy(*keys, "_price")
        .agg(F.sum(F.when(is_number(price), F.col("copies"))).alias("copies"))
        .filter(F.col("copies") > 0)
    )
    limits = grouped_quantiles(prices, keys, "_price", "copies", {"_limit": cfg.outlier_quantile})
    return limits.select(*keys, F.col("_limit_above").alias("_outliers"))


def evaluate(
    df: DataFrame, keys: list[str], cfg: PipelineConfig, copies: str | None = None, expected: DataFrame | None = None
) -> DataFrame:
    """One report per group of ``keys`` (at least one).

    ``copies`` names a column of multiplicities when ``df`` already holds distinct rows. Groups of
    ``expected`` without any row are reported as failed and empty.
    """
    rows = df.withColumnRenamed(copies, "copies") if copies else distinct_with_copies(df, keys)
    weight = F.col("copies")
    sums = _sums(rows, keys, cfg, weight, F.sum(weight - 1).alias("duplicate_count"))
    if "price" in rows.columns:
        sums = join_null_safe(sums, _outliers(rows, keys, cfg), keys, "left")
    else:
        sums = sums.withColumn("_outliers", F.lit(0))
    if expected is not None:
        sums = join_null_safe(expected.select(*keys).distinct(), sums, keys, "left")
    return _report(sums, keys, cfg)


def gate(df: DataFrame, keys: list[str], cfg: PipelineConfig) -> DataFrame:
    """The report without its two informational parts (copies and outliers): one narrow aggregation."""
    sums = _sums(df, keys, cfg, F.lit(1)).withColumns(
        {"duplicate_count": F.lit(None).cast("bigint"), "_outliers": F.lit(None).cast("bigint")}
    )
    return _report(sums, keys, cfg).drop("price_outlier_rate", "duplicate_rate", "duplicate_count")


def _sums(rows: DataFrame, keys: list[str], cfg: PipelineConfig, weight: Column, *more: Column) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum(weight).alias("total_records"),
        *more,
        *[
            F.sum(F.when(condition, weight).otherwise(0)).alias(f"_{name}")
            for name, condition in _validity(rows, cfg).items()
        ],
    )


def _report(sums: DataFrame, keys: list[str], cfg: PipelineConfig, keep: tuple[str, ...] = ()) -> DataFrame:
    total = F.col("total_records")
    rate = lambda name: ratio(F.col(name), total)
    nulls = [F.col(f"null_rate_{c}") for c in CRITICAL_COLUMNS]
    exact = sums.select(
        *keys,
        *keep,
        F.coalesce(total, F.lit(0)).alias("total_records"),
        F.coalesce(F.col("duplicate_count"), F.lit(0)).alias("duplicate_count"),
        *[rate(f"_null_rate_{c}").alias(f"null_rate_{c}") for c in CRITICAL_COLUMNS],
        *[
            rate(f"_{name}").alias(name)
            for name in ("valid_event_types_rate", "price_valid_rate", "session_valid_rate", "valid_date_rate")
        ],
        F.when(total > 0, F.coalesce(rate("_outliers"), F.lit(0e0))).alias("price_outlier_rate"),
        rate("duplicate_count").alias("duplicate_rate"),
    )
    completeness = F.lit(1e0) - reduce(lambda a, b: a + b, nulls) / F.lit(float(len(nulls)))
    passed = reduce(lambda a, b: a & b, [n <= cfg.max_null_rate for n in nulls]) & (
        (F.col("valid_event_types_rate") >= cfg.min_type_rate)
        & (F.col("price_valid_rate") >= cfg.min_price_rate)
        & (F.col("session_valid_rate") >= cfg.min_session_rate)
        & (F.col("valid_date_rate") >= cfg.min_date_rate)
    )
    judged = exact.withColumns(
        {"completeness_score": completeness, "passed_gate": F.coalesce(passed, F.lit(False))}
    )
    return judged.select(
        *keys,
        *keep,
        "total_records",
        "passed_gate",
        *[round_half_up(F.col(name), 4).alias(name) for name in RATES],
        "duplicate_count",
    )


def load_status(passed: Column, rows_loaded: Column) -> Column:
    """A source without valid rows fails; one whose raw rows miss the gate is loaded with a warning."""
    return (
        F.when(F.coalesce(rows_loaded, F.lit(0)) == 0, "FAILED")
        .when(F.coalesce(passed, F.lit(False)), "SUCCESS")
        .otherwise("QUALITY_WARNING")
    )


def load_log(df: DataFrame, keys: list[str], cfg: PipelineConfig) -> DataFrame:
    """Per group: rows read, valid and kept after de-duplication, and the resulting load status."""
    rows = distinct_with_copies(df, keys)
    judged = rows.withColumn("_valid", reject_reason(rows, cfg).isNull())
    read = _sums(
        judged, keys, cfg, F.col("copies"), F.sum(F.when(F.col("_valid"), F.col("copies")).otherwise(0)).alias("_valid_rows")
    )
    read = read.withColumns({"duplicate_count": F.lit(None).cast("bigint"), "_outliers": F.lit(None).cast("bigint")})
    reports = _report(read, keys, cfg, keep=("_valid_rows",))
    # The count decides, so that the optimizer cannot move the rules in front of the shared reduction.
    valid = judged.filter(F.when(F.col("_valid"), F.col("copies")) > 0)
    kept = valid.select(*keys, *normal_columns(valid)).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("_kept"))
    log = join_null_safe(reports, kept, keys, "left")
    inserted = F.coalesce(F.col("_kept"), F.lit(0))
    return log.select(
        *keys,
        F.col("total_records").alias("rows_read"),
        inserted.alias("rows_inserted"),
        (F.col("_valid_rows") - inserted).alias("duplicates_removed"),
        (F.col("total_records") - F.col("_valid_rows")).alias("rows_rejected"),
        "completeness_score",
        F.col("session_valid_rate").alias("valid_sessions_rate"),
        load_status(F.col("passed_gate"), inserted).alias("status"),
    )


def parsed_details(log: DataFrame) -> DataFrame:
    """The reports of a quality log with the typed figures of their JSON; a malformed report fails the job."""
    rates = ", ".join(f"{name} double" for name in RATES)
    schema = f"total_records long, passed_gate boolean, {rates}, duplicate_count long"
    parsed = log.withColumn("details", F.from_json("details", schema, {"mode": "FAILFAST"}))
    return parsed.select("id", "source_file", "status", "checked_at", "details.*")


def report_changes(reports: DataFrame) -> DataFrame:
    """Every parsed report beside the one before it of the same source: what its rates changed by."""
    before = Window.partitionBy("source_file").orderBy("id")
    change = lambda name: round_half_up(F.col(name) - F.lag(name).over(before), 4).alias(f"{name}_change")
    turned = F.col("passed_gate") != F.lag("passed_gate").over(before)
    return reports.select("*", *[change(name) for name in RATES], turned.alias("gate_turned"))


def details_json(df: DataFrame) -> Column:
    """The whole report as JSON text."""
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]))

"""Dimensional marts over stored events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from custbehav.config import PipelineConfig
from custbehav.functions.columns import amount_sums, amount_total, count_when, ratio, round_half_up
from custbehav.functions.ordering import grouped_quantiles, running_totals
from custbehav.session import cut_lineage

MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
    "November", "December",
)


def _is(kind: str) -> Column:
    return F.col("event_type") == kind


def _paid() -> list[Column]:
    return amount_sums(F.when(_is("purchase"), F.col("price")), "paid")


def _latest(name: str) -> Column:
    return F.max_by(name, F.struct("event_time", name))


def date_key(date: Column) -> Column:
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def dim_users(events: DataFrame) -> DataFrame:
    users = events.groupBy("user_id").agg(
        F.min("event_time").alias("first_seen"),
        F.max("event_time").alias("last_seen"),
        F.countDistinct("user_session").alias("total_sessions"),
        count_when(_is("purchase")).alias("total_purchases"),
        *_paid(),
    )
    return users.select(
        "user_id", "first_seen", "last_seen", "total_sessions", "total_purchases",
        round_half_up(amount_total("paid"), 2).alias("total_spent"),
    )


def dim_products(events: DataFrame) -> DataFrame:
    """Aggregated per spelling of the labels first (hashed), then per product."""
    kinds = {"total_views": "view", "total_carts": "cart", "total_purchases": "purchase"}
    spellings = events.groupBy("product_id", "category_id", "category_code", "brand").agg(
        F.max("event_time").alias("event_time"),
        F.count(F.lit(1)).alias("n"),
        *amount_sums(F.col("price"), "price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        *[count_when(_is(kind)).alias(name) for name, kind in kinds.items()],
    )
    products = spellings.groupBy("product_id").agg(
        *[_latest(name).alias(name) for name in ("category_id", "category_code", "brand")],
        round_half_up(ratio(amount_total("price", regroup=True), F.sum("n")), 2).alias("avg_price"),
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
        *[F.sum(name).alias(name) for name in kinds],
    )
    share = ratio(F.col("total_purchases") * 100, F.col("total_views"))
    return products.withColumn("conversion_rate", round_half_up(share, 2))


def dim_categories(events: DataFrame) -> DataFrame:
    """Levels are null where the code has no such part, unlike in the event store."""
    parts = F.split("category_code", r"\.")
    products = events.groupBy("category_id", "category_code", "product_id").agg(
        F.max("event_time").alias("event_time"), *_paid()
    )
    return (
        products.groupBy("category_id")
        .agg(
            _latest("category_code").alias("category_code"),
            F.countDistinct("product_id").alias("total_products"),
            round_half_up(amount_total("paid", regroup=True), 2).alias("total_revenue"),
        )
        .select(
            "category_id",
            "category_code",
            *[F.get(parts, F.lit(i)).alias(f"category_level{i + 1}") for i in range(3)],
            "total_products",
            "total_revenue",
        )
    )


def fact_events(events: DataFrame) -> DataFrame:
    return events.select(
        "event_time", "event_type", "product_id", "user_id", "user_session", "price", "source_file"
    )


def dim_date(events: DataFrame) -> DataFrame:
    """One row per day from the first to the last event; weeks start on Sunday (1)."""
    span = events.agg(F.to_date(F.min("event_time")).alias("first"), F.to_date(F.max("event_time")).alias("last"))
    day = F.col("full_date")
    return span.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("full_date")).select(
        date_key(day).alias("date_key"),
        "full_date",
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.month(day).alias("month"),
        F.element_at(F.array(*[F.lit(name) for name in MONTH_NAMES]), F.month(day)).alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def dim_brand(events: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Brands numbered by name, with their most bought category and whether they sell most.

    A brand is popular when fewer than ``popular_brands`` others have more purchases.
    """
    by_category = events.groupBy("brand", "category_level1").agg(
        F.count(F.lit(1)).alias("n"), count_when(_is("purchase")).alias("purchases")
    )
    brands = by_category.groupBy("brand").agg(
        F.min(F.struct((-F.col("purchases")).alias("p"), (-F.col("n")).alias("n"), "category_level1")).alias("_best"),
        F.sum("purchases").alias("purchases"),
        F.lit(1).alias("one"),
    )
    # Popularity needs only the purchase count of the last popular rank, not an order of all brands.
    at_least = (
        brands.orderBy(F.desc("purchases")).limit(cfg.popular_brands).agg(F.min("purchases")).scalar()
    )
    # The buckets are the ranges the brands are dealt into, so brands that begin alike do not share a task.
    ranged = cut_lineage(brands.repartitionByRange("brand").withColumn("_range", F.spark_partition_id()))
    numbered = running_totals(ranged, [], "brand", F.col("_range"), ["one"])
    return numbered.select(
        (F.col("one_before") + 1).alias("brand_key"),
        F.col("brand").alias("brand_name"),
        F.col("_best.category_level1").alias("brand_category"),
        (F.col("purchases") >= at_least).alias("is_popular"),
    )


def fact_sales_daily(events: DataFrame, brands: DataFrame) -> DataFrame:
    """Activity per day, product, brand and category with the dimensions' keys.

    The events are aggregated before the join, so the join sees one row per fact. ``brands`` should be the
    stored dimension; a brand with most facts is split by adaptive execution, as both sides are shuffled for
    the join alone.
    """
    facts = events.groupBy("date", "product_id", "brand", "category_id").agg(
        count_when(_is("view")).alias("total_views"),
        count_when(_is("cart")).alias("total_carts"),
        count_when(_is("purchase")).alias("total_purchases"),
        *_paid(),
        F.countDistinct("user_id").alias("unique_users"),
    )
    keys = brands.select("brand_key", F.col("brand_name").alias("brand"))
    return facts.join(keys, "brand").select(
        date_key(F.col("date")).alias("date_key"),
        F.col("product_id").alias("product_key"),
        "brand_key",
        F.col("category_id").alias("category_key"),
        "total_views",
        "total_carts",
        "total_purchases",
        round_half_up(amount_total("paid"), 2).alias("total_revenue"),
        "unique_users",
    )


def price_iqr(events: DataFrame) -> DataFrame:
    """Per category: price quartiles, the 1.5 IQR fences, and how many events lie outside. Nothing is dropped."""
    keys = ["category_level1"]
    prices = events.groupBy(*keys, "price").agg(F.count(F.lit(1)).alias("copies"))
    quartiles = grouped_quantiles(prices, keys, "price", "copies", {"q1": 0.25, "q3": 0.75})
    spread = (F.col("q3") - F.col("q1")) * F.lit(1.5e0)
    fences = quartiles.withColumns({"low_fence": F.col("q1") - spread, "high_fence": F.col("q3") + spread})
    outside = (F.col("price") < F.col("low_fence")) | (F.col("price") > F.col("high_fence"))
    return (
        prices.join(fences, keys)
        .groupBy(*keys, "q1", "q3", "low_fence", "high_fence")
        .agg(F.sum("copies").alias("events"), F.sum(F.when(outside, F.col("copies")).otherwise(0)).alias("outliers"))
    )


def zero_sessions(events: DataFrame) -> DataFrame:
    """Sessions whose first and last event have the same time."""
    return (
        events.groupBy("user_session")
        .agg(
            F.min("event_time").alias("started"),
            F.max("event_time").alias("_ended"),
            F.count(F.lit(1)).alias("events"),
        )
        .filter(F.col("started") == F.col("_ended"))
        .drop("_ended")
    )

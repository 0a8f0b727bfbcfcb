"""Popularity recommendations: product ranking per category, and a list per user."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from custbehav.config import PipelineConfig
from custbehav.functions.columns import amount_sums, amount_total, ratio, round_half_up

# The text of a recommendation's reason, around the category.
REASON = ("Top trending in '", "' category")


def product_popularity(events: DataFrame) -> DataFrame:
    """Purchases, mean price and latest labels per category and product.

    Purchases are first counted per product and spelling of its labels, which hashes on the text
    columns; only the few spellings of a product remain when the latest one is chosen.
    """
    spellings = (
        events.filter((F.col("event_type") == "purchase") & (F.col("category_level1") != "unknown"))
        .groupBy("category_level1", "product_id", "category_code", "brand")
        .agg(F.max("event_time").alias("event_time"), F.count(F.lit(1)).alias("n"), *amount_sums(F.col("price"), "paid"))
    )
    latest = lambda name: F.max_by(name, F.struct("event_time", name)).alias(name)
    mean = ratio(amount_total("paid", regroup=True), F.sum("n"))
    return spellings.groupBy("category_level1", "product_id").agg(
        latest("category_code"), latest("brand"), round_half_up(mean, 2).alias("price"), F.sum("n").alias("popularity")
    )


def top_products(events: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """The most bought products of every category.

    The rank filter reaches the shuffle: each task passes on at most the top products of a category.
    """
    order = Window.partitionBy("category_level1").orderBy(F.desc("popularity"), "product_id")
    return (
        product_popularity(events)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= cfg.top_n_per_category)
    )


def _item() -> F.Column:
    return F.struct(
        (-F.col("popularity")).alias("order"),
        "product_id",
        F.col("category_level1").alias("category"),
        "brand",
        "price",
        "popularity",
    )


def user_recommendations(users: DataFrame, catalogue: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Add an array of recommended items to users with their ``favorite_category``.

    The favourite's best items come first and other categories' best items fill up. Both lists are
    built per category and once overall, bounded by the list length, so the users are only joined with
    one row per category, never with products. The optimizer broadcasts that side while its size allows
    and otherwise splits favourite categories that many users share.
    """
    n = cfg.recommended_items
    # All ranks are listed here, so that both uses of the catalogue are the same plan and run once.
    own = (
        catalogue.groupBy("category_level1")
        .agg(F.sort_array(F.collect_list(_item())).alias("_own"))
        .withColumnRenamed("category_level1", "favorite_category")
    )
    # The best n overall hold enough strangers for any category: at most its own items are skipped,
    # and those are then in its own list already.
    best = catalogue.orderBy(F.desc("popularity"), "product_id", "category_level1").limit(n)
    overall = best.agg(F.sort_array(F.collect_list(_item())).alias("_overall")).scalar()

    strangers = F.filter(F.col("_overall"), lambda item: item["category"] != F.col("favorite_category"))
    known = F.coalesce(F.col("_own"), F.array().cast(catalogue.select(F.array(_item())).schema[0].dataType))
    items = F.slice(F.concat(known, strangers), 1, n)
    return users.join(own, "favorite_category", "left").withColumn("_overall", overall).select(
        *users.columns,
        F.transform(
            items,
            lambda item, position: F.struct(
                (position + 1).alias("rank"),
                item["product_id"].alias("product_id"),
                item["category"].alias("category"),
                F.when(F.coalesce(item["brand"], F.lit("")) == "", "General").otherwise(item["brand"]).alias("brand"),
                item["price"].alias("price_usd"),
                item["popularity"].alias("popularity_score"),
                F.concat(F.lit(REASON[0]), item["category"], F.lit(REASON[1])).alias(
                    "recommendation_reason"
                ),
            ),
        ).alias("recommended_products"),
    )


def exploded(recommendations: DataFrame) -> DataFrame:
    """One row per user and recommended item."""
    return recommendations.select("user_id", "favorite_category", F.inline("recommended_products"))

"""Event views over the benchmark tables (see FIXTURES.md): clean, long-history and dirty events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CATEGORY_BASE = 1487580000000000000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _category_id() -> Column:
    return (F.lit(CATEGORY_BASE) + F.col("p_size")).cast("string")


def _category_code() -> Column:
    name = F.col("p_name")
    return F.concat_ws(
        ".", F.col("p_type"), F.split_part(name, F.lit(" "), F.lit(2)), F.split_part(name, F.lit(" "), F.lit(1))
    )


def _events_with_part(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumn(
        "p_partkey", F.get_json_object("props", "$.k").cast("bigint")
    )
    return events.join(table(spark, folder, "part"), "p_partkey")


def _event_type() -> Column:
    return F.when(F.col("event_type") == "click", "cart").otherwise(F.col("event_type"))


def _session() -> Column:
    return F.concat_ws("-", F.lit("session"), F.col("user_id").cast("string"), F.col("ts").cast("date").cast("string"))


def behavior(spark: SparkSession, folder: str) -> DataFrame:
    """Typed events of January 2024; sign-ups and errors stay as invalid types."""
    return _events_with_part(spark, folder).select(
        F.col("ts").cast("timestamp").alias("event_time"),
        _event_type().alias("event_type"),
        F.col("p_partkey").alias("product_id"),
        _category_id().alias("category_id"),
        F.lower(_category_code()).alias("category_code"),
        F.lower("p_brand").alias("brand"),
        F.col("value").alias("price"),
        "user_id",
        _session().alias("user_session"),
    )


def order_behavior(spark: SparkSession, folder: str) -> DataFrame:
    """One event per order line, 1995 to 2001."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_extendedprice")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # The labels are built once per part, not once per line.
    parts = table(spark, folder, "part").select(
        "p_partkey", _category_id().alias("category_id"), F.lower(_category_code()).alias("category_code"), F.lower("p_brand").alias("brand")
    )
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    flag = F.col("l_returnflag")
    return rows.select(
        F.col("o_orderdate").cast("timestamp").alias("event_time"),
        F.when(flag == "R", "remove_from_cart").when(flag == "A", "view").otherwise("purchase").alias("event_type"),
        F.col("l_partkey").alias("product_id"),
        "category_id",
        "category_code",
        "brand",
        F.col("l_extendedprice").alias("price"),
        F.col("o_custkey").alias("user_id"),
        F.concat(F.lit("session-"), F.col("o_orderkey").cast("string")).alias("user_session"),
    )


def raw_behavior(spark: SparkSession, folder: str) -> DataFrame:
    """The events of ``behavior`` as dirty text sources: bad dates, nulls, NaN, short sessions, copies.

    One source per day, delivered in hourly batches.
    """
    every = lambda divisor, rest: F.col("event_id") % divisor == rest
    value = F.col("value")
    dirty = _events_with_part(spark, folder).select(
        F.when(every(103, 7), "not-a-date")
        .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")))
        .alias("event_time"),
        _event_type().alias("event_type"),
        F.col("p_partkey").alias("product_id"),
        F.when(~every(31, 3), _category_id()).alias("category_id"),
        F.when(~every(13, 5), _category_code()).alias("category_code"),
        F.when(every(11, 5), "  ").otherwise(F.concat(F.lit(" "), F.col("p_brand"), F.lit(" "))).alias("brand"),
        F.when(every(101, 9), -value).when(every(211, 9), F.lit(float("nan"))).otherwise(value).alias("price"),
        F.when(~every(107, 1), F.col("user_id")).alias("user_id"),
        F.when(every(97, 2), None).when(every(89, 2), "short").otherwise(_session()).alias("user_session"),
        F.concat(F.lit("events-"), F.col("ts").cast("date").cast("string"), F.lit(".csv")).alias("source_file"),
        F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600).alias("batch"),
        F.when(every(50, 0), 2).otherwise(1).alias("copies"),
    )
    return dirty.withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("_copy", "copies")

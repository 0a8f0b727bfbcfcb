"""Cleaning: row rules, normalisation, keyed de-duplication, calendar and category columns.

Everything before the de-duplication is a narrow projection. The de-duplication groups by all the
columns it carries, so it is a hash aggregation that drops copies before the shuffle, and a source in
which one row repeats millions of times does not make a large partition. Derived columns are computed
after it, so they are neither shuffled nor grouped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from custbehav.config import PipelineConfig
from custbehav.functions.columns import category_level, day_name, is_number, strip
from custbehav.schema import EVENTS, IDENTITY, RAW

# Category ids that mean "none".
NO_CATEGORY = ("nan", "<NA>", "None", "")


def parsed_time(df: DataFrame) -> Column:
    """``event_time`` as timestamp; texts that are no time become null."""
    return F.col("event_time").try_cast("timestamp")


def numeric_price(df: DataFrame) -> Column:
    """``price`` as double; texts that are no number become null."""
    price = F.col("price")
    return price.try_cast("double") if isinstance(df.schema["price"].dataType, StringType) else price.cast("double")


def in_window(df: DataFrame, cfg: PipelineConfig) -> Column:
    """True from the first second of the first day to the last second of the last day, both included.

    A column of times is compared plainly, so the range reaches the scan. A text is mentioned once in a
    range test, because a filter would parse it for each comparison.
    """
    first = F.lit(cfg.min_event_date).cast("timestamp")
    last = F.lit(f"{cfg.max_event_date} 23:59:59").cast("timestamp")
    if not isinstance(df.schema["event_time"].dataType, StringType):
        return F.col("event_time").between(first, last)
    first, last = F.unix_micros(first), F.unix_micros(last)
    return F.floor((F.unix_micros(parsed_time(df)) - first) / (last - first + 1)) == 0


def row_rules(df: DataFrame, cfg: PipelineConfig) -> list[tuple[str, Column]]:
    """The rules a row must meet, in the order in which they reject."""
    price, time = numeric_price(df), parsed_time(df)
    present = reduce(
        lambda a, b: a & b, [F.col(c).isNotNull() for c in ("event_time", "event_type", "user_id", "product_id")]
    )
    return [
        ("price", is_number(price) & (price > 0) & (price < F.lit(float("inf")))),
        ("event_type", F.col("event_type").isin(*cfg.event_types)),
        ("mandatory_key", present),
        ("session", F.length("user_session") >= cfg.min_session_length),
        ("unparsable_time", time.isNotNull()),
        ("outside_window", in_window(df, cfg)),
    ]


def reject_reason(df: DataFrame, cfg: PipelineConfig) -> Column:
    """Name of the first rule the row breaks, null for a valid row."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in row_rules(df, cfg)])


def valid_rows(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    # A time in the window was parsed, so that rule need not be tested again.
    rules = [ok for name, ok in row_rules(df, cfg) if name != "unparsable_time"]
    return df.filter(reduce(lambda a, b: a & b, rules))


def _text(name: str) -> Column:
    return F.coalesce(F.nullif(strip(F.lower(F.col(name))), F.lit("")), F.lit("unknown"))


def normal_columns(df: DataFrame) -> list[Column]:
    """The nine identity columns of valid rows in their stored form."""
    written = F.col("category_id").cast("string")
    category_id = F.when(written.endswith(".0"), F.left(written, F.length(written) - 2)).otherwise(written)
    return [
        F.date_trunc("second", parsed_time(df)).alias("event_time"),
        F.col("event_type"),
        F.col("product_id").cast("bigint").alias("product_id"),
        F.when(written.isNull() | category_id.isin(*NO_CATEGORY), "0").otherwise(category_id).alias("category_id"),
        _text("category_code").alias("category_code"),
        _text("brand").alias("brand"),
        numeric_price(df).alias("price"),
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("user_session"),
    ]


def normalise(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Valid rows in their stored form; columns beside the raw ones pass through."""
    return valid_rows(df, cfg).select(*normal_columns(df), *[c for c in df.columns if c not in RAW.names])


def drop_copies(df: DataFrame) -> DataFrame:
    """One row per identity within its source."""
    return df.select(*IDENTITY, "source_file").distinct()


def derive(df: DataFrame) -> DataFrame:
    """Calendar parts and the three category levels."""
    time, code = F.col("event_time"), F.col("category_code")
    weekday = F.weekday(time)
    return df.withColumns(
        {
            "date": F.to_date(time),
            "hour": F.hour(time),
            "day_of_week": weekday,
            "day_name": day_name(weekday),
            "month": F.month(time),
            "year": F.year(time),
            "category_level1": category_level(code, 1),
            "category_level2": category_level(code, 2),
            "category_level3": category_level(code, 3),
        }
    )


def clean(raw: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Raw rows tagged with ``source_file`` to stored events."""
    return derive(drop_copies(normalise(raw, cfg))).select(*EVENTS.names)


def exact_duplicates_removed(df: DataFrame) -> DataFrame:
    """Null-safe distinct over whole rows."""
    return df.distinct()


def reject_counts(df: DataFrame, cfg: PipelineConfig, copies: str | None = None) -> DataFrame:
    """Rows per source and reject reason; valid rows count under "valid". One narrow pass."""
    rows = F.sum(copies) if copies else F.count(F.lit(1))
    return (
        df.withColumn("reason", F.coalesce(reject_reason(df, cfg), F.lit("valid")))
        .groupBy("source_file", "reason")
        .agg(rows.alias("rows"))
    )

"""Ranks, quantiles and running totals without sorting a group in one task.

All three work in two steps over an order-preserving bucket of the value: totals per bucket say how
much lies before each bucket (one small row per bucket, whatever the size of the data), and only
inside a bucket are rows put in order. A group that holds most of the data is thereby spread over as
many tasks as it has buckets. The results are exact: the bucket decides the work split, not the answer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F


def log_bucket(value: Column) -> Column:
    """Bucket for amounts, 0.05 % wide whatever their magnitude."""
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * F.lit(2048e0))


def unit_bucket(value: Column) -> Column:
    """Bucket for values in [0, 1]."""
    return F.floor(value * F.lit(65536e0))


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null key meets a null key; the key columns of ``left`` are kept."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    on = [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys]
    return left.join(renamed, on, how).drop(*[f"_right_{key}" for key in keys])


def bucket_offsets(rows: DataFrame, keys: list[str], measures: list[str], descending: bool = False) -> DataFrame:
    """Per key and ``_bucket``: the sums of the measures, and the sums of all buckets before it."""
    order = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    group = [F.col(key) for key in keys] or [F.lit(1)]
    before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*keys, "_bucket").agg(*[F.sum(m).alias(f"_sum_{m}") for m in measures])
    return sums.select(
        "*", *[F.coalesce(F.sum(f"_sum_{m}").over(before), F.lit(0)).alias(f"_start_{m}") for m in measures]
    )


def running_totals(
    rows: DataFrame, keys: list[str], value: str, bucket: Column, measures: list[str], descending: bool = False,
    few_buckets: bool = False,
) -> DataFrame:
    """Add ``<measure>_before``: the sum over all rows of the key that come before this one.

    ``value`` must be distinct within a key, and ``bucket`` must not decrease as it grows. State
    ``few_buckets`` where keys and buckets are bounded, whatever the data: the totals per bucket are then
    broadcast, otherwise the optimizer decides by their size.
    """
    order = F.col(value).desc() if descending else F.col(value).asc()
    bucketed = rows.withColumn("_bucket", bucket)
    offsets = bucket_offsets(bucketed, keys, measures, descending).drop(*[f"_sum_{m}" for m in measures])
    inside = (
        Window.partitionBy(*keys, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = join_null_safe(bucketed, F.broadcast(offsets) if few_buckets else offsets, [*keys, "_bucket"])
    return joined.select(
        *rows.columns,
        *[
            (F.col(f"_start_{m}") + F.coalesce(F.sum(m).over(inside), F.lit(0))).alias(f"{m}_before")
            for m in measures
        ],
    )


def values_at_ranks(
    counts: DataFrame,
    keys: list[str],
    value: str,
    count: str,
    bucket: Column,
    ranks: dict[str, Callable[[Column], Column]],
    few_keys: bool = False,
) -> DataFrame:
    """Per key: the number of rows ``n`` and the value at each 0-based rank.

    Beside each value, ``<name>_before`` and ``<name>_upto`` count the rows below it and up to it.
    ``counts`` has one row per key and distinct value with its number of copies. ``ranks`` maps an
    output name to a function from ``n`` to the rank. One row per key and rank says where to look; it is
    broadcast when there is no key, or when ``few_keys`` states that their number is bounded.
    """
    bucketed = counts.withColumn("_bucket", bucket)
    offsets = bucket_offsets(bucketed, keys, [count])
    group = [F.col(key) for key in keys] or [F.lit(1)]
    offsets = offsets.withColumn("n", F.sum(f"_sum_{count}").over(Window.partitionBy(*group)))

    start, size, n = F.col(f"_start_{count}"), F.col(f"_sum_{count}"), F.col("n")
    holds_a_rank = F.lit(False)
    for rank in ranks.values():
        holds_a_rank = holds_a_rank | ((start <= rank(n)) & (rank(n) < start + size))
    hit = offsets.filter(holds_a_rank).drop(f"_sum_{count}")
    if few_keys or not keys:
        hit = F.broadcast(hit)

    inside = (
        Window.partitionBy(*keys, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = join_null_safe(bucketed, hit, [*keys, "_bucket"]).withColumn(
        "_end", F.col(f"_start_{count}") + F.sum(count).over(inside)
    )
    upto, before = F.col("_end"), F.col("_end") - F.col(count)
    wanted = []
    for name, rank in ranks.items():
        here = (before <= rank(n)) & (rank(n) < upto)
        for output, column in ((name, F.col(value)), (f"{name}_before", before), (f"{name}_upto", upto)):
            wanted.append(F.max(F.when(here, column)).alias(output))
    return ranked.groupBy(*keys).agg(F.max("n").alias("n"), *wanted)


def grouped_quantiles(counts: DataFrame, keys: list[str], value: str, count: str, quantiles: dict[str, float]) -> DataFrame:
    """Exact, linearly interpolated quantiles of amounts per key, and ``<name>_above``: the rows beyond them.

    Nulls and NaN must be filtered before.
    """

    def position(q: float) -> Callable[[Column], Column]:
        return lambda n: (n - 1).cast("double") * F.lit(q)

    ranks = {}
    for name, q in quantiles.items():
        at = position(q)
        ranks[f"_{name}_low"] = lambda n, at=at: F.floor(at(n))
        ranks[f"_{name}_high"] = lambda n, at=at: F.ceil(at(n))
    found = values_at_ranks(counts, keys, value, count, log_bucket(F.col(value)), ranks)

    def interpolated(name: str, q: float) -> Column:
        low, high, at = F.col(f"_{name}_low"), F.col(f"_{name}_high"), position(q)(F.col("n"))
        return F.when(low == high, low).otherwise(low + (high - low) * (at - F.floor(at)))

    def above(name: str) -> Column:
        """Rows strictly above the quantile, which lies between two neighbouring values."""
        low, high, at = F.col(f"_{name}_low"), F.col(f"_{name}_high"), F.col(name)
        return F.col("n") - F.when(at >= high, F.col(f"_{name}_high_upto")).when(
            at > low, F.col(f"_{name}_high_before")
        ).otherwise(F.col(f"_{name}_low_upto"))

    return found.withColumns({name: interpolated(name, q) for name, q in quantiles.items()}).select(
        *keys, "n", *quantiles, *[above(name).alias(f"{name}_above") for name in quantiles]
    )

"""Per-user behaviour features, the leakage-safe churn label and the deterministic user sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from custbehav.config import PipelineConfig
from custbehav.functions.columns import amount_sums, amount_total, count_when, ratio
from custbehav.functions.ordering import values_at_ranks
from custbehav.session import cut_lineage

# Constants of the sampling hash.
HASH_MODULUS = 2147483647
HASH_FACTOR = 1103515245

FEATURE_COLUMNS = [
    "user_id", "first_interaction", "last_interaction", "total_events", "total_spent", "avg_spent",
    "unique_products", "unique_categories", "total_views", "total_purchases", "days_active",
    "events_per_day", "spend_per_event", "purchase_rate",
]


def label_cutoff(events: DataFrame, cfg: PipelineConfig) -> Column:
    """Last event time less the inactivity span, as a scalar subquery (reads one column)."""
    return events.agg(F.max("event_time") - F.make_interval(days=F.lit(cfg.inactive_days))).scalar()


def sample_hash(user_id: Column, seed: int) -> Column:
    return ((user_id % HASH_MODULUS) * F.lit(HASH_FACTOR).cast("bigint") + seed) % HASH_MODULUS


def sample_key(user_id: Column, seed: int) -> Column:
    return F.struct(sample_hash(user_id, seed).alias("hash"), user_id.alias("user_id"))


def sample_threshold(users: DataFrame, size: int, seed: int) -> Column:
    """Sample key of the last selected user. ``users`` has one row per eligible user.

    The size-th smallest key is found from totals per hash range, so no task has to sort, or hold,
    the users that are selected.
    """
    if size <= 0:
        raise ValueError("a sample needs at least one user")
    keyed = users.select(sample_key(F.col("user_id"), seed).alias("key"), F.lit(1).alias("rows"))
    bucket = F.shiftright(F.col("key.hash"), 15)
    last = values_at_ranks(
        keyed, [], "key", "rows", bucket, {"last": lambda n: F.least(F.lit(size).cast("bigint"), n) - 1}
    )
    return last.select("last").scalar()


def sampled(rows: DataFrame, eligible: DataFrame, size: int, seed: int) -> DataFrame:
    """The rows of the selected users: a filter on the key, without a join or a shuffle of ``rows``."""
    threshold = sample_threshold(eligible.select("user_id").distinct(), size, seed)
    return rows.filter(sample_key(F.col("user_id"), seed) <= threshold)


def _best_category(count: str) -> Column:
    """Known level-1 category with the greatest count in a group; ties go to the first name."""
    ranked = F.struct((-F.col(count)).alias("n"), "category_level1")
    return F.min(F.when((F.col("category_level1") != "unknown") & (F.col(count) > 0), ranked)).alias("_best")


MEASURES = ("first_interaction", "last_interaction", "total_events", "total_views", "total_purchases", "spent_sum")


def _aggregate(events: DataFrame, views: dict[str, Column | None], favourite: bool = False) -> DataFrame:
    """Additive measures and distinct counts per user, of the events each view observes.

    ``views`` maps a prefix of the columns to a condition on an event, or to None for all events. The events are
    read once, dealt by user and product, and added up per user, category, product and conditions met. That and the window over
    a user's product need no other shuffle: rows that are not added up yet are narrow, and most stay alone. What
    follows works on those rows: a product counts in the first category in which the user saw it, and sums per
    category give the number of categories and the favourite (of the first view) on the way. Every shuffle but the last
    is on a finer key than the user, so a user with a third of all events is spread over tasks.
    """
    kind, time = F.col("event_type"), F.col("event_time")
    bought, count = kind == "purchase", F.count(F.lit(1))
    met = {f"_met_{i}": F.coalesce(condition, F.lit(False)) for i, condition in enumerate(views.values()) if condition is not None}
    seen = {prefix: F.lit(True) if condition is None else F.col(f"_met_{i}") for i, (prefix, condition) in enumerate(views.items())}
    used = events.select("user_id", "category_level1", "product_id", "event_type", "event_time", "price")
    dealt = used.withColumns(met).repartition("user_id", "product_id")
    per_product = dealt.groupBy("user_id", "category_level1", "product_id", *met).agg(
        F.min(time).alias("first_interaction"), F.max(time).alias("last_interaction"),
        count.alias("total_events"), count_when(kind == "view").alias("total_views"), count_when(bought).alias("total_purchases"),
        *amount_sums(F.when(bought, F.col("price")), "spent"),
    )
    # One unordered window for all views; of the rows of a category the one with the most conditions met counts.
    product, place = Window.partitionBy("user_id", "product_id"), F.struct("category_level1", *[(~F.col(m)).alias(m) for m in met])
    firsts = {f"{prefix}_place": F.min(F.when(own, place)).over(product) for prefix, own in seen.items()}
    placed = per_product.withColumns(firsts)

    least = {"first_interaction": F.min, "last_interaction": F.max}
    observed = []
    for prefix, own in seen.items():
        here = F.col(f"{prefix}_place").eqNullSafe(place) & F.col("product_id").isNotNull()
        observed.append(F.sum((own & here).cast("long")).alias(f"{prefix}unique_products"))
        observed += [least.get(m, F.sum)(F.when(own, F.col(m))).alias(prefix + m) for m in MEASURES]
    users = placed.groupBy("user_id", "category_level1").agg(*observed, F.max("last_interaction").alias("_last_event")).groupBy("user_id")

    again = [F.max("_last_event").alias("_last_event")]
    for prefix in views:
        again += [least[m](prefix + m).alias(prefix + m) for m in least]
        again += [
            F.coalesce(F.sum(prefix + m), F.lit(0).cast("bigint")).alias(prefix + m)
            for m in ("unique_products", "total_events", "total_views", "total_purchases")
        ]
        again.append(count_when(F.col("category_level1").isNotNull() & (F.col(f"{prefix}total_events") > 0)).alias(f"{prefix}unique_categories"))
        again.append(amount_total(f"{prefix}spent", regroup=True).alias(f"{prefix}total_spent"))
    return users.agg(*again, *([_best_category(f"{next(iter(views))}total_events")] if favourite else []))


def _of_view(users: DataFrame, prefix: str = "") -> DataFrame:
    """The users of whom the view observes anything, with its columns under their plain names."""
    names = ("first_interaction", "last_interaction", "total_events", "total_views", "total_purchases",
             "unique_products", "unique_categories", "total_spent")
    kept = [c for c in ("user_id", "_last_event", "_best", "_cutoff") if c in users.columns]
    return users.filter(F.col(f"{prefix}total_events") > 0).select(*kept, *[F.col(prefix + name).alias(name) for name in names])


def _ratios(users: DataFrame) -> DataFrame:
    elapsed = F.unix_micros("last_interaction") - F.unix_micros("first_interaction")
    events, spent = F.col("total_events"), F.col("total_spent")
    return users.withColumns(
        {
            "avg_spent": F.coalesce(ratio(spent, F.col("total_purchases")), F.lit(0e0)),
            "days_active": F.greatest(F.floor(elapsed / F.lit(86400e6)) + 1, F.lit(1)),
        }
    ).withColumns(
        {
            "events_per_day": ratio(events, F.col("days_active")),
            "spend_per_event": ratio(spent, events),
            "purchase_rate": ratio(F.col("total_purchases"), events),
        }
    )


def user_features(
    events: DataFrame, cfg: PipelineConfig, for_churn: bool = False, sample_size: int | None = None,
    seed: int | None = None,
) -> DataFrame:
    """Features and churn label per user, in one aggregation over the events.

    With ``for_churn`` only events before the cutoff count as features, and users without any are left
    out; the event on the cutoff belongs to the label. Otherwise all history counts. The label is 1 for
    users with no event from the cutoff on.
    """
    cutoff = label_cutoff(events, cfg)
    observed = F.col("event_time") < cutoff if for_churn else None
    rows = events
    if sample_size is not None:
        eligible = events.filter(observed) if for_churn else events
        rows = sampled(events, eligible, sample_size, cfg.seed if seed is None else seed)
    return _labelled(_of_view(_aggregate(rows, {"": observed})), cutoff, "held_out" if for_churn else "descriptive")


def _labelled(users: DataFrame, cutoff: Column, mode: str) -> DataFrame:
    return _ratios(users).select(
        *FEATURE_COLUMNS,
        F.when(F.col("_last_event") >= cutoff, 0).otherwise(1).alias("churned"),
        F.lit(mode).alias("feature_mode"),
        cutoff.alias("label_cutoff"),
    )


def churn_labels(events: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Label of every user that has an event before the cutoff."""
    cutoff = label_cutoff(events, cfg)
    return (
        events.groupBy("user_id")
        .agg(F.min("event_time").alias("_first"), F.max("event_time").alias("_last"))
        .filter(F.col("_first") < cutoff)
        .select("user_id", F.when(F.col("_last") >= cutoff, 0).otherwise(1).alias("churned"))
    )


def favourite_category(events: DataFrame) -> DataFrame:
    """Most frequent known level-1 category per user; users without any are left out."""
    return (
        events.groupBy("user_id", "category_level1")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("user_id")
        .agg(_best_category("n"))
        .filter(F.col("_best").isNotNull())
        .select("user_id", F.col("_best.category_level1").alias("favorite_category"))
    )


def serving_features(events: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Full-history features of all users with their favourite category."""
    return _served(_of_view(_aggregate(events, {"": None}, favourite=True)), cfg)


def _served(users: DataFrame, cfg: PipelineConfig) -> DataFrame:
    favourite = F.coalesce(F.col("_best.category_level1"), F.lit(cfg.default_category))
    return _ratios(users).select(*FEATURE_COLUMNS, favourite.alias("favorite_category"))


def serving_and_held_out(events: DataFrame, cfg: PipelineConfig) -> tuple[DataFrame, DataFrame]:
    """``serving_features`` and ``user_features`` with ``for_churn``, from one written aggregation over the events."""
    cutoff = label_cutoff(events, cfg)
    users = _aggregate(events, {"": None, "held_": F.col("event_time") < cutoff}, favourite=True)
    users = cut_lineage(users.withColumn("_cutoff", cutoff))
    return _served(_of_view(users), cfg), _labelled(_of_view(users, "held_"), F.col("_cutoff"), "held_out")


def top_spenders(events: DataFrame, more_than: int = 5, limit: int = 5) -> DataFrame:
    return (
        events.groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            *amount_sums(F.when(F.col("event_type") == "purchase", F.col("price")), "spent"),
        )
        .filter(F.col("event_count") > more_than)
        .select("user_id", "event_count", amount_total("spent").alias("total_spent"))
        .orderBy(F.desc("total_spent"), "user_id")
        .limit(limit)
    )


def distinct_users(events: DataFrame, limit: int = 10) -> DataFrame:
    return events.select("user_id").distinct().orderBy("user_id").limit(limit)


def first_purchaser(events: DataFrame) -> DataFrame:
    return distinct_users(events.filter(F.col("event_type") == "purchase"), 1)


def preview(df: DataFrame, keys: list[str], limit: int = 5) -> DataFrame:
    """First rows in a stated order."""
    return df.orderBy(*keys).limit(limit)

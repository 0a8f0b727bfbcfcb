"""Risk rules, customer-360 profiles and answers to lists of requested users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from custbehav.functions.columns import format_percent, round_half_up

# Texts of the risk report.
ACTIONS = {
    "HIGH": "Urgent win-back promotion, discount offer via notification",
    "MEDIUM": "Personalized engagement email and featured product digest",
    "LOW": "Standard loyalty program engagement",
}
SHORT_SPAN = "Short engagement span (< 3 days)"
NO_PURCHASE = "Zero conversions (views only)"
RARE_VISITS = "Low interaction frequency"
NO_RECORDS = ("User ", " has no records in the event store.")

MAX_ID_DIGITS = 18


def risk_level(score: Column) -> Column:
    return F.when(score >= 0.70, "HIGH").when(score >= 0.40, "MEDIUM").otherwise("LOW")


def suggested_action(level: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in ACTIONS.items() for x in pair]), level)


def risk_drivers() -> Column:
    """Rules about the behaviour that accompany a score; they do not explain the model."""
    return F.array_compact(
        F.array(
            F.when(F.col("days_active") <= 2, SHORT_SPAN),
            F.when(F.col("purchase_rate") == 0, NO_PURCHASE),
            F.when(F.col("events_per_day") < 2, RARE_VISITS),
        )
    )


def churn_report(scored: DataFrame) -> DataFrame:
    """Add the risk fields to users with their features and ``score``."""
    level = risk_level(F.col("score"))
    return scored.withColumns(
        {
            "is_churn": (F.col("score") >= 0.5).cast("int"),
            "churn_probability": round_half_up(F.col("score"), 4),
            "risk_level": level,
            "suggested_action": suggested_action(level),
            "risk_drivers": risk_drivers(),
        }
    )


def profile_columns() -> list[Column]:
    return [
        *[
            F.col(name)
            for name in ("user_id", "first_interaction", "last_interaction", "days_active", "total_events", "total_purchases")
        ],
        round_half_up(F.col("total_spent"), 2).alias("total_spent_usd"),
        format_percent(F.col("purchase_rate")).alias("purchase_rate"),
        F.col("favorite_category"),
    ]


def user_profiles(users: DataFrame) -> DataFrame:
    """The model-free part of the profile."""
    return users.select(*profile_columns())


def customer_360(scored: DataFrame) -> DataFrame:
    """One nested row per user, from users with all scoring columns: a projection."""
    segment = ("cluster_id", "persona_name", "marketing_strategy", "total_spent", "total_events")
    risk = ("is_churn", "churn_probability", "risk_level", "suggested_action", "risk_drivers")
    return scored.select(
        "user_id",
        F.struct(*profile_columns()).alias("user_profile"),
        F.struct(*segment).alias("customer_segmentation"),
        F.struct(*risk).alias("churn_prediction"),
        "recommended_products",
    )


def valid_request(raw_id: Column) -> Column:
    """A positive whole number of at most 18 digits."""
    return raw_id.rlike(f"^[0-9]{{1,{MAX_ID_DIGITS}}}$") & (raw_id.try_cast("bigint") > 0)


def resolve_requests(requests: DataFrame, profiles: DataFrame) -> DataFrame:
    """Every request (``position, requested_id``) with its profile; order and repeats are kept.

    ``status`` is SUCCESS, NOT_FOUND, or INVALID for texts that are no user id.
    """
    asked = requests.withColumn(
        "user_id", F.when(valid_request(F.col("requested_id")), F.col("requested_id").try_cast("bigint"))
    )
    found = profiles.withColumn("_found", F.lit(True))
    status = (
        F.when(F.col("user_id").isNull(), "INVALID").when(F.col("_found"), "SUCCESS").otherwise("NOT_FOUND")
    )
    return asked.join(found, "user_id", "left").select(
        "position",
        "requested_id",
        status.alias("status"),
        F.when(status == "NOT_FOUND", F.concat(F.lit(NO_RECORDS[0]), F.col("requested_id"), F.lit(NO_RECORDS[1]))).alias("message"),
        *[c for c in profiles.columns],
    )


def not_found(requests: DataFrame, profiles: DataFrame) -> DataFrame:
    """Well-formed requests for users without events."""
    valid = requests.filter(valid_request(F.col("requested_id"))).withColumn(
        "user_id", F.col("requested_id").cast("bigint")
    )
    return valid.join(profiles.select("user_id"), "user_id", "left_anti").select("position", "user_id")


def campaign_scores(scored: DataFrame) -> DataFrame:
    """One flat row per user for campaign targeting."""
    return scored.select(
        "user_id", "days_active", "total_spent", F.col("persona_name").alias("persona"),
        F.col("churn_probability").alias("churn_prob"), "risk_level",
    ).fillna({"persona": "Unknown", "churn_prob": 0.0, "risk_level": "UNKNOWN"})


def high_risk(scores: DataFrame) -> DataFrame:
    return scores.filter(F.col("risk_level") == "HIGH")

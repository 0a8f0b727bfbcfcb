import pytest
from pyspark.sql import functions as F

from custbehav.config import PipelineConfig
from custbehav.operators import features, profiles, recommend
from tests.fixtures import made, stored

CFG = PipelineConfig()


def purchases(category, product, n, **other):
    return [
        made(100 + i, category_code=category, product_id=product, at=f"2020-01-01 00:00:{i:02d} UTC", **other)
        for i in range(n)
    ]


def test_top_products_ties_labels_and_price(spark):
    rows = purchases("a.x", 2, 2) + purchases("a.x", 1, 2) + [
        made(1, "2020-01-05 00:00:00 UTC", price=15.0, category_code="a.y", product_id=1, brand="New"),
        made(1, what="view", category_code="a.x", product_id=3), made(1, category_code=None, product_id=4),
    ]
    top = recommend.top_products(stored(spark, rows, CFG), CFG).orderBy("rank").collect()
    assert [(r["product_id"], r["popularity"]) for r in top] == [(1, 3), (2, 2)]
    assert (top[0]["category_code"], top[0]["brand"], top[0]["price"]) == ("a.y", "new", 13.33)


def test_rank_limit(spark):
    rows = [row for p in range(15) for row in purchases("a.x", p, 15 - p)]
    top = recommend.top_products(stored(spark, rows, CFG), CFG)
    assert sorted(r["product_id"] for r in top.collect()) == list(range(10))


def test_recommendations_fill_up_from_other_categories(spark):
    rows = purchases("a.x", 1, 1) + purchases("b.x", 2, 5) + purchases("b.x", 3, 4) + purchases("c.x", 4, 4)
    catalogue = recommend.top_products(stored(spark, rows, CFG), CFG)
    users = spark.createDataFrame([(1, "a"), (2, "b"), (3, "none")], "user_id long, favorite_category string")
    found = {
        r["user_id"]: [p["product_id"] for p in r["recommended_products"]]
        for r in recommend.user_recommendations(users, catalogue, CFG).collect()
    }
    assert found == {1: [1, 2, 3, 4], 2: [2, 3, 4, 1], 3: [2, 3, 4, 1]}
    two = recommend.user_recommendations(users, catalogue, PipelineConfig(recommended_items=2))
    assert {r["user_id"]: [p["product_id"] for p in r["recommended_products"]] for r in two.collect()} == {
        1: [1, 2], 2: [2, 3], 3: [2, 3]
    }
    first = recommend.exploded(recommend.user_recommendations(users, catalogue, CFG)).orderBy("user_id", "rank").first()
    assert first["recommendation_reason"] == "Top trending in 'a' category" and first["price_usd"] == 12.5


def test_recommendations_without_any_purchase(spark):
    catalogue = recommend.top_products(stored(spark, [made(what="view")], CFG), CFG)
    users = spark.createDataFrame([(1, "a")], "user_id long, favorite_category string")
    assert recommend.exploded(recommend.user_recommendations(users, catalogue, CFG)).count() == 0


def test_empty_brand_is_general(spark):
    catalogue = recommend.top_products(stored(spark, purchases("a.x", 1, 1), CFG), CFG).withColumn("brand", F.lit(""))
    users = spark.createDataFrame([(1, "a")], "user_id long, favorite_category string")
    assert recommend.exploded(recommend.user_recommendations(users, catalogue, CFG)).first()["brand"] == "General"


@pytest.mark.parametrize("score, level, churned", [(0.7, "HIGH", 1), (0.699, "MEDIUM", 1), (0.4, "MEDIUM", 0), (0.39, "LOW", 0)])
def test_risk_bands(spark, score, level, churned):
    users = spark.createDataFrame(
        [(1, score, 2, 0.0, 1.9)], "user_id long, score double, days_active long, purchase_rate double, events_per_day double"
    )
    row = profiles.churn_report(users).first()
    assert (row["risk_level"], row["is_churn"]) == (level, churned)
    assert row["suggested_action"] == profiles.ACTIONS[level]
    assert row["risk_drivers"] == [profiles.SHORT_SPAN, profiles.NO_PURCHASE, profiles.RARE_VISITS]


def test_no_drivers(spark):
    users = spark.createDataFrame(
        [(1, 0.1, 3, 0.1, 2.0)], "user_id long, score double, days_active long, purchase_rate double, events_per_day double"
    )
    assert profiles.churn_report(users).first()["risk_drivers"] == []


def test_requests_keep_order_and_repeats(spark):
    users = profiles.user_profiles(features.serving_features(stored(spark, [made(7)], CFG), CFG))
    asked = ["7", "8", "abc", "0", "-7", "7", "1" * 19, None, " 7"]
    requests = spark.createDataFrame(list(enumerate(asked)), "position long, requested_id string")
    rows = profiles.resolve_requests(requests, users).orderBy("position").collect()
    assert [r["status"] for r in rows] == [
        "SUCCESS", "NOT_FOUND", "INVALID", "INVALID", "INVALID", "SUCCESS", "INVALID", "INVALID", "INVALID"
    ]
    assert rows[1]["message"] == "User 8 has no records in the event store."
    assert [r["user_id"] for r in profiles.not_found(requests, users).collect()] == [8]


def test_campaign_defaults(spark):
    scored = spark.createDataFrame(
        [(1, 3, 5.0, None, 0.9, "HIGH"), (2, 3, 5.0, "p", None, None)],
        "user_id long, days_active long, total_spent double, persona_name string, churn_probability double, risk_level string",
    )
    rows = {r["user_id"]: r for r in profiles.campaign_scores(scored).collect()}
    assert rows[1]["persona"] == "Unknown" and (rows[2]["churn_prob"], rows[2]["risk_level"]) == (0.0, "UNKNOWN")
    assert [r["user_id"] for r in profiles.high_risk(profiles.campaign_scores(scored)).collect()] == [1]

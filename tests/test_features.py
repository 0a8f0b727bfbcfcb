import random

import pytest

from custbehav.config import PipelineConfig
from custbehav.operators import features
from tests.fixtures import made, stored

CFG = PipelineConfig()
LEAKAGE = [
    made(1, what="view", price=999), made(1, price=20), made(2, price=30),
    made(1, "2020-02-15 00:00:00 UTC", price=100),
]


def by_user(df):
    return {row["user_id"]: row for row in df.collect()}


def test_revenue_and_future_labels(spark):
    events = stored(spark, LEAKAGE, CFG)
    serving = by_user(features.serving_features(events, CFG))
    assert serving[1]["total_spent"] == 120 and serving[1]["avg_spent"] == 60
    assert by_user(features.user_features(events, CFG))[1]["total_spent"] == 120
    training = by_user(features.user_features(events, CFG, for_churn=True))
    assert training[1]["total_spent"] == 20 and training[1]["total_events"] == 2
    assert training[1]["churned"] == 0 and training[2]["churned"] == 1
    assert by_user(features.churn_labels(events, CFG))[2]["churned"] == 1


def test_event_on_the_cutoff_belongs_to_the_label(spark):
    rows = [made(1), made(1, "2020-01-16 00:00:00 UTC"), made(2, "2020-02-15 00:00:00 UTC"), made(3)]
    training = by_user(features.user_features(stored(spark, rows, CFG), CFG, for_churn=True))
    assert set(training) == {1, 3}
    assert training[1]["total_events"] == 1 and training[1]["churned"] == 0 and training[3]["churned"] == 1


def test_days_active_is_elapsed_time(spark):
    rows = [
        made(1, "2020-01-01 23:59:59 UTC"), made(1, "2020-01-02 00:00:01 UTC"),
        made(2, "2020-01-01 00:00:00 UTC"), made(2, "2020-01-02 00:00:00 UTC"),
    ]
    found = by_user(features.serving_features(stored(spark, rows, CFG), CFG))
    assert found[1]["days_active"] == 1 and found[2]["days_active"] == 2
    assert found[1]["events_per_day"] == 2.0


def test_user_without_purchase(spark):
    row = by_user(features.serving_features(stored(spark, [made(1, what="view")], CFG), CFG))[1]
    assert (row["total_spent"], row["avg_spent"], row["purchase_rate"], row["total_views"]) == (0.0, 0.0, 0.0, 1)


def test_favourite_category_ties_and_default(spark):
    rows = [
        made(1, category_code="b.x"), made(1, category_code="a.x"), made(1, category_code=None),
        made(1, category_code=None, price=11), made(2, category_code=None),
    ]
    events = stored(spark, rows, CFG)
    found = by_user(features.serving_features(events, CFG))
    assert found[1]["favorite_category"] == "a" and found[2]["favorite_category"] == "electronics"
    assert found[1]["unique_categories"] == 3
    assert {r["user_id"]: r["favorite_category"] for r in features.favourite_category(events).collect()} == {1: "a"}


@pytest.mark.parametrize("size", [1, 7, 200, 5000])
def test_sample_takes_the_smallest_hashes(spark, size):
    generator = random.Random(2)
    users = {generator.randint(1, 10**17) for _ in range(1000)} | {2147483647 * k + 5 for k in range(20)}
    frame = spark.createDataFrame([(u,) for u in users for _ in range(2)], "user_id long")
    key = lambda u: (((u % 2147483647) * 1103515245 + 42) % 2147483647, u)
    chosen = features.sampled(frame, frame, size, 42)
    assert {r["user_id"] for r in chosen.distinct().collect()} == set(sorted(users, key=key)[:size])


def test_sample_draws_from_eligible_users_only(spark):
    rows = [made(u) for u in range(1, 20)] + [made(u, "2020-02-20 00:00:00 UTC") for u in range(100, 200)]
    sample = features.user_features(stored(spark, rows, CFG), CFG, for_churn=True, sample_size=15)
    found = by_user(sample)
    assert len(found) == 15 and max(found) < 20


def test_sample_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        features.user_features(stored(spark, LEAKAGE, CFG), CFG, sample_size=0)


def test_reports(spark):
    rows = [made(1, f"2020-01-0{d} 00:00:00 UTC", price=5) for d in range(1, 8)] + [made(2, price=99), made(3, what="view")]
    events = stored(spark, rows, CFG)
    assert [tuple(r) for r in features.top_spenders(events).collect()] == [(1, 7, 35.0)]
    assert [r["user_id"] for r in features.distinct_users(events, 2).collect()] == [1, 2]
    assert features.first_purchaser(events).first()["user_id"] == 1


def test_empty_store_has_no_features(spark):
    events = stored(spark, [made(what="bad")], CFG)
    assert features.user_features(events, CFG, for_churn=True).count() == 0


def test_serving_and_held_out_features_from_one_aggregation(spark):
    pick = random.Random(5)
    rows = [
        made(pick.randint(1, 9), f"2020-0{pick.randint(1, 2)}-{pick.randint(10, 28)} 00:00:00 UTC", product_id=pick.randint(1, 4),
             category_code=pick.choice(["a.x", "b.x", "c", None]), what=pick.choice(["view", "purchase", "cart"]), price=pick.randint(1, 50))
        for _ in range(150)
    ]
    events = stored(spark, [*rows, made(50, "2020-02-27 00:00:00 UTC")], CFG)
    serving, held_out = features.serving_and_held_out(events, CFG)
    one, two = features.serving_features(events, CFG), features.user_features(events, CFG, for_churn=True)
    assert serving.schema.names == one.schema.names and sorted(serving.collect()) == sorted(one.collect())
    assert held_out.schema.names == two.schema.names and sorted(held_out.collect()) == sorted(two.collect())
    assert 50 in by_user(serving) and 50 not in by_user(held_out)
    # Told in plain Python: products count once, whatever categories they are in.
    for user, row in by_user(held_out).items():
        early = [r for r in events.collect() if r.user_id == user and r.event_time < row["label_cutoff"]]
        assert row["unique_products"] == len({r.product_id for r in early}) and row["total_events"] == len(early)
        assert row["unique_categories"] == len({r.category_level1 for r in early})

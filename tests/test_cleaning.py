from datetime import datetime

import pytest
from pyspark.sql import functions as F

from custbehav.config import PipelineConfig
from custbehav.operators import cleaning
from tests.fixtures import made, raw_frame, stored

CFG = PipelineConfig()


def one(spark, **changes):
    return stored(spark, [made(**changes)], CFG).collect()


def test_invalid_rows_and_high_price(spark):
    rows = [
        made(price=100000), made(price=-1, user_session=None), made(what="invalid"), made(at="not-a-date"),
        made(who=None), made(at="2020-02-29 23:59:59 UTC"),
    ]
    kept = stored(spark, rows, CFG).collect()
    assert len(kept) == 2
    assert 100000 in [row["price"] for row in kept]
    assert {row["category_id"] for row in kept} == {"2053013555631882655"}


@pytest.mark.parametrize("price, kept", [
    (0.005, True), (0.0, False), (float("nan"), False), (float("inf"), False), (float("-inf"), False), (None, False),
])
def test_price_rule(spark, price, kept):
    assert bool(one(spark, price=price)) == kept


@pytest.mark.parametrize("time, kept", [
    ("2019-10-01 00:00:00 UTC", True), ("2019-09-30 23:59:59 UTC", False),
    ("2020-02-29 23:59:59 UTC", True), ("2020-02-29 23:59:59.5 UTC", False), (None, False),
])
def test_window_rule(spark, time, kept):
    assert bool(one(spark, at=time)) == kept


@pytest.mark.parametrize("session, kept", [("123456789", False), ("1234567890", True), (None, False)])
def test_session_rule(spark, session, kept):
    assert bool(one(spark, user_session=session)) == kept


def test_event_type_is_matched_exactly(spark):
    assert not one(spark, what=" purchase") and not one(spark, what="Purchase")


@pytest.mark.parametrize("code, levels", [
    ("a", ("a", "unknown", "unknown")), ("a.b", ("a", "b", "unknown")), ("a..b", ("a", "", "b")),
    ("a.b.c.d", ("a", "b", "c")), ("\t A.B ", ("a", "b", "unknown")), (None, ("unknown",) * 3),
    ("   ", ("unknown",) * 3),
])
def test_category_levels(spark, code, levels):
    row = one(spark, category_code=code)[0]
    assert tuple(row[f"category_level{i}"] for i in (1, 2, 3)) == levels


@pytest.mark.parametrize("given, stored_id", [
    ("148.0", "148"), (None, "0"), ("nan", "0"), ("None", "0"), ("<NA>", "0"), ("", "0"), ("1.05", "1.05"),
])
def test_category_id(spark, given, stored_id):
    assert one(spark, category_id=given)[0]["category_id"] == stored_id


def test_calendar(spark):
    row = one(spark, at="2020-01-07 13:14:15.9 UTC")[0]
    assert row["event_time"] == datetime(2020, 1, 7, 13, 14, 15)
    assert (row["hour"], row["day_of_week"], row["day_name"], row["month"], row["year"]) == (13, 1, "Tuesday", 1, 2020)


def test_copies_within_and_across_sources(spark):
    rows = [made(), made(), made(brand=" ORBIT "), made(at="2020-01-01 00:00:00.4 UTC")]
    both = raw_frame(spark, rows, "a.csv").unionByName(raw_frame(spark, rows, "b.csv"))
    assert cleaning.clean(both, CFG).count() == 2


def test_exact_duplicates_are_null_safe(spark):
    rows = [made(brand=None, price=float("nan"))] * 3 + [made(brand=None)]
    assert cleaning.exact_duplicates_removed(raw_frame(spark, rows)).count() == 2


def test_first_broken_rule_is_counted(spark):
    rows = [
        made(), made(price=0, what="bad"), made(what="bad", who=None), made(who=None, user_session="x"),
        made(user_session="x", at="bad"), made(at="bad"), made(at="2021-01-01 00:00:00 UTC"),
    ]
    counted = cleaning.reject_counts(raw_frame(spark, rows), CFG)
    assert {row["reason"]: row["rows"] for row in counted.collect()} == {
        "valid": 1, "price": 1, "event_type": 1, "mandatory_key": 1, "session": 1, "unparsable_time": 1, "outside_window": 1,
    }


def test_text_price_is_coerced(spark):
    raw = raw_frame(spark, [made(), made(who=2)]).withColumn(
        "price", F.when(F.col("user_id") == 1, "12.5").otherwise("cheap")
    )
    assert [row["price"] for row in cleaning.clean(raw, CFG).collect()] == [12.5]

import json
import random

import numpy as np
from pyspark.sql import functions as F

from custbehav.config import PipelineConfig
from custbehav.operators import quality
from tests.fixtures import made, raw_frame

CFG = PipelineConfig()


def report(spark, rows, **options):
    return quality.evaluate(raw_frame(spark, rows), ["source_file"], CFG, **options).first()


def test_clean_rows_pass(spark):
    result = report(spark, [made(who=i) for i in range(5)])
    assert result["passed_gate"] and result["total_records"] == 5 and result["completeness_score"] == 1.0
    assert result["duplicate_count"] == 0


def test_rates(spark):
    rows = [made(who=i, price=float(i)) for i in range(1, 17)]
    rows += [made(who=None), made(what=None), made(price=float("nan")), made(price=0.005, user_session="short")]
    result = report(spark, rows)
    assert result["null_rate_user_id"] == 0.05 and result["null_rate_event_type"] == 0.05
    assert result["completeness_score"] == 0.975
    assert result["valid_event_types_rate"] == 0.95
    assert result["price_valid_rate"] == 0.9 and not result["passed_gate"]
    assert result["session_valid_rate"] == 0.95


def test_last_second_of_window_is_valid_for_the_gate(spark):
    rows = [made(at="2020-02-29 23:59:59.9 UTC"), made(at="2020-03-01 00:00:00 UTC")]
    assert report(spark, rows)["valid_date_rate"] == 0.5


def test_duplicates_are_null_safe(spark):
    rows = [made(brand=None, price=float("nan"))] * 3 + [made(), made()]
    result = report(spark, rows)
    assert (result["duplicate_count"], result["duplicate_rate"], result["total_records"]) == (3, 0.6, 5)


def test_outlier_rate_uses_the_interpolated_quantile(spark):
    generator = random.Random(1)
    prices = [round(generator.lognormvariate(3, 2), 2) for _ in range(3000)]
    result = report(spark, [made(who=i, price=p) for i, p in enumerate(prices)])
    limit = np.quantile(prices, 0.99)
    assert result["price_outlier_rate"] == round(float(np.mean(np.array(prices) > limit)), 4)


def test_groups_without_rows_fail(spark):
    expected = spark.createDataFrame([("sample.csv",), ("empty.csv",)], "source_file string")
    reports = quality.evaluate(raw_frame(spark, [made()]), ["source_file"], CFG, expected=expected).collect()
    by_source = {row["source_file"]: row for row in reports}
    assert by_source["sample.csv"]["passed_gate"]
    assert not by_source["empty.csv"]["passed_gate"] and by_source["empty.csv"]["total_records"] == 0


def test_null_group_is_reported(spark):
    reports = quality.evaluate(raw_frame(spark, [made(what=None), made()]), ["event_type"], CFG).collect()
    assert {row["event_type"]: row["total_records"] for row in reports} == {None: 1, "purchase": 1}


def test_absent_columns(spark):
    frame = raw_frame(spark, [made()]).drop("user_id", "user_session", "price")
    result = quality.evaluate(frame, ["source_file"], CFG).first()
    assert result["null_rate_user_id"] == 1.0 and result["session_valid_rate"] == 1.0
    assert result["price_valid_rate"] == 1.0 and result["price_outlier_rate"] == 0.0
    assert not result["passed_gate"]


def test_copies_column_equals_repeated_rows(spark):
    rows = [made(), made(), made(who=None), made(price=-3)]
    raw = raw_frame(spark, rows)
    counted = quality.distinct_with_copies(raw, ["source_file"]).withColumnRenamed("copies", "times")
    direct = quality.evaluate(raw, ["source_file"], CFG).collect()
    assert direct == quality.evaluate(counted, ["source_file"], CFG, copies="times").collect()


def test_gate_agrees_with_the_report(spark):
    raw = raw_frame(spark, [made(), made(), made(what="bad")])
    assert quality.gate(raw, ["source_file"], CFG).first()["passed_gate"] is False
    assert quality.gate(raw.filter(F.col("event_type") != "bad"), ["source_file"], CFG).first()["passed_gate"] is True


def test_details_json(spark):
    reports = quality.evaluate(raw_frame(spark, [made()]), ["source_file"], CFG)
    details = json.loads(reports.select(quality.details_json(reports).alias("d")).first()["d"])
    assert details["total_records"] == 1 and details["passed_gate"] is True


def test_load_status(spark):
    raw = raw_frame(spark, [made(), made(), made(what="x")]).withColumn("batch", F.lit(1))
    row = quality.load_log(raw, ["source_file", "batch"], CFG).first()
    assert (row["rows_read"], row["rows_inserted"], row["duplicates_removed"], row["rows_rejected"]) == (3, 1, 1, 1)
    assert row["status"] == "QUALITY_WARNING"
    none = quality.load_log(raw.filter("event_type = 'x'"), ["source_file", "batch"], CFG).first()
    assert none["status"] == "FAILED"

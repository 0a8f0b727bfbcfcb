import json

from custbehav.config import CHURN_MODEL, SEGMENT_MODEL, PipelineConfig
from custbehav.operators import marts, monitoring
from custbehav.schema import REGISTRY, RUN_LOG
from tests.fixtures import made, stored

CFG = PipelineConfig()


def registry(spark, *entries):
    rows = [(name, version, "x", {}, {}, "p", schema, None) for name, version, schema in entries]
    return spark.createDataFrame(rows, REGISTRY)


def run_log(spark, *entries):
    rows = [(i, "ETL", source, "events", 1, 1, 0, 0, 2.5, status, None, None) for i, source, status in entries]
    return spark.createDataFrame(rows, RUN_LOG)


def found(df):
    return {(r["severity"], r["component"]) for r in df.collect()}


def test_alerts_of_an_unused_store(spark):
    assert found(monitoring.alerts(None, registry(spark), None, CFG)) == {
        ("CRITICAL", "Database"), ("HIGH", "ModelRegistry"), ("HIGH", "ModelSchema")
    }


def test_alerts_follow_the_latest_state(spark):
    models = registry(spark, (SEGMENT_MODEL, "1", "1.0"), (SEGMENT_MODEL, "2", "2.0"), (CHURN_MODEL, "1", "2.0"))
    log = run_log(spark, (1, "a", "FAILED"), (2, "b", "SUCCESS"), (3, "a", "SUCCESS"), (4, "b", "FAILED"), (5, "c", "QUALITY_WARNING"))
    empty = stored(spark, [made(what="bad")], CFG)
    alerts = monitoring.alerts(empty, models, log, CFG)
    assert found(alerts) == {("WARNING", "Database"), ("HIGH", "ETLPipeline"), ("WARNING", "DataQualityGate")}
    assert any(r["message"].startswith("b: FAILED.") for r in alerts.collect())
    fine = monitoring.alerts(stored(spark, [made()], CFG), models, run_log(spark, (1, "a", "SUCCESS")), CFG)
    assert fine.count() == 0


def test_stale_schema(spark):
    models = registry(spark, (SEGMENT_MODEL, "1", "2.0"), (SEGMENT_MODEL, "2", "1.0"), (CHURN_MODEL, "1", None))
    assert found(monitoring.alerts(stored(spark, [made()], CFG), models, None, CFG)) == {("HIGH", "ModelSchema")}
    missing = monitoring.alerts(stored(spark, [made()], CFG), registry(spark, (CHURN_MODEL, "1", "2.0")), None, CFG)
    assert SEGMENT_MODEL in [r["message"] for r in missing.collect() if r["component"] == "ModelRegistry"][0]


def test_history_and_counts(spark):
    log = run_log(spark, *[(i, "a", "SUCCESS") for i in range(30)])
    assert [r["id"] for r in monitoring.run_history(log).collect()] == list(range(29, 9, -1))
    assert [r["execution_seconds"] for r in monitoring.latency_by_status(log).collect()] == [2.5] * 30
    counts = {r["table_name"]: r["row_count"] for r in monitoring.table_counts({"log": log, "none": None}).collect()}
    assert counts == {"log": 30, "none": 0}


def test_snapshot(spark):
    alerts = monitoring.alerts(None, registry(spark), None, CFG)
    counts = monitoring.table_counts({"log": run_log(spark, (1, "a", "SUCCESS"))})
    snapshot = json.loads(monitoring.health_snapshot(counts, registry(spark), alerts, CFG).toJSON().first())
    assert len(snapshot["alerts"]) == 3 and snapshot["health"]["tables"] == [{"table_name": "log", "row_count": 1}]
    assert not snapshot["health"]["models"][0]["registered"]


def test_marts(spark):
    rows = [made(1, what="view"), made(2, what="view"), made(3, what="view"), made(1, price=2.0),
            made(1, "2020-01-02 00:00:00 UTC", category_code="cosmetics", category_id="5", product_id=11, brand="b")]
    events = stored(spark, rows, CFG)
    products = {r["product_id"]: r for r in marts.dim_products(events).collect()}
    assert products[4711]["conversion_rate"] == 33.33 and products[11]["conversion_rate"] is None
    categories = {r["category_id"]: r for r in marts.dim_categories(events).collect()}
    assert categories["5"]["category_level1"] == "cosmetics" and categories["5"]["category_level2"] is None
    tuesday = marts.dim_date(stored(spark, [made(at="2019-10-01 10:00:00 UTC")], CFG)).first()
    assert (tuesday["date_key"], tuesday["day_of_week"], tuesday["quarter"], tuesday["is_weekend"]) == (20191001, 3, 4, False)
    brands = marts.dim_brand(events, PipelineConfig(popular_brands=1))
    assert [r["brand_key"] for r in brands.orderBy("brand_name").collect()] == [1, 2]
    assert marts.fact_sales_daily(events, brands).count() == 2
    assert {r["user_session"] for r in marts.zero_sessions(events).collect()} == set()

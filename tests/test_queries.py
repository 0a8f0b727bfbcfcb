import pytest

import __spark_entry__ as registry
from custbehav import oracle
from tests.compare import difference, duck

ORACLES = oracle.statements()


@pytest.fixture(scope="module")
def connection(sf):
    pytest.importorskip("duckdb")
    return duck(sf)


def test_every_query_of_the_library_has_sql():
    assert {query.__name__ for query in registry.QUERIES} == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, connection, name):
    assert difference(registry.queries()[name](spark, sf), connection, ORACLES[name]) is None


@pytest.mark.parametrize("name", ["clean_events", "user_features_pre_cutoff", "category_top_products", "quality_by_type",
                                  "user_recommendations", "price_iqr"])
def test_result_does_not_depend_on_partitions(spark, sf, name):
    results = []
    for partitions in ("1", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            results.append(sorted(map(repr, registry.queries()[name](spark, sf).collect())))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]


def test_entry(spark):
    assert registry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["scaled_features", "segment_silhouette"])
def test_users_are_built_once(spark, sf, name):
    """What is left to run reads written users; the lines are not joined and added up again."""
    plan = registry.queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan


@pytest.mark.parametrize("name, reads", [("churn_scores", 1), ("churn_agreement", 1), ("high_risk_users", 1), ("campaign_scores", 1),
                                         ("customer_360", 2)])
def test_events_are_added_up_once_for_users_and_model(spark, sf, name, reads, monkeypatch):
    found, orders = [], registry._orders
    monkeypatch.setattr(registry, "_orders", lambda *a: found.append(a) or orders(*a))
    model = registry.churn.ChurnModel(None, {}, None)
    monkeypatch.setattr(registry.churn, "train_churn", lambda *a: model)
    monkeypatch.setattr(registry.churn, "score_churn", lambda users, pipeline: users.withColumn("score", registry.F.lit(0.5)))
    monkeypatch.setattr(registry, "_segmented", lambda training, users: users.selectExpr("*", "0 cluster_id", "'Segment 0' persona_name", "'' marketing_strategy"))
    monkeypatch.setattr(registry.exported, "tree_nodes", lambda *a: None)
    monkeypatch.setattr(registry.exported, "mean_of_trees", lambda users, *a: users.selectExpr("user_id", "0.5D mean_share"))
    assert registry.queries()[name](spark, sf) is not None and len(found) == reads

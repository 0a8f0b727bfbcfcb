"""Registered queries and their SQL counterparts.

``queries()`` runs the operators over the benchmark tables through the event views of
``custbehav.sources.adapters``; ``oracle_sql()`` states the same results in plain SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ByteType, DateType, IntegerType, ShortType, TimestampType

from custbehav import oracle
from custbehav.config import CHURN_MODEL, CLUSTERING_FEATURES, SEGMENT_MODEL, PipelineConfig
from custbehav.operators import (
    churn, cleaning, exported, features, marts, monitoring, profiles, quality, readiness, recommend, segments, silhouette,
)
from custbehav.plans import snapshots
from custbehav.plans.ingest import ingest, ingest_source, judge_loads, persist_reports, source_decisions
from custbehav.plans.models import current_models, load_verdicts
from custbehav.session import configure, cut_lineage, run_folder
from custbehav.schema import EVENTS, RAW, REGISTRY
from custbehav.sources import adapters, versions
from custbehav.sources.raw_files import read_csv, read_json
from custbehav.sources.store import EventStore

try:
    import corpus_pipeline
    from custbehav.llm import oracle as llm_oracle, queries as llm_queries
except ImportError:  # the training-data operators are an optional part, and so are the libraries only they need
    corpus_pipeline = llm_queries = llm_oracle = None

BEHAVIOR = PipelineConfig(min_event_date="2024-01-01", max_event_date="2024-01-30", inactive_days=1)
ORDERS = PipelineConfig(min_event_date="1995-01-01", max_event_date="2001-08-01", inactive_days=180)
# The hourly batches have many invalid event types; this limit lets some of them pass.
BATCHES = PipelineConfig(min_event_date="2024-01-01", max_event_date="2024-01-30", min_type_rate=0.6)
# Days at both ends of the data lie outside this window.
NARROW = PipelineConfig(min_event_date="2024-01-03", max_event_date="2024-01-27", min_type_rate=0.6)
SAMPLE_USERS = 500


def _plain(df: DataFrame) -> DataFrame:
    """Types every engine shares: whole numbers as bigint, dates and times as text."""

    def column(field):
        name = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (ByteType, ShortType, IntegerType)):
            return name.cast("bigint").alias(field.name)
        if isinstance(field.dataType, TimestampType):
            return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        if isinstance(field.dataType, DateType):
            return name.cast("string").alias(field.name)
        return name

    return df.select(*[column(field) for field in df.schema.fields])


def _stored(events: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Typed events without copies, in the form of the event store."""
    tagged = events.withColumn("source_file", F.lit("events"))
    return cleaning.derive(cleaning.normalise(tagged, cfg)).select(*EVENTS.names)


def _behavior(spark, folder):
    return _stored(adapters.behavior(spark, folder), BEHAVIOR)


def _orders(spark, folder):
    return _stored(adapters.order_behavior(spark, folder), ORDERS)


def _requests(spark, folder):
    """Requests for users in the order of the order keys, with repeats and malformed ids."""
    orders = adapters.table(spark, folder, "orders")
    return orders.select(
        F.col("o_orderkey").alias("position"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("c-"), F.col("o_custkey").cast("string")))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("requested_id"),
    )


def _rule_scores(spark, folder):
    """Churn label of every user, scored by the share of events that are no purchase."""
    users = features.user_features(_orders(spark, folder), ORDERS, for_churn=True)
    score = F.lit(1e0) - F.col("purchase_rate")
    return users.select(
        "user_id", F.col("churned").alias("label"), score.alias("score"), (score >= 0.5).cast("int").alias("prediction")
    )


def _run_log(spark, folder):
    """Load log of the hourly batches of the daily sources; the batch number is the run's id."""
    return quality.load_log(adapters.raw_behavior(spark, folder), ["source_file", "batch"], BATCHES).withColumnRenamed(
        "batch", "id"
    )


def _no_models(spark):
    return spark.createDataFrame([], REGISTRY)


# Queries


def clean_events(spark, folder):
    return cleaning.clean(adapters.raw_behavior(spark, folder), BEHAVIOR)


def distinct_raw_rows(spark, folder):
    rows = cleaning.exact_duplicates_removed(adapters.raw_behavior(spark, folder))
    return rows.groupBy("source_file").agg(F.count(F.lit(1)).alias("distinct_rows"))


def reject_reasons(spark, folder):
    return cleaning.reject_counts(adapters.raw_behavior(spark, folder), BEHAVIOR)


def quality_report(spark, folder):
    raw = adapters.raw_behavior(spark, folder).withColumn("source", F.lit("events"))
    return quality.evaluate(raw, ["source"], BEHAVIOR)


def quality_by_type(spark, folder):
    return quality.evaluate(adapters.raw_behavior(spark, folder), ["event_type"], BEHAVIOR)


def quality_by_source(spark, folder):
    return quality.evaluate(adapters.raw_behavior(spark, folder), ["source_file"], BEHAVIOR)


def duplicate_rows(spark, folder):
    return quality.duplicate_counts(adapters.raw_behavior(spark, folder), ["source_file"])


def user_features(spark, folder):
    return features.user_features(_behavior(spark, folder), BEHAVIOR)


def user_features_pre_cutoff(spark, folder):
    return features.user_features(_orders(spark, folder), ORDERS, for_churn=True)


def serving_features(spark, folder):
    return features.serving_features(_behavior(spark, folder), BEHAVIOR)


def churn_labels(spark, folder):
    return features.churn_labels(_orders(spark, folder), ORDERS)


def churn_labels_daily(spark, folder):
    return features.churn_labels(_behavior(spark, folder), BEHAVIOR)


def user_sample(spark, folder):
    events = _orders(spark, folder)
    rows = features.sampled(events, events, SAMPLE_USERS, ORDERS.seed)
    return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))


def favourite_category(spark, folder):
    return features.favourite_category(_behavior(spark, folder))


def top_spenders(spark, folder):
    return features.top_spenders(_orders(spark, folder))


def distinct_users(spark, folder):
    return features.distinct_users(_orders(spark, folder))


def first_purchaser(spark, folder):
    return features.first_purchaser(_orders(spark, folder))


def events_preview(spark, folder):
    return features.preview(_behavior(spark, folder), ["event_time", "user_id", "product_id"])


def category_top_products(spark, folder):
    return recommend.top_products(_behavior(spark, folder), BEHAVIOR)


def user_recommendations(spark, folder):
    events = _behavior(spark, folder)
    users = features.serving_features(events, BEHAVIOR).select("user_id", "favorite_category")
    return recommend.exploded(
        recommend.user_recommendations(users, recommend.top_products(events, BEHAVIOR), BEHAVIOR)
    )


def _profiles(spark, folder):
    return profiles.user_profiles(features.serving_features(_behavior(spark, folder), BEHAVIOR))


def requested_profiles(spark, folder):
    return profiles.resolve_requests(_requests(spark, folder), _profiles(spark, folder))


def not_found_users(spark, folder):
    return profiles.not_found(_requests(spark, folder), _behavior(spark, folder).select("user_id").distinct())


def risk_bands(spark, folder):
    level = profiles.risk_level(F.col("score"))
    return _rule_scores(spark, folder).select(
        "user_id", level.alias("risk_level"), profiles.suggested_action(level).alias("suggested_action")
    )


def risk_drivers(spark, folder):
    users = features.serving_features(_behavior(spark, folder), BEHAVIOR)
    return users.select("user_id", F.concat_ws("; ", profiles.risk_drivers()).alias("risk_drivers"))


def threshold_metrics(spark, folder):
    return churn.threshold_metrics(_rule_scores(spark, folder))


def ranking_metrics(spark, folder):
    found = churn.ranking_metrics(_rule_scores(spark, folder))
    return found.select(*[F.round(c, 9).alias(c) for c in found.columns])


def majority_baseline(spark, folder):
    is_test = features.sample_hash(F.col("user_id"), ORDERS.seed) < 429496729
    return churn.majority_baseline(_rule_scores(spark, folder).withColumn("is_test", is_test))


def stratified_split(spark, folder):
    users = features.user_features(_orders(spark, folder), ORDERS, for_churn=True)
    return churn.stratified_split(users, ORDERS.test_share, ORDERS.seed).select("user_id", "churned", "is_test")


def segment_personas(spark, folder):
    """Summary and persona of groups given by the number of purchases."""
    users = features.user_features(_orders(spark, folder), ORDERS)
    return segments.personas(
        segments.cluster_summary(users.withColumn("cluster", F.least(F.floor(F.col("total_purchases") / 10), F.lit(4))))
    )


def _users(spark, folder):
    return cut_lineage(features.serving_features(_orders(spark, folder), ORDERS))


def _trained_churn(spark, folder):
    held_out = cut_lineage(features.user_features(_orders(spark, folder), ORDERS, for_churn=True))
    return churn.train_churn(held_out, ORDERS)


def _users_and_churn(spark, folder):
    """All users, and the churn model trained on what they did before the cutoff: the events are read once for both."""
    users, held_out = features.serving_and_held_out(_orders(spark, folder), ORDERS)
    return users, churn.train_churn(held_out, ORDERS)


def _segmented(training, users):
    model = segments.train_segments(training, ORDERS)
    return segments.assign_segments(users, model.pipeline, model.personas)


def _risky(users, model):
    return profiles.churn_report(churn.score_churn(users, model.pipeline))


def _band_follows():
    """The stored probability has four digits; the band is that of the exact one."""
    probability, level = F.col("churn_probability"), F.col("risk_level")
    near = F.lit(5e-5)
    return (profiles.risk_level(probability - near) == level) | (profiles.risk_level(probability + near) == level)


def _in_unit(column):
    return F.col(column).between(0.0, 1.0)


def scaled_features(spark, folder):
    users = _users(spark, folder)
    scaled = segments.scaling(users).transform(users).select("user_id", vector_to_array("scaled").alias("v"))
    return scaled.select(
        "user_id", *[F.round(F.get("v", F.lit(i)), 6).alias(f"scaled_{c}") for i, c in enumerate(CLUSTERING_FEATURES)]
    )


def user_segments(spark, folder):
    """Every user with whether the segment exists and is named by the behaviour of its members."""
    users = _users(spark, folder)
    assigned = cut_lineage(_segmented(users, users.select("user_id", *CLUSTERING_FEATURES)))
    told = segments.personas(segments.cluster_summary(assigned.withColumnRenamed("cluster_id", "cluster")))
    told = told.select(F.col("cluster").alias("cluster_id"), F.struct("persona_name", "marketing_strategy").alias("told"))
    clusters = assigned.agg(F.countDistinct("cluster_id")).scalar()
    return assigned.join(told, "cluster_id").select(
        "user_id",
        F.col("cluster_id").between(0, ORDERS.n_clusters - 1).alias("segment_exists"),
        (F.struct("persona_name", "marketing_strategy") == F.col("told")).alias("persona_fits"),
        clusters.alias("segments"),
    )


def segment_agreement(spark, folder):
    """Every user with whether the segment is that of the nearest of the exported centres."""
    users = _users(spark, folder)
    model = segments.train_segments(users, ORDERS)
    placed = exported.nearest_centre(users, exported.segment_centres(spark, model.pipeline))
    assigned = segments.assign_segments(users.select("user_id", *CLUSTERING_FEATURES), model.pipeline, model.personas)
    # Two centres may be equally near but for rounding.
    nearest = (F.col("cluster_id") == F.col("nearest")) | (F.col("next_distance") - F.col("distance") < 1e-9)
    return assigned.join(placed, "user_id").select("user_id", nearest.alias("nearest_centre"))


def churn_agreement(spark, folder):
    """Every user with whether the score is the mean of the leaves that the user reaches in the exported trees."""
    users, model = _users_and_churn(spark, folder)
    nodes = exported.tree_nodes(model.pipeline, f"{run_folder(spark)}/forest")
    scored = churn.score_churn(users, model.pipeline).select("user_id", "score")
    both = scored.join(exported.mean_of_trees(users, nodes, ORDERS.tree_depth), "user_id")
    return both.select("user_id", (F.abs(F.col("score") - F.col("mean_share")) < 1e-9).alias("mean_of_trees"))


def churn_scores(spark, folder):
    """Drivers of every user, and whether band, action and label follow from the score."""
    risky = _risky(*_users_and_churn(spark, folder))
    return risky.select(
        "user_id",
        _in_unit("churn_probability").alias("in_range"),
        _band_follows().alias("band_follows"),
        (F.col("suggested_action") == profiles.suggested_action(F.col("risk_level"))).alias("action_follows"),
        ((F.col("is_churn") == 1) == (F.col("score") >= 0.5)).alias("label_follows"),
        F.concat_ws("; ", "risk_drivers").alias("risk_drivers"),
    )


def feature_importance(spark, folder):
    """The number of features, and whether their importances are shares of one and those of the trees' gains."""
    importance, model = F.col("importance"), _trained_churn(spark, folder)
    nodes = exported.tree_nodes(model.pipeline, f"{run_folder(spark)}/forest")
    gains = exported.importance_of_nodes(nodes).withColumnRenamed("importance", "share")
    return model.importance.join(gains, "feature", "left").agg(
        F.countDistinct("feature").alias("features"),
        F.min(importance >= 0).alias("not_negative"),
        (F.abs(F.sum(importance) - 1.0) < 1e-9).alias("sum_to_one"),
        F.min(F.abs(importance - F.coalesce("share", F.lit(0e0))) < 1e-9).alias("shares_of_gain"),
    )


def churn_evaluation(spark, folder):
    """Users and classes of the held-out part with the majority baseline, and whether the model's metrics follow.

    The metrics are computed once more from the exported trees.
    """
    table = cut_lineage(features.user_features(_orders(spark, folder), ORDERS, for_churn=True))
    model = churn.train_churn(table, ORDERS)
    test = cut_lineage(churn.stratified_split(table, ORDERS.test_share, ORDERS.seed))
    nodes = exported.tree_nodes(model.pipeline, f"{run_folder(spark)}/forest")
    held = test.filter("is_test")
    scored = held.join(exported.mean_of_trees(held, nodes, ORDERS.tree_depth), "user_id").select(
        F.col("churned").alias("label"), F.col("mean_share").alias("score"), (F.col("mean_share") >= 0.5).cast("int").alias("prediction")
    )
    again = {**churn.threshold_metrics(scored).first().asDict(), **churn.ranking_metrics(scored).first().asDict()}
    follow = all(abs(model.metrics[name] - value) < 1e-3 for name, value in again.items())
    counts = held.agg(F.count(F.lit(1)).alias("test_users"), F.count_if(F.col("churned") == 1).alias("churned"))
    baseline = churn.majority_baseline(test.select("is_test", F.col("churned").alias("label")))
    return counts.join(baseline, F.lit(True)).withColumn("metrics_follow", F.lit(follow))


def campaign_scores(spark, folder):
    """Every request with its status and, for a known user, the behaviour and whether the scores are sound."""
    (users, model), requests = _users_and_churn(spark, folder), _requests(spark, folder)
    wanted = requests.filter(profiles.valid_request(F.col("requested_id")))
    chosen = users.join(wanted.select(F.col("requested_id").cast("bigint").alias("user_id")), "user_id", "left_semi")
    answered = profiles.resolve_requests(
        requests, profiles.campaign_scores(_risky(_segmented(users, chosen), model))
    )
    band = F.col("risk_level").isin("HIGH", "MEDIUM", "LOW") & F.col("churn_prob").between(0.0, 1.0)
    return answered.select(
        "position", "requested_id", "status", "user_id", "days_active", "total_spent",
        (band & F.col("persona").startswith("Segment ")).alias("scored"),
    )


def high_risk_users(spark, folder):
    """Whether the extract holds users of the highest band only, and all of them."""
    risky = cut_lineage(_risky(*_users_and_churn(spark, folder)))
    extract = profiles.high_risk(risky)
    found = extract.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.min(F.col("score") >= 0.7), F.lit(True)).alias("high"))
    wanted = risky.agg(F.count_if(F.col("score") >= 0.7)).scalar()
    return found.select(F.col("high").alias("only_high"), (F.col("n") == wanted).alias("all_high"))


def customer_360(spark, folder):
    """Profile and recommended products of every user, and whether segment and risk are sound."""
    users, model = _users_and_churn(spark, folder)
    catalogue = recommend.top_products(_orders(spark, folder), ORDERS)
    risky = _risky(_segmented(users, users), model)
    table = profiles.customer_360(recommend.user_recommendations(risky, catalogue, ORDERS))
    products = F.transform("recommended_products", lambda item: item["product_id"].cast("string"))
    risk, segment = F.col("churn_prediction"), F.col("customer_segmentation")
    return table.select(
        "user_profile.*",
        F.array_join(products, ",").alias("recommended"),
        (risk["churn_probability"].between(0.0, 1.0) & risk["risk_level"].isin("HIGH", "MEDIUM", "LOW")).alias("risk_sound"),
        segment["persona_name"].startswith("Segment ").alias("segment_sound"),
    )


def decisions_for_sources(spark, folder):
    """Daily sources against the manifest of a load made before copies of their rows came in.

    A source is known by its number of purchases. Sources up to the middle of the month were loaded in
    full, later ones as a sample.
    """
    raw = adapters.raw_behavior(spark, folder)
    purchases = F.count_if(F.col("event_type") == "purchase")
    listing = raw.groupBy("source_file").agg(purchases.cast("string").alias("fingerprint"))
    earlier = quality.distinct_with_copies(raw, ["source_file"]).groupBy("source_file")
    manifest = earlier.agg(purchases.alias("rows_loaded")).select(
        "source_file",
        F.col("rows_loaded").cast("string").alias("fingerprint"),
        F.when(F.col("source_file") > "events-2024-01-15.csv", F.lit(200_000)).alias("row_limit"),
        "rows_loaded",
    )
    return source_decisions(listing, manifest, 100_000)


def reject_reasons_narrow(spark, folder):
    return cleaning.reject_counts(adapters.raw_behavior(spark, folder), NARROW)


def _narrow_log(spark, folder):
    """Load log under the narrow window: batches outside it have no valid row and fail."""
    raw = adapters.raw_behavior(spark, folder)
    return quality.load_log(raw, ["source_file", "batch"], NARROW).withColumnRenamed("batch", "id")


def latest_status_narrow(spark, folder):
    return monitoring.latest_per_key(_narrow_log(spark, folder), "source_file", "id")


def alerts_narrow(spark, folder):
    log = _narrow_log(spark, folder)
    return monitoring.alerts(_behavior(spark, folder), _registry(spark, folder), log, BEHAVIOR)


def _registry(spark, folder):
    """Versions of the two models: one per day of orders, from the customers of even and of odd number.

    The day of the month decides the feature schema; some days have an old one, some none.
    """
    orders = adapters.table(spark, folder, "orders")
    day = F.col("o_orderdate").cast("date")
    model = F.when(F.col("o_custkey") % 2 == 0, SEGMENT_MODEL).otherwise(CHURN_MODEL)
    trained = orders.groupBy(day.alias("day"), model.alias("model_name")).agg(F.count(F.lit(1)).alias("samples"))
    key = F.dayofmonth("day")
    rows = trained.select(
        "model_name",
        F.date_format("day", "yyyyMMdd").alias("version"),
        F.create_map(F.lit("training_samples"), F.col("samples").cast("double")).alias("metrics"),
        F.when(key % 5 == 4, "1.0").when(key % 7 != 6, "2.0").alias("feature_schema_version"),
        F.col("day").cast("timestamp").alias("trained_at"),
    )
    known = rows.columns
    return rows.select(
        *[(F.col(f.name) if f.name in known else F.lit(None).cast(f.dataType)).alias(f.name) for f in REGISTRY.fields]
    )


def model_status(spark, folder):
    return monitoring.schema_currency(_registry(spark, folder), BEHAVIOR)


def registry_summary(spark, folder):
    """Current versions of a registry that four writers append to at the same time."""
    store, entries = EventStore(spark, run_folder(spark)), cut_lineage(_registry(spark, folder))
    writer = inheritable_thread_target(spark)(
        lambda i: store.append("registry", entries.filter(F.dayofmonth("trained_at") % 4 == i))
    )
    with ThreadPool(4) as pool:
        pool.map(writer, range(4))
    log = store.log("registry")
    latest = current_models(log).withColumn("versions", log.agg(F.count(F.lit(1))).scalar())
    samples = F.col("metrics")["training_samples"].cast("bigint").alias("training_samples")
    return latest.select("model_name", "version", "feature_schema_version", samples, "versions")


def load_guard(spark, folder):
    """At the middle of every year: may the current version of each model be loaded?"""
    registry = cut_lineage(_registry(spark, folder))
    names, found = (SEGMENT_MODEL, CHURN_MODEL, "price_forecast"), None
    for year in range(1994, 2002):
        for day in ("0605", "0714"):
            known = registry.filter(F.col("version") <= f"{year}{day}")
            verdicts = load_verdicts(known, names, BEHAVIOR).select(F.lit(f"{year}{day}").alias("as_of"), "model_name", "version", "verdict")
            found = verdicts if found is None else found.unionByName(verdicts)
    return found


def segment_silhouette(spark, folder):
    """Silhouettes of the groups given by the number of purchases, per group and of all, over the seeded sample."""
    users = cut_lineage(features.user_features(_orders(spark, folder), ORDERS))
    scaled = segments.scaling(users).transform(users)
    cluster = F.least(F.floor(F.col("total_purchases") / 10), F.lit(4))
    points = scaled.select("user_id", cluster.alias("cluster"), vector_to_array("scaled").alias("vector"))
    found = silhouette.silhouette_by_cluster(silhouette.silhouettes(points, ORDERS))
    return found.select(
        "cluster", "users", *[F.round(c, 6).alias(c) for c in ("silhouette_euclidean", "silhouette_squared")]
    )


def _written(rows: DataFrame, path: str) -> str:
    """Raw rows as CSV files with a header, as a source would deliver them."""
    texts = rows.select(*[F.col(name).cast("string").alias(name) for name in RAW.names])
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    texts.write.mode("overwrite").options(**options).csv(path)
    return path


def source_replacement(spark, folder):
    """Load folders of three sources after a replacement, a malformed reload and one that fails before its commit.

    The sources are loaded with the even hours first and reloaded with all hours.
    """
    store, data = EventStore(spark, run_folder(spark)), run_folder(spark)
    third = F.coalesce(F.col("user_id"), F.lit(0)) % 3
    raw = cut_lineage(adapters.raw_behavior(spark, folder).withColumn("third", third))
    names = tuple(f"third-{i}.csv" for i in range(3))
    whole = [raw.filter(F.col("third") == i) for i in range(3)]
    for name, rows in zip(names, whole):
        _written(rows.filter(F.col("batch") % 2 == 0), f"{data}/{name}")
    ingest(store, data, BEHAVIOR, sources=names)

    def refused(load, words):
        try:
            load()
        except Exception as error:
            if words not in str(error):
                raise
        else:
            raise AssertionError("the load should have been refused")

    _written(whole[0], f"{data}/{names[0]}")
    ingest(store, data, BEHAVIOR, sources=names[:1])
    _written(whole[1].withColumn("user_id", F.concat(F.lit("user "), F.col("user_id").cast("string"))), f"{data}/{names[1]}")
    refused(lambda: ingest(store, data, BEHAVIOR, sources=names[1:2]), "user ")
    _written(whole[2], f"{data}/{names[2]}")
    # The rows are written, and then the file is found to be another one than was decided on.
    refused(lambda: ingest_source(store, data, names[2], "of another file", BEHAVIOR), "while it was being loaded")

    attempt = F.row_number().over(Window.partitionBy("source_file").orderBy("load_id"))
    runs = store.log("run_log").groupBy("source_file").agg(F.sort_array(F.collect_list(F.struct("id", "status"))).alias("runs"))
    visible = store.events().groupBy("source_file").agg(F.count(F.lit(1)).alias("visible_rows"))
    loads = store.load_states().withColumn("attempt", attempt).join(visible, "source_file").join(runs, "source_file")
    return loads.select("source_file", "attempt", "state", "rows", "visible_rows", F.array_join("runs.status", ",").alias("runs"))


def csv_round_trip(spark, folder):
    """The dirty events written as CSV and read back: quotes and line breaks inside fields, tokens for missing values."""
    part = F.col("product_id")
    raw = adapters.raw_behavior(spark, folder).withColumns(
        {
            "brand": F.when(part % 5 == 1, F.concat(F.lit('say "'), "brand", F.lit('",\r\n\nthen, more'))).otherwise(F.col("brand")),
            "category_code": F.when(part % 7 == 2, "N/A").otherwise(F.col("category_code")),
        }
    )
    return read_csv(spark, _written(raw, f"{run_folder(spark)}/events.csv"))


def bounded_load(spark, folder):
    """The first 600 events of an ordered source of several files, each read in several splits."""
    events = adapters.table(spark, folder, "events")
    ordered = events.repartitionByRange(6, "event_id").sortWithinPartitions("event_id").select(
        F.col("ts").alias("event_time"), "event_type", F.col("event_id").alias("product_id"),
        *[F.lit(None).alias(c) for c in ("category_id", "category_code", "brand")],
        F.col("value").alias("price"), "user_id", F.lit("session").alias("user_session"),
    )
    path = _written(ordered, f"{run_folder(spark)}/events.csv")
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(max(1024, versions.size(spark, path) // 64)))
    try:
        rows = cut_lineage(read_csv(spark, path, first=600))
    finally:
        spark.conf.set(setting, before)
    return rows.select(F.col("product_id").alias("event_id"), "event_type", "user_id", F.col("price").alias("value"))


def json_documents(spark, folder):
    """The dirty events as one document per line: missing and extra fields, numbers as texts, texts as numbers."""
    part, raw = F.col("product_id"), adapters.raw_behavior(spark, folder).select(*RAW.names)
    texts = F.struct(*[F.col(c).cast("string").alias(c) for c in RAW.names], F.struct(F.lit(1).alias("k")).alias("note"))
    numbers = F.struct(*[F.col(c).cast("bigint").alias(c) if c == "category_id" else F.col(c) for c in reversed(RAW.names)])
    lines = raw.select(F.when(part % 3 == 0, F.to_json(texts)).otherwise(F.to_json(numbers)).alias("value"))
    path = f"{run_folder(spark)}/events.json"
    lines.write.text(path)
    return read_json(spark, path)


def report_trend(spark, folder):
    """Reports of the hourly batches, appended to the log, read back, and compared with the hour before of their day."""
    store = EventStore(spark, run_folder(spark))
    report = quality.evaluate(adapters.raw_behavior(spark, folder), ["batch"], BATCHES)
    named = report.withColumn("source_file", F.concat(F.lit("day-"), F.floor(F.col("batch") / 24).cast("string")))
    persist_reports(store, named, F.col("batch"))
    return quality.report_changes(quality.parsed_details(store.log("quality_log"))).drop("checked_at")


def clean_gate(spark, folder):
    """Every hourly batch with what its load would end in, where cleaned rows must cost at least 2."""
    raw = adapters.raw_behavior(spark, folder)
    return judge_loads(raw, ["source_file", "batch"], BATCHES, replace(BATCHES, min_price=2.0))


def training_readiness(spark, folder):
    """Users by the month of their first order, and whether each month's users can be trained on."""
    users = features.user_features(_orders(spark, folder), ORDERS, for_churn=True)
    cohorts = users.withColumn("cohort", F.date_format("first_interaction", "yyyy-MM"))
    return readiness.training_readiness(cohorts, "cohort", ORDERS)


def snapshot_states(spark, folder):
    """Four days stored as a full copy and changes: the rebuilt state of each by event type, with its changes.

    A day holds the events up to it, without those more than two days old of every seventh user. The last day is
    first recorded wrongly, and then again.
    """
    events, root = cut_lineage(_behavior(spark, folder)), run_folder(spark)
    days = ("20240110", "20240111", "20240112", "20240113")

    def state(day):
        today = F.to_date(F.lit(day), "yyyyMMdd")
        old = (F.col("user_id") % 7 == 3) & (F.col("date") < F.date_sub(today, 2))
        return events.filter((F.col("date") <= today) & ~old)

    for day in days:
        if day == days[-1]:
            snapshots.record(events.filter("false"), root, day)
        snapshots.record(state(day), root, day, full=day == days[0])
    found = None
    for day in days:
        stored = snapshots.changes(spark, root, day)
        kept = snapshots.state(spark, root, day).groupBy("event_type").agg(
            F.count(F.lit(1)).alias("events"), F.countDistinct("user_id").alias("users"), F.sum("product_id").alias("products")
        )
        if stored is None:
            rows = kept.withColumns({"added": F.lit(0).cast("bigint"), "withdrawn": F.lit(0).cast("bigint")})
        else:
            moved = stored.groupBy("event_type").agg(
                F.sum(F.greatest("copies", F.lit(0))).alias("added"), F.sum(F.greatest(-F.col("copies"), F.lit(0))).alias("withdrawn")
            )
            rows = kept.join(moved, "event_type", "left").fillna(0, subset=["added", "withdrawn"])
        rows = rows.select(F.lit(day).alias("snapshot_date"), *[c for c in ("event_type", "events", "users", "products", "added", "withdrawn")])
        found = rows if found is None else found.unionByName(rows)
    return found


def health_document(spark, folder):
    """The health snapshot as two JSON documents, with the clock at the end of the month."""
    events, log = _behavior(spark, folder), _narrow_log(spark, folder)
    registry = _registry(spark, folder)
    counts = monitoring.table_counts({"events": events, "pipeline_metadata": log, "model_performance": registry, "absent": None})
    found = monitoring.alerts(events, registry, log, BEHAVIOR)
    clock = F.lit("2024-02-01 00:00:00").cast("timestamp")
    snapshot = monitoring.health_snapshot(counts, registry, found, BEHAVIOR, clock)
    return snapshot.select("checked_at", F.to_json("health").alias("health"), F.to_json("alerts").alias("alerts"))


def quality_history(spark, folder):
    """The latest reports of the hourly batches."""
    report = quality.evaluate(adapters.raw_behavior(spark, folder), ["batch"], BATCHES)
    rows = report.select(
        F.col("batch").alias("id"), "total_records", "completeness_score",
        F.col("session_valid_rate").alias("valid_sessions_rate"),
        F.when(F.col("passed_gate"), "PASSED").otherwise("FAILED").alias("status"),
    )
    return monitoring.run_history(rows)


def latency(spark, folder):
    """Run time per source and status, at a thousand rows a second."""
    log = _run_log(spark, folder).withColumn("execution_seconds", F.col("rows_read") / 1e3)
    return monitoring.latency_by_status(log)


def typed_dirty_columns(spark, folder):
    """Text prices with garbage, category ids written as decimals, tabs in brands, cleaned."""
    raw = adapters.raw_behavior(spark, folder)
    part = F.col("product_id")
    price = F.when(part % 6 == 1, F.lit("n/a")).otherwise(F.concat(F.col("price").cast("string"), F.lit(" ")))
    dirty = raw.withColumns(
        {
            "price": price,
            "category_id": F.when(part % 4 == 1, F.concat("category_id", F.lit(".0"))).otherwise(F.col("category_id")),
            "brand": F.concat(F.lit("\t"), "brand", F.lit("\t")),
        }
    )
    return cleaning.clean(dirty, BEHAVIOR).select(
        "event_time", "event_type", "product_id", "category_id", "brand", "price", "user_id", "user_session"
    )


def latest_status(spark, folder):
    return monitoring.latest_per_key(_run_log(spark, folder), "source_file", "id")


def alerts(spark, folder):
    return monitoring.alerts(_behavior(spark, folder), _no_models(spark), _run_log(spark, folder), BEHAVIOR)


def run_history(spark, folder):
    return monitoring.run_history(_run_log(spark, folder))


def quality_trend(spark, folder):
    return monitoring.quality_trend(_run_log(spark, folder))


def table_counts(spark, folder):
    raw, events = adapters.raw_behavior(spark, folder), _behavior(spark, folder)
    return monitoring.table_counts(
        {
            "raw_events": raw,
            "events": events,
            "pipeline_metadata": _run_log(spark, folder),
            "user_features": events.select("user_id").distinct(),
            "model_performance": None,
        }
    )


def dim_users(spark, folder):
    return marts.dim_users(_behavior(spark, folder))


def dim_products(spark, folder):
    return marts.dim_products(_behavior(spark, folder))


def dim_categories(spark, folder):
    return marts.dim_categories(_behavior(spark, folder))


def fact_events(spark, folder):
    return marts.fact_events(_behavior(spark, folder))


def dim_date(spark, folder):
    return marts.dim_date(_orders(spark, folder))


def dim_brand(spark, folder):
    return marts.dim_brand(_behavior(spark, folder), BEHAVIOR)


def fact_sales_daily(spark, folder):
    events = _behavior(spark, folder)
    return marts.fact_sales_daily(events, marts.dim_brand(events, BEHAVIOR))


def price_iqr(spark, folder):
    return marts.price_iqr(_orders(spark, folder))


def zero_sessions(spark, folder):
    return marts.zero_sessions(_behavior(spark, folder))


QUERIES = [
    clean_events, distinct_raw_rows, reject_reasons, quality_report, quality_by_type, quality_by_source,
    duplicate_rows, user_features, user_features_pre_cutoff, serving_features, churn_labels, churn_labels_daily,
    user_sample, favourite_category, top_spenders, distinct_users, first_purchaser, events_preview,
    category_top_products, user_recommendations, requested_profiles, not_found_users, risk_bands, risk_drivers,
    threshold_metrics, ranking_metrics, majority_baseline, stratified_split, segment_personas, user_segments,
    churn_scores, feature_importance, campaign_scores, high_risk_users, customer_360, decisions_for_sources,
    latest_status, alerts, run_history, quality_trend, table_counts, dim_users, dim_products, dim_categories,
    fact_events, dim_date, dim_brand, fact_sales_daily, price_iqr, zero_sessions, scaled_features,
    reject_reasons_narrow, latest_status_narrow, alerts_narrow, model_status, registry_summary, quality_history,
    latency, typed_dirty_columns, load_guard, segment_silhouette, source_replacement, csv_round_trip, bounded_load,
    churn_evaluation, segment_agreement, churn_agreement, json_documents, report_trend, clean_gate, training_readiness, snapshot_states, health_document,
]


def entry(spark: SparkSession) -> DataFrame:
    """Most bought products per category on the smallest scale factor."""
    return queries()["category_top_products"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def ready(query):
        return lambda spark, folder: _plain(query(configure(spark), folder))

    found = {query.__name__: ready(query) for query in QUERIES}
    if llm_queries:
        found |= {
            name: (lambda spark, folder, query=query: query(configure(spark), folder))
            for name, query in {**llm_queries.queries(), "pipeline": corpus_pipeline.run}.items()
        }
    return found


def oracle_sql() -> dict[str, str]:
    found = oracle.statements()
    if llm_oracle:
        found |= llm_oracle.statements() | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
    return found

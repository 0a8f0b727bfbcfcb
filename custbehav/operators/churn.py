"""Churn model: guard against leaky features, stratified split, random forest, exact metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from custbehav.config import CHURN_FEATURES, PipelineConfig
from custbehav.functions.columns import ratio
from custbehav.functions.ordering import running_totals, unit_bucket, values_at_ranks
from custbehav.operators.features import sample_key


@dataclass
class ChurnModel:
    pipeline: PipelineModel
    metrics: dict[str, float]
    importance: DataFrame


def check_churn_input(features: DataFrame) -> dict[int, int]:
    """Users per class; refuses features that see the label period, and too few users."""
    seen = features.groupBy("feature_mode", "churned").agg(F.count(F.lit(1)).alias("n")).collect()
    if any(row["feature_mode"] != "held_out" for row in seen):
        raise ValueError("the features see the label period: build them with for_churn=True")
    classes = {int(row["churned"]): row["n"] for row in seen}
    if sum(classes.values()) < 10 or len(classes) != 2 or min(classes.values()) < 2:
        raise ValueError("too few users to train on: at least 10 users and two of each class are needed")
    return classes


def stratified_split(features: DataFrame, share: float, seed: int) -> DataFrame:
    """Add ``is_test``: in every class the rounded share of users with the smallest hashes.

    The limit per class comes from totals per hash range, so a class is never gathered in one task; the
    flag itself is a comparison with the limits, one row per class.
    """
    keyed = features.select("churned", sample_key(F.col("user_id"), seed).alias("key"), F.lit(1).alias("rows"))
    last = values_at_ranks(
        keyed,
        ["churned"],
        "key",
        "rows",
        F.shiftright(F.col("key.hash"), 15),
        {"last_test": lambda n: F.floor(n.cast("double") * F.lit(share) + F.lit(0.5e0)) - 1},
        few_keys=True,
    ).drop("n")
    return (
        features.join(F.broadcast(last), "churned", "left")
        .withColumn("is_test", F.coalesce(sample_key(F.col("user_id"), seed) <= F.col("last_test"), F.lit(False)))
        .drop("last_test")
    )


def class_weight(counts: dict[int, int]) -> Column:
    """Weight that gives every class the same total."""
    total = sum(counts.values())
    weight = F.lit(1e0)
    for label, n in counts.items():
        weight = F.when(F.col("churned") == label, F.lit(total / (len(counts) * n))).otherwise(weight)
    return weight


def threshold_metrics(scored: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 and balanced accuracy of ``prediction`` against ``label``."""
    label, guess, one = F.col("label"), F.col("prediction"), F.lit(1)
    counts = scored.agg(
        F.count_if((label == 1) & (guess == 1)).alias("tp"),
        F.count_if((label == 0) & (guess == 1)).alias("fp"),
        F.count_if((label == 1) & (guess == 0)).alias("fn"),
        F.count_if((label == 0) & (guess == 0)).alias("tn"),
        F.count(one).alias("n"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    or_zero = lambda a, b: F.coalesce(ratio(a, b), F.lit(0e0))
    return counts.select(
        or_zero(tp + tn, F.col("n")).alias("accuracy"),
        or_zero(tp, tp + fp).alias("precision"),
        or_zero(tp, tp + fn).alias("recall"),
        or_zero(tp * 2, tp * 2 + fp + fn).alias("f1"),
        ((or_zero(tp, tp + fn) + or_zero(tn, tn + fp)) / F.lit(2e0)).alias("balanced_accuracy"),
    )


def ranking_metrics(scored: DataFrame) -> DataFrame:
    """Average precision (step sum, ties grouped) and ROC AUC of ``score`` in [0, 1], both exact.

    Rows are first reduced to distinct scores; the running counts are taken per score range, so there
    is no window over all scores.
    """
    by_score = scored.groupBy("score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )
    ranked = running_totals(by_score, [], "score", unit_bucket(F.col("score")), ["pos", "neg"], True, few_buckets=True)
    pos, neg = F.col("pos"), F.col("neg")
    hits = F.col("pos_before") + pos
    precision = ratio(hits, hits + F.col("neg_before") + neg)
    # Each negative counts the positives ranked above it, and half of those with its own score.
    above = neg.cast("double") * (F.col("pos_before").cast("double") + pos.cast("double") / F.lit(2e0))
    return ranked.agg(
        F.sum(pos.cast("double") * precision).alias("_ap"),
        F.sum(above).alias("_above"),
        F.sum(pos).alias("_pos"),
        F.sum(neg).alias("_neg"),
    ).select(
        F.try_divide(F.col("_ap"), F.col("_pos").cast("double")).alias("average_precision"),
        F.try_divide(F.col("_above"), F.col("_pos").cast("double") * F.col("_neg").cast("double")).alias("roc_auc"),
    )


def majority_baseline(split: DataFrame) -> DataFrame:
    """Metrics on the test rows of always guessing the training rows' commoner label (tie: the smaller)."""
    test, label = F.col("is_test"), F.col("label")
    counts = split.agg(
        F.count_if(~test & (label == 1)).alias("train_pos"),
        F.count_if(~test & (label == 0)).alias("train_neg"),
        F.count_if(test & (label == 1)).alias("pos"),
        F.count_if(test & (label == 0)).alias("neg"),
    )
    pos, neg = F.col("pos"), F.col("neg")
    guess = F.when(F.col("train_pos") > F.col("train_neg"), 1).otherwise(0)
    return counts.withColumn("baseline_label", guess).select(
        "baseline_label",
        F.when(F.col("baseline_label") == 1, ratio(pos, pos + neg)).otherwise(ratio(neg, pos + neg)).alias("baseline_accuracy"),
        F.when(F.col("baseline_label") == 1, F.coalesce(ratio(pos * 2, pos * 2 + neg), F.lit(0e0)))
        .otherwise(F.lit(0e0))
        .alias("baseline_f1"),
    )


def score_churn(users: DataFrame, pipeline: PipelineModel) -> DataFrame:
    """Add ``score``, the probability of churn, without moving any row."""
    scored = pipeline.transform(users.fillna(0, subset=list(CHURN_FEATURES)))
    return scored.select(*users.columns, vector_to_array("probability")[1].alias("score"))


def feature_importance(spark, pipeline: PipelineModel) -> DataFrame:
    """Importance per feature, most important first."""
    weights = pipeline.stages[-1].featureImportances.toArray()
    rows = [(name, float(weight)) for name, weight in zip(CHURN_FEATURES, weights)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def train_churn(features: DataFrame, cfg: PipelineConfig) -> ChurnModel:
    """Fit on 80 % of the users and measure on the rest. ``features`` should be a written table."""
    check_churn_input(features)
    split = stratified_split(features.fillna(0), cfg.test_share, cfg.seed).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit_and_measure(split, cfg)
    finally:
        split.unpersist()


def _fit_and_measure(split: DataFrame, cfg: PipelineConfig) -> ChurnModel:
    sizes = split.groupBy("is_test", "churned").agg(F.count(F.lit(1)).alias("n")).collect()
    training = {int(row["churned"]): row["n"] for row in sizes if not row["is_test"]}
    train, test = split.filter(~F.col("is_test")), split.filter("is_test")

    assembler = VectorAssembler(inputCols=list(CHURN_FEATURES), outputCol="vector")
    forest = RandomForestClassifier(
        featuresCol="vector", labelCol="churned", weightCol="weight", numTrees=cfg.n_trees,
        maxDepth=cfg.tree_depth, seed=cfg.seed,
    )
    weighted = train.withColumn("weight", class_weight(training))
    pipeline = PipelineModel([assembler, forest.fit(assembler.transform(weighted))])

    scored = score_churn(test, pipeline).select(
        F.col("churned").alias("label"), "score", (F.col("score") >= 0.5).cast("int").alias("prediction")
    )
    labelled = split.select("is_test", F.col("churned").alias("label"))
    metrics = {}
    for report in (threshold_metrics(scored), ranking_metrics(scored), majority_baseline(labelled).drop("baseline_label")):
        metrics.update({name: round(value, 4) for name, value in report.first().asDict().items()})
    metrics["training_samples"] = float(sum(training.values()))
    metrics["test_samples"] = float(sum(row["n"] for row in sizes if row["is_test"]))
    return ChurnModel(pipeline, metrics, feature_importance(split.sparkSession, pipeline))

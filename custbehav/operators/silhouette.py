"""Silhouettes from real pairwise distances, by blocks of points.

The points are dealt into blocks by a hash of their id; every pair of blocks is one row of a join, and a task adds up,
per point of the first block and cluster of the second, the distances and their squares. What leaves it is one row
per point, block and cluster, which the aggregation sums. The work grows with the square of the points, so a sample bounds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from custbehav.config import PipelineConfig
from custbehav.operators.features import sampled
from custbehav.session import cut_lineage

SAMPLE, BLOCK = 5_000, 1_024


def _distances(points: DataFrame, blocks: int) -> DataFrame:
    """Per point and cluster: the number of points there, and the sums of distances and of squared ones.

    The task reads nothing of this package, so the workers need not have it installed.
    """
    block = F.pmod(F.xxhash64("user_id"), F.lit(blocks))
    packed = points.withColumn("block", block).groupBy("block").agg(F.collect_list(F.struct("user_id", "cluster", "vector")).alias("rows"))
    rows = packed.select(
        "block", F.col("rows.user_id").alias("ids"), F.col("rows.cluster").alias("clusters"), F.col("rows.vector").alias("vectors")
    )
    rows = cut_lineage(rows)
    first = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("other"))
    second = rows.select(F.col("block").alias("other"), F.col("clusters").alias("their_clusters"), F.col("vectors").alias("their_vectors"))
    met = first.join(second, "other").select("ids", "clusters", "vectors", "their_clusters", "their_vectors")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, own, mine, clusters, theirs in zip(*(column.to_pylist() for column in batch.columns)):
                a, b = np.array(mine, np.float64), np.array(theirs, np.float64)
                squares = np.zeros((len(a), len(b)))
                for i in range(a.shape[1]):  # by differences, so that a point is at distance zero from itself
                    squares += (a[:, i, None] - b[None, :, i]) ** 2
                names, place = np.unique(np.array(clusters, np.int64), return_inverse=True)
                member = (place[:, None] == np.arange(len(names))[None, :]).astype(np.float64)
                linear, squared, sizes = np.sqrt(squares) @ member, squares @ member, member.sum(axis=0).astype(np.int64)
                n = len(names)
                columns = [
                    pa.array(np.repeat(np.array(ids, np.int64), n)), pa.array(np.repeat(np.array(own, np.int64), n)),
                    pa.array(np.tile(names, len(a))), pa.array(np.tile(sizes, len(a))),
                    pa.array(linear.ravel()), pa.array(squared.ravel()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["user_id", "cluster", "other", "n", "linear", "squared"])

    found = met.mapInArrow(task, "user_id long, cluster long, other long, n long, linear double, squared double")
    return found.groupBy("user_id", "cluster", "other").agg(F.sum("n").alias("n"), F.sum("linear").alias("linear"), F.sum("squared").alias("squared"))


def _silhouette(own: Column, nearest: Column) -> Column:
    """Zero for the only point of a cluster, without a second cluster, and where all distances are zero."""
    largest = F.greatest(own, nearest)
    return F.when(largest > 0, (nearest - own) / largest).otherwise(0e0)


def silhouettes(points: DataFrame, cfg: PipelineConfig, sample: int | None = SAMPLE) -> DataFrame:
    """Per point (``user_id``, ``cluster``, ``vector``) the silhouettes with plain and with squared distances.

    At most ``sample`` users, chosen by the seeded hash of their ids, or all with None. Ids must be distinct.
    """
    known = points.select("user_id", F.col("cluster").cast("long").alias("cluster"), "vector")
    chosen = known if sample is None else sampled(known, known, sample, cfg.seed)
    blocks = -(-(sample if sample is not None else max(1, known.count())) // BLOCK)
    sums = _distances(chosen, blocks)
    same = F.col("other") == F.col("cluster")
    measures = {"silhouette_euclidean": "linear", "silhouette_squared": "squared"}
    per_point = sums.groupBy("user_id", "cluster").agg(
        *[F.max(F.when(same & (F.col("n") > 1), F.col(m) / (F.col("n") - 1))).alias(f"_{m}_own") for m in measures.values()],
        *[F.min(F.when(~same, F.col(m) / F.col("n"))).alias(f"_{m}_nearest") for m in measures.values()],
    )
    return per_point.select(
        "user_id", "cluster",
        *[
            F.coalesce(_silhouette(F.col(f"_{m}_own"), F.col(f"_{m}_nearest")), F.lit(0e0)).alias(name)
            for name, m in measures.items()
        ],
    )


def silhouette_by_cluster(scored: DataFrame) -> DataFrame:
    """Mean silhouettes per cluster, and of all points in the row without a cluster."""
    mean = [F.avg(name).alias(name) for name in ("silhouette_euclidean", "silhouette_squared")]
    return scored.rollup("cluster").agg(F.count(F.lit(1)).alias("users"), *mean)


def mean_silhouettes(points: DataFrame, cfg: PipelineConfig, sample: int | None = SAMPLE) -> dict[str, float]:
    """Both figures over the sample; 0 without points."""
    names = ("silhouette_euclidean", "silhouette_squared")
    row = silhouettes(points, cfg, sample).agg(*[F.coalesce(F.avg(n), F.lit(0e0)).alias(n) for n in names]).first()
    return {name: row[name] for name in names}

"""Session settings the operators rely on, and the one way they cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Timestamps are UTC throughout; ANSI makes a malformed cast fail instead of turning into null. The
# query context would record a Python stack for every column expression, which takes longer than
# planning a report; errors name the expression without it.
REQUIRED = {
    "spark.sql.dataFrameQueryContext.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above. Parallelism and memory stay what the cluster chose."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a folder of the warehouse for local sessions without one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        context.setCheckpointDir(folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    return context.getCheckpointDir()


def run_folder(spark: SparkSession) -> str:
    """A new folder that all executors share, for files of one run."""
    return f"{checkpoint_folder(spark)}/run-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so that a lost executor does not replay everything before it."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()

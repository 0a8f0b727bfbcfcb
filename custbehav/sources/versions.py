"""Replacing stored results in one step.

Below the path of a result lie ``version=<n>/`` folders and ``_commits``, a small append-only table. A version
is written to a folder of its own and becomes current with its commit row, which is appended last and appears as
a whole or not at all. If the job fails, on whatever machine, the version before it stays current and
readable; readers that began earlier keep their files until ``drop_superseded``.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F

_COMMIT = "version long, format string"


def new_id() -> int:
    """Identifier that grows with time (microseconds)."""
    return time.time_ns() // 1000


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    system, hadoop_path = _hadoop(spark, path)
    return system.exists(hadoop_path)


def remove(spark: SparkSession, path: str) -> None:
    system, hadoop_path = _hadoop(spark, path)
    system.delete(hadoop_path, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    system, hadoop_path = _hadoop(spark, path)
    return [status.getPath().getName() for status in system.listStatus(hadoop_path) if status.isDirectory()]


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path, 0 if there is none; answered by the file system."""
    system, hadoop_path = _hadoop(spark, path)
    return system.getContentSummary(hadoop_path).getLength() if system.exists(hadoop_path) else 0


def _latest(spark: SparkSession, path: str) -> tuple[int, str] | None:
    if not exists(spark, f"{path}/_commits"):
        return None
    commits = spark.read.schema(_COMMIT).parquet(f"{path}/_commits")
    row = commits.agg(F.max("version").alias("version"), F.max_by("format", "version").alias("format")).first()
    return None if row["version"] is None else (row["version"], row["format"])


def current_path(spark: SparkSession, path: str) -> str | None:
    """Folder of the current version."""
    latest = _latest(spark, path)
    return None if latest is None else f"{path}/version={latest[0]}"


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The current version, None while there is none."""
    latest = _latest(spark, path)
    return None if latest is None else spark.read.format(latest[1]).load(f"{path}/version={latest[0]}")


def publish(rows: DataFrame, path: str, kind: str = "parquet", **options: str) -> str:
    """Write ``rows``, which may read the current version, as the new one; returns its folder."""
    spark, version = rows.sparkSession, new_id()
    target = f"{path}/version={version}"
    try:
        rows.write.options(**options).format(kind).save(target)
    except Exception:
        remove(spark, target)
        raise
    commit = spark.createDataFrame([(version, kind)], _COMMIT)
    commit.coalesce(1).write.mode("append").parquet(f"{path}/_commits")
    return target


def drop_superseded(spark: SparkSession, path: str) -> int:
    """Delete the versions older than the current one, which no new reader sees."""
    latest = _latest(spark, path)
    if latest is None:
        return 0
    old = [f for f in folders(spark, path) if f.startswith("version=") and int(f.removeprefix("version=")) < latest[0]]
    for folder in old:
        remove(spark, f"{path}/{folder}")
    return len(old)

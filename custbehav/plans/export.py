"""Parquet exports of queries and tables, each replaced in one step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import NullType

from custbehav.sources import versions


def export_query(spark: SparkSession, query: str, path: str) -> str:
    """Result of a SELECT as snappy Parquet."""
    return export(spark.sql(query), path)


def export(df: DataFrame, path: str) -> str:
    """Write a new version of the export at ``path`` and return its folder.

    The version before it stays current until all is written, so a failed export changes nothing, and ``df``
    may read what it replaces.
    """
    if not df.columns:
        raise ValueError("nothing to export: the query has no columns")
    typed = df.select(
        *[
            F.col(f"`{field.name}`").cast("string").alias(field.name) if isinstance(field.dataType, NullType) else F.col(f"`{field.name}`")
            for field in df.schema.fields
        ]
    )
    return versions.publish(typed, path, compression="snappy")


def read_export(spark: SparkSession, path: str) -> DataFrame | None:
    """The current version of an export."""
    return versions.read(spark, path)


def snapshot_path(root: str, day: str) -> str:
    return f"{root}/events_snapshot/snapshot_date={day}"


def export_snapshot(events: DataFrame, root: str, day: str) -> str:
    """All events as the snapshot of one day (yyyymmdd)."""
    return export(events, snapshot_path(root, day))

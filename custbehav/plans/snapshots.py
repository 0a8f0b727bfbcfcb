"""Snapshots that store only what changed since the day before.

Below the root lie ``full/day=<yyyymmdd>`` and ``changes/day=<yyyymmdd>``, each a versioned result. A change is a row
with the number of copies it gained (or, below zero, lost) since the last recorded day. The state of a day is the
last full copy up to it and the changes after that, added up per row. Days are recorded in order; the last one can be
recorded again, which replaces it in one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from custbehav.sources import versions

KINDS = ("full", "changes")


def recorded_days(spark: SparkSession, root: str) -> dict[str, str]:
    """Days that can be read, with the kind of what is stored for them."""
    found = {}
    for kind in reversed(KINDS):  # a full copy goes before the changes of the same day
        if versions.exists(spark, f"{root}/{kind}"):
            for folder in versions.folders(spark, f"{root}/{kind}"):
                day = folder.removeprefix("day=")
                if versions.current_path(spark, f"{root}/{kind}/day={day}"):
                    found[day] = kind
    return dict(sorted(found.items()))


def _added_up(changes: DataFrame) -> DataFrame:
    columns = [c for c in changes.columns if c != "copies"]
    return changes.groupBy(*columns).agg(F.sum("copies").alias("copies")).filter("copies <> 0")


def state_with_copies(spark: SparkSession, root: str, day: str) -> DataFrame | None:
    """Distinct rows of the last recorded state up to ``day`` with their copies; None before the first."""
    days = {d: kind for d, kind in recorded_days(spark, root).items() if d <= day}
    if not days:
        return None
    start = max((d for d, kind in days.items() if kind == "full"), default=min(days))
    parts = [versions.read(spark, f"{root}/{kind}/day={d}") for d, kind in days.items() if d >= start]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return _added_up(rows)


def state(spark: SparkSession, root: str, day: str) -> DataFrame | None:
    """All rows of the state of ``day``, copies included."""
    rows = state_with_copies(spark, root, day)
    if rows is None:
        return None
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return rows.withColumn("_copy", copies).drop("_copy", "copies")


def record(rows: DataFrame, root: str, day: str, full: bool = False) -> str:
    """Store the state ``rows`` of ``day``: what changed since the day before, or all of it; returns the folder.

    Without an earlier day everything is a change. Columns must stay the same from day to day.
    """
    spark = rows.sparkSession
    if "copies" in rows.columns:
        raise ValueError("a snapshot counts copies itself")
    days = recorded_days(spark, root)
    if days and day < max(days):
        raise ValueError(f"{max(days)} is recorded already, an earlier day would change what follows")
    now = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    if full:
        return versions.publish(now, f"{root}/full/day={day}")
    if days.get(day) == "full":
        raise ValueError(f"{day} is recorded as a full copy")
    earlier = [d for d in days if d < day]
    before = state_with_copies(spark, root, max(earlier)) if earlier else None
    if before is not None:
        if before.drop("copies").dtypes != rows.dtypes:
            raise ValueError("the columns differ from those of the day before")
        now = _added_up(now.unionByName(before.withColumn("copies", -F.col("copies"))))
    return versions.publish(now, f"{root}/changes/day={day}")


def changes(spark: SparkSession, root: str, day: str) -> DataFrame | None:
    """Rows added (``copies`` above zero) and withdrawn (below) on a day that is stored as changes."""
    return versions.read(spark, f"{root}/changes/day={day}")

"""The event store: versioned loads per source, and the append-only log tables beside it.

Layout below one root folder that all executors share::

    events/source_file=<name>/load_id=<n>/   cleaned events of one load
    manifest/                                one row per committed load; appending it is the commit
    run_log/, quality_log/, registry/        append-only logs
    recommendations/, user_features/, ...    derived tables, each with its versions

A reader sees, per source, only the load with the greatest committed ``load_id``. A load that failed
before its manifest row, on any executor or on the driver, is never read.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from custbehav.schema import EVENTS, MANIFEST, QUALITY_LOG, REGISTRY, RUN_LOG
from custbehav.sources import versions

LOGS = {"manifest": MANIFEST, "run_log": RUN_LOG, "quality_log": QUALITY_LOG, "registry": REGISTRY}


class EventStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def load_path(self, source: str, load_id: int) -> str:
        return self.path("events", f"source_file={quote(source, safe='')}", f"load_id={load_id}")

    def exists(self, path: str) -> bool:
        return versions.exists(self.spark, path)

    def remove(self, path: str) -> None:
        versions.remove(self.spark, path)

    # Logs

    def log(self, name: str) -> DataFrame:
        """A log table; empty while nothing was appended."""
        if not self.exists(self.path(name)):
            return self.spark.createDataFrame([], LOGS[name])
        return self.spark.read.schema(LOGS[name]).option("recursiveFileLookup", True).parquet(self.path(name))

    def append(self, name: str, rows: DataFrame) -> None:
        """Append a few rows as one file, which appears as a whole or not at all.

        Every append has a folder of its own, so that jobs that append at the same time do not clear each
        other's unfinished files.
        """
        schema: StructType = LOGS[name]
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        typed.coalesce(1).write.parquet(self.path(name, f"append-{versions.new_id()}-{uuid.uuid4().hex}"))

    def append_row(self, name: str, **values) -> None:
        schema: StructType = LOGS[name]
        row = tuple(values.get(field.name) for field in schema.fields)
        self.append(name, self.spark.createDataFrame([row], schema))

    # Events

    def current_loads(self) -> DataFrame:
        """Manifest row of the current load of every source."""
        manifest = self.log("manifest")
        newest = F.max_by(F.struct(*MANIFEST.names), "load_id").alias("_row")
        return manifest.groupBy("source_file").agg(newest).select("_row.*")

    def has_events(self) -> bool:
        return self.exists(self.path("events"))

    def events(self) -> DataFrame:
        """Events of all current loads. Their folders are named by the manifest, one row per source."""
        schema = StructType([*EVENTS.fields, StructField("load_id", LongType())])
        paths = [self.load_path(row["source_file"], row["load_id"]) for row in self.current_loads().collect()]
        if not paths:
            return self.spark.createDataFrame([], EVENTS)
        loads = self.spark.read.schema(schema).option("basePath", self.path("events")).parquet(*paths)
        return loads.select(*EVENTS.names)

    def load_states(self) -> DataFrame:
        """Every load folder with its rows and state: CURRENT, SUPERSEDED or ORPHAN (never committed).

        It reads what lies in the folders, whether or not a reader sees it.
        """
        if not self.has_events():
            return self.spark.createDataFrame([], "source_file string, load_id long, rows long, state string")
        schema = StructType([*EVENTS.fields, StructField("load_id", LongType())])
        folders = self.spark.read.schema(schema).parquet(self.path("events")).groupBy("source_file", "load_id")
        loads = folders.agg(F.count(F.lit(1)).alias("rows"))
        committed = self.log("manifest").select("source_file", "load_id", F.lit(True).alias("_committed"))
        current = self.current_loads().select("source_file", F.col("load_id").alias("_current"))
        state = F.when(F.col("_committed").isNull(), "ORPHAN").when(F.col("load_id") == F.col("_current"), "CURRENT")
        joined = loads.join(committed, ["source_file", "load_id"], "left").join(current, "source_file", "left")
        return joined.select("source_file", "load_id", "rows", state.otherwise("SUPERSEDED").alias("state"))

    def drop_superseded_loads(self) -> int:
        """Delete loads older than their source's current one, which no new reader sees."""
        dropped = 0
        for row in self.current_loads().collect():
            folder = self.load_path(row["source_file"], row["load_id"]).rsplit("/", 1)[0]
            for name in versions.folders(self.spark, folder):
                if int(name.removeprefix("load_id=")) < row["load_id"]:
                    self.remove(f"{folder}/{name}")
                    dropped += 1
        return dropped

    # Derived tables

    def table(self, name: str) -> DataFrame | None:
        return versions.read(self.spark, self.path(name))

    def replace_table(self, name: str, rows: DataFrame) -> DataFrame:
        """Write a derived table anew and return it as read back, with its size known to the optimizer.

        The old rows stay current until all new ones are written.
        """
        return self.spark.read.parquet(versions.publish(rows, self.path(name)))

    def drop_superseded_tables(self, *names: str) -> int:
        """Delete the versions of derived tables that no new reader sees."""
        return sum(versions.drop_superseded(self.spark, self.path(name)) for name in names)

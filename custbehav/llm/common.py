"""What the operators share: reading, lineage, and the tokens the contracts define."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from custbehav.session import checkpoint_folder, cut_lineage as checkpointed

__all__ = ["checkpointed", "columns", "read", "set_aside", "ship", "stored", "trim_space", "words", "SPACE", "SPACES"]

# The white space of all contracts: space and the five control characters from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Write the rows as a compressed table into the shared checkpoint folder and read them back.

    Like a checkpoint it ends the lineage; it is used for what is read several times or is large.
    """
    path = f"{checkpoint_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def columns(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the wanted columns under the given names, whatever else the table holds.

    A name is matched exactly first, so extra columns that differ in case only do no harm.
    """
    have = df.columns
    exact = df.toDF(*[f"c{i}" for i in range(len(have))])

    def position(name: str) -> int:
        if name in have:
            return have.index(name)
        return [c.lower() for c in have].index(name.lower())

    return exact.select(*[F.col(f"c{position(source)}").alias(name) for name, source in wanted.items()])


def set_aside(df: DataFrame, *needed: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The table with the needed columns under these names and all others under neutral ones, and the way back.

    So a stage can add columns of its own, whatever else the table holds. The way back takes a table that still has all
    these columns and gives it the columns of ``df``, in their order. A name is matched exactly first.
    """
    have = df.columns
    own = {}
    for name in needed:
        place = have.index(name) if name in have else next((i for i, c in enumerate(have) if c.lower() == name.lower()), None)
        if place is not None:
            own[place] = name
    inner = [own.get(i, f"aside_{i}") for i in range(len(have))]
    return df.toDF(*inner), lambda rows: rows.select(*inner).toDF(*have)


def trim_space(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def words(text: Column) -> Column:
    """The words of a text; none for a null or blank one."""
    trimmed = trim_space(F.coalesce(text, F.lit("")))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def ship(spark: SparkSession) -> SparkSession:
    """Give the Python workers this package, once per session; for clusters on which it is not installed."""
    context = spark.sparkContext
    if not getattr(context, "_custbehav_shipped", False):
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp()) / "custbehav.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        context._custbehav_shipped = True
    return spark

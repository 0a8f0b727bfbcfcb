"""Raw event files: typed CSV and JSON scans, existence check, fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from custbehav.config import PipelineConfig
from custbehav.schema import RAW
from custbehav.session import cut_lineage

# The texts the input's CSV dialect reads as missing.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _typed(texts: DataFrame, keep_tokens: bool) -> DataFrame:
    """Text columns to RAW types. A text that is no number makes the job fail (ANSI cast)."""

    def column(field: StructField) -> Column:
        text = F.col(field.name)
        missing = text.isin("") if keep_tokens else text.isin(*NULL_TOKENS)
        return F.when(~missing, text).cast(field.dataType).alias(field.name)

    return texts.select(*[column(field) for field in RAW.fields])


def _located(scan: DataFrame) -> DataFrame:
    """The rows of a file scan with file, split and place; places grow inside a split only."""
    return scan.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )


def first_rows(scan: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of a file scan in the order of the files."""
    return _first_located(_located(scan), n).select(*scan.columns)


def _first_located(located: DataFrame, n: int) -> DataFrame:
    """Every split of a file counts its rows; a running total over the splits, one row each, says how many of
    each split are wanted, and its rows are numbered in place. No task gets more than its own split.
    """
    splits = located.groupBy("_file", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    wanted = splits.withColumn("_left", F.lit(n) - F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).filter("_left > 0")
    numbered = located.join(wanted.drop("_rows"), ["_file", "_block"])
    return numbered.filter(F.col("_at") - F.col("_first") < F.col("_left"))


_RECORD = "_file string, _block long, _at long, header boolean, begins boolean, ends boolean, text string"


def _odd(line: Column) -> Column:
    """1 if the line holds an odd number of quotes: it opens a quoted field or closes one."""
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2


def quoted_records(lines: DataFrame) -> DataFrame:
    """Records of CSV text whose quoted fields hold line breaks, from the located ``lines`` (``value``) of the files.

    A split is inside quotes where the lines of its file before it hold an odd number of quotes; that number comes
    from one row per split. So every split joins its own lines, and only a record that crosses the end of a split is
    put together afterwards, from one piece per split. Columns: file, split, place, whether it is its file's first
    record, and its text. A quote that is never closed fails the source.
    """
    splits = lines.groupBy("_file", "_block").agg(F.min("_at").alias("_first"), F.sum(_odd(F.col("value"))).alias("_odd"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.withColumn("_inside", F.coalesce(F.sum("_odd").over(earlier), F.lit(0)) % 2 == 1).drop("_odd")
    ordered = lines.select("_file", "_block", "_at", "value").join(starts, ["_file", "_block"])
    ordered = ordered.sortWithinPartitions("_file", "_block", "_at")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_file", "_block", "_at", "header", "begins", "ends", "text"]
        types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string()]
        split, held, place, begins, inside, out = None, [], 0, True, False, []

        def close(ends: bool) -> None:
            file, block, first = split
            out.append((file, block, place, block == 0 and place == first, begins, ends, "\n".join(held)))

        def ready() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("_file", "_block", "_first", "_at", "value", "_inside")))
            for file, block, first, at, line, start_inside in rows:
                if (file, block, first) != split:
                    if held:
                        close(ends=False)
                    split, held, inside = (file, block, first), [], start_inside
                    begins, place = not start_inside, at
                if not held:
                    place = at
                held.append(line)
                inside ^= line.count('"') % 2 == 1
                if not inside:
                    close(ends=True)
                    held, begins = [], True
            if out:
                yield ready()
                out.clear()
        if held:
            close(ends=False)
            yield ready()

    found = ordered.mapInArrow(task, _RECORD)
    whole = found.filter("begins and ends").drop("begins", "ends")
    number = F.sum(F.col("begins").cast("int")).over(Window.partitionBy("_file").orderBy("_block", "_at"))
    pieces = found.filter("not (begins and ends)").withColumn("_record", number)
    piece = F.struct("_block", "_at", "header", "begins", "ends", "text")
    joined = pieces.groupBy("_file", "_record").agg(F.sort_array(F.collect_list(piece)).alias("p"))
    unclosed = F.raise_error(F.concat(F.lit("A quoted field is never closed in "), F.col("_file"))).cast("string")
    text = F.when(F.get("p", F.size("p") - 1)["ends"], F.array_join("p.text", "\n")).otherwise(unclosed)
    first = F.get("p", F.lit(0))
    crossing = joined.select("_file", first["_block"].alias("_block"), first["_at"].alias("_at"), first["header"].alias("header"), text.alias("text"))
    return whole.unionByName(crossing)


def _quoted_fields(lines: DataFrame, schema: StructType, first: int | None) -> DataFrame:
    """The text columns of assembled records, without headers and blank lines."""
    records = quoted_records(lines).filter(~F.col("header") & (F.trim("text") != ""))
    if first is not None:
        records = cut_lineage(records.sortWithinPartitions("_file", "_block", "_at"))
        # Places number the lines; the records of a split are numbered anew.
        inside = Window.partitionBy("_file", "_block").orderBy("_at")
        records = _first_located(records.withColumn("_at", F.row_number().over(inside)), first)
    names = ", ".join(f"`{name}` string" for name in schema.names)
    fields = F.from_csv(F.regexp_replace("text", "\r$", ""), names, {"escape": '"'})
    return records.select(fields.alias("r")).select("r.*")


def read_csv(spark: SparkSession, path: str, keep_tokens: bool = False, first: int | None = None) -> DataFrame:
    """One source as RAW rows, columns matched by header name.

    A row with too few fields has nulls at its end; one with too many, or with a malformed number, or a quote that
    is never closed, fails the source. A quoted field may hold line breaks: one pass over the lines finds out whether
    any does, and only then records are assembled; other files are scanned as they are. ``keep_tokens`` treats only empty fields as missing, ``first`` reads that many rows.
    """
    header = spark.read.option("header", True).option("escape", '"').csv(path).columns
    absent = [name for name in RAW.names if name not in header]
    if absent:
        raise ValueError(f"{path} lacks the columns {absent}")
    surplus = "_surplus"
    schema = StructType([StructField(name, StringType()) for name in [*header, surplus]])
    lines = _located(spark.read.option("lineSep", "\n").text(path))
    if lines.filter(_odd(F.col("value")) == 1).isEmpty():
        texts = spark.read.schema(schema).option("header", True).option("escape", '"').option("mode", "PERMISSIVE").csv(path)
        if first is not None:
            texts = first_rows(texts, first)
    else:
        texts = _quoted_fields(lines, schema, first)
    # Catalyst keeps a filter with raise_error: it is evaluated for every row, before the projection.
    width_ok = F.when(F.col(surplus).isNull(), F.lit(True)).otherwise(
        F.raise_error(F.lit(f"A row of {path} has more fields than its header")).cast("boolean")
    )
    return _typed(texts.filter(width_ok), keep_tokens)


def read_json(spark: SparkSession, path: str, keep_tokens: bool = False) -> DataFrame:
    """The same nine fields as one JSON document per line."""
    texts = spark.read.schema(StructType([StructField(name, StringType()) for name in RAW.names])).option(
        "mode", "FAILFAST"
    ).json(path)
    return _typed(texts, keep_tokens)


def source_listing(spark: SparkSession, folder: str, names: tuple[str, ...], cfg: PipelineConfig) -> DataFrame:
    """One row per source with its fingerprint: size, modification time and ETL version.

    Only file metadata is read. All sources must exist; the missing ones are named in the error.
    """
    listing, missing = None, []
    for name in names:
        try:
            files = spark.read.format("binaryFile").load(f"{folder}/{name}")
        except AnalysisException:
            missing.append(name)
            continue
        one = files.agg(
            F.sum("length").alias("size"), F.max("modificationTime").alias("modified")
        ).withColumn("source_file", F.lit(name))
        listing = one if listing is None else listing.unionByName(one)
    if missing:
        raise FileNotFoundError(f"{folder} lacks the sources {missing}")
    if listing is None:
        raise ValueError("No source is listed")
    return listing.select(
        "source_file", fingerprint(F.col("size"), F.col("modified"), cfg).alias("fingerprint")
    )


def fingerprint(size: Column, modified: Column, cfg: PipelineConfig) -> Column:
    return F.concat_ws(
        "|", size.cast("string"), F.unix_micros(modified.cast("timestamp")).cast("string"), F.lit(cfg.etl_version)
    )

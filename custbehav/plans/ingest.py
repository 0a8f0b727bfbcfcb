"""Loading sources: skip unchanged ones, gate, clean, and replace a source's events in one step."""

from __future__ import annotations

import time
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F

from custbehav.config import PipelineConfig
from custbehav.functions.ordering import join_null_safe
from custbehav.operators import cleaning, quality
from custbehav.schema import RAW
from custbehav.sources.raw_files import read_csv, source_listing
from custbehav.sources.store import EventStore
from custbehav.sources.versions import new_id

# Reasons for which a load is not committed.
EMPTY_LOAD = "no valid event, the last load stays current"
MISSED_GATE = "the cleaned rows miss the quality gate"


def source_decisions(listing: DataFrame, current: DataFrame, row_limit: int | None) -> DataFrame:
    """LOAD, SKIP or REFUSE per listed source.

    An unchanged source is skipped when it was loaded in full or with the same limit, refused when the
    new sample would be smaller than the loaded one, and loaded again when more rows are asked for. A
    changed or new source is always loaded.
    """
    if row_limit is not None and row_limit <= 0:
        raise ValueError("a sample needs at least one row")
    limit = F.lit(row_limit).cast("bigint")
    known = current.select(
        "source_file", F.col("fingerprint").alias("_loaded"), F.col("row_limit").alias("_limit"), "rows_loaded"
    )
    unchanged = F.col("_loaded").eqNullSafe(F.col("fingerprint"))
    decision = (
        F.when(~unchanged, "LOAD")
        .when(F.col("_limit").isNull() | F.col("_limit").eqNullSafe(limit), "SKIP")
        .when(F.coalesce(limit < F.col("_limit"), F.lit(False)), "REFUSE")
        .otherwise("LOAD")
    )
    return listing.join(known, "source_file", "left").select(
        "source_file", "fingerprint", decision.alias("decision"), "rows_loaded"
    )


def ingest(
    store: EventStore,
    folder: str,
    cfg: PipelineConfig,
    sources: tuple[str, ...] | None = None,
    max_chunks: int | None = None,
    run_quality_gate: bool = True,
) -> list[dict]:
    """Load the listed CSV sources one after the other; nothing is touched if one is missing."""
    if max_chunks is not None and max_chunks <= 0:
        raise ValueError("a sample needs at least one chunk")
    names = cfg.source_files if sources is None else sources
    row_limit = None if max_chunks is None else max_chunks * cfg.rows_per_chunk
    listing = source_listing(store.spark, folder, names, cfg)
    decided = {row["source_file"]: row for row in source_decisions(listing, store.current_loads(), row_limit).collect()}
    results = []
    for name in names:
        decision = decided[name]["decision"]
        if decision == "SKIP":
            results.append({"file": name, "status": "SKIPPED", "rows_inserted": 0})
        elif decision == "REFUSE":
            raise ValueError(f"{name} is loaded with more rows than this sample has; load the sample into another store")
        else:
            results.append(
                ingest_source(store, folder, name, decided[name]["fingerprint"], cfg, row_limit, run_quality_gate)
            )
    return results


def ingest_source(
    store: EventStore, folder: str, name: str, fingerprint: str, cfg: PipelineConfig, row_limit: int | None = None,
    run_quality_gate: bool = True,
) -> dict:
    """Stage, check, clean and commit one source, and log the attempt."""
    started, load_id = time.monotonic(), new_id()
    counts = {"rows_read": 0, "rows_inserted": 0, "duplicates_removed": 0, "rows_rejected": 0}
    staged = store.path("_staging", f"load_id={load_id}")

    def log_run(status: str, error: str | None = None) -> None:
        store.append_row(
            "run_log", id=new_id(), pipeline_name="ETL_Ingestion", source_file=name, table_name="events", **counts,
            execution_seconds=time.monotonic() - started, status=status, error_message=error, created_at=_now(),
        )

    try:
        rows = _stage(store, staged, read_csv(store.spark, f"{folder}/{name}", first=row_limit), name)
        reasons = {r["reason"]: r["rows"] for r in cleaning.reject_counts(rows, cfg, "copies").collect()}
        valid = reasons.get("valid", 0)
        counts["rows_read"] = sum(reasons.values())
        counts["rows_rejected"] = counts["rows_read"] - valid
        report = None
        if run_quality_gate:
            # The report is a handful of numbers; it is fixed here because the staged rows go away.
            evaluated = quality.evaluate(rows, ["source_file"], cfg, copies="copies")
            report = store.spark.createDataFrame(evaluated.collect(), evaluated.schema)

        target = store.load_path(name, load_id)
        cleaning.clean(rows.drop("copies"), cfg).drop("source_file").write.parquet(target)
        loaded = store.spark.read.parquet(target)
        inserted = loaded.count()
        counts["duplicates_removed"] = valid - inserted
        if inserted == 0:
            raise ValueError(f"{name} holds no valid event, its last load stays current")
        _check_cleaned(loaded.withColumn("source_file", F.lit(name)), cfg)
        unchanged = source_listing(store.spark, folder, (name,), cfg).first()["fingerprint"] == fingerprint
        if not unchanged:
            raise RuntimeError(f"{name} was written to while it was being loaded")
        store.append_row(
            "manifest", source_file=name, load_id=load_id, fingerprint=fingerprint, row_limit=row_limit,
            rows_loaded=inserted, updated_at=_now(),
        )
        counts["rows_inserted"] = inserted
    except Exception as error:
        log_run("FAILED", str(error))
        raise
    finally:
        store.remove(staged)

    warned = report is not None and not report.first()["passed_gate"]
    if report is not None:
        persist_reports(store, report)
    status = "QUALITY_WARNING" if warned else "SUCCESS"
    log_run(status)
    return {"file": name, **counts, "duration_seconds": round(time.monotonic() - started, 2), "status": status}


def judge_loads(raw: DataFrame, keys: list[str], cfg: PipelineConfig, gate_cfg: PipelineConfig | None = None) -> DataFrame:
    """What loading every group of raw rows would end in, all groups in one job.

    ``status`` is that of the load log, ``refusal`` why nothing would be committed: no valid row, or cleaned rows that
    miss the gate (of ``gate_cfg``, where it is stricter than the cleaning). Null where the group would be loaded.
    """
    log = quality.load_log(raw, keys, cfg)
    normal = cleaning.normalise(raw, cfg).select(*keys, *[c for c in RAW.names if c not in keys])
    checked = quality.gate(normal.distinct(), keys, gate_cfg or cfg).select(*keys, F.col("passed_gate").alias("_clean"))
    refusal = F.when(F.col("rows_inserted") == 0, EMPTY_LOAD).when(~F.coalesce("_clean", F.lit(False)), MISSED_GATE)
    judged = join_null_safe(log, checked, keys, "left").withColumn("refusal", refusal)
    return judged.select(
        *keys, "rows_read", F.when(F.col("refusal").isNull(), F.col("rows_inserted")).otherwise(0).alias("rows_committed"),
        F.when(F.col("refusal").isNull(), F.col("status")).otherwise("FAILED").alias("status"), "refusal",
    )


def persist_reports(store: EventStore, reports: DataFrame, number: Column | None = None) -> None:
    """Append quality reports, keyed by ``source_file``, with the whole report as JSON.

    ``number`` orders the reports of a source where several are appended at once.
    """
    store.append(
        "quality_log",
        reports.select(
            (F.lit(new_id()) if number is None else number).alias("id"),
            "source_file",
            "total_records",
            "completeness_score",
            F.col("session_valid_rate").alias("valid_sessions_rate"),
            "price_outlier_rate",
            F.when(F.col("passed_gate"), "PASSED").otherwise("FAILED").alias("status"),
            quality.details_json(reports).alias("details"),
            F.lit(_now()).alias("checked_at"),
        ),
    )


def _stage(store: EventStore, path: str, raw: DataFrame, name: str) -> DataFrame:
    """Read and type the text once; keep distinct rows with their number of copies as Parquet.

    The report, the reject counts and the cleaning all read this table, so they see the same rows even
    when an executor was lost in between.
    """
    quality.distinct_with_copies(raw, []).write.parquet(path)
    return store.spark.read.parquet(path).withColumn("source_file", F.lit(name))


def _check_cleaned(loaded: DataFrame, cfg: PipelineConfig) -> None:
    """Cleaned rows that miss the gate abort the load."""
    report = quality.gate(loaded, ["source_file"], cfg).first()
    if not report["passed_gate"]:
        raise ValueError(f"the cleaned rows miss the quality gate: {report.asDict()}")


def _now() -> datetime:
    return datetime.now(timezone.utc)

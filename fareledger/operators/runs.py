"""Append-only run log: transitions, current state and operational listings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareledger.functions.columns import (
    duration_label,
    duration_seconds,
    fold_message,
    side_by_side,
)
from fareledger.functions.ranks import number_rows
from fareledger.operators.registry import get_one, raise_if_any
from fareledger.sources.readers import align_columns
from fareledger.sources.schemas import (
    ALREADY_LOADED,
    FAILED,
    LOADED,
    PIPELINE_RUNS,
    READY,
    REVISION,
    RUN_EVENTS,
    RUNNING,
    SKIPPED,
    SOURCE_REVISION,
    SUCCEEDED,
)

DIMENSIONS = ["dataset_name", "service_type", "source_year", "source_month", "source_file_id"]


def current_runs(events: DataFrame) -> DataFrame:
    """Latest state of every run; a run has only a handful of events."""
    return (
        events.groupBy("run_id")
        .agg(F.max_by(F.struct(*PIPELINE_RUNS.names), "event_seq").alias("_last"))
        .select("_last.*")
    )


def _numbered(sources: DataFrame, events: DataFrame) -> DataFrame:
    last = events.agg(F.max("run_id")).first()[0] or 0
    return number_rows(sources, "source_file_id", name="_n").withColumn(
        "run_id", F.col("_n") + last
    )


def start_runs(sources: DataFrame, events: DataFrame, started_at: datetime) -> DataFrame:
    """A running attempt for each source; only ready sources may start."""
    raise_if_any(sources.where(F.col("status") != READY).select(F.format_string(
        "Cannot start run for source %d with status %s", "source_file_id", "status"
    ).alias("problem")))
    rows = _numbered(sources.select(*DIMENSIONS), events).select(
        "run_id", *DIMENSIONS,
        F.lit(started_at).cast("timestamp").alias("started_at"),
        F.lit(RUNNING).alias("status"),
        F.lit(0).alias("event_seq"),
    )
    return align_columns(rows, RUN_EVENTS)


def skip_reason(status: Column | str) -> Column:
    status = F.col(status) if isinstance(status, str) else status
    return F.when(status == LOADED, F.lit(ALREADY_LOADED)).when(
        status == REVISION, F.lit(SOURCE_REVISION)
    )


def log_skipped(
    sources: DataFrame, events: DataFrame, at: datetime, reason: Column | str | None = None
) -> DataFrame:
    """A skipped run for each source; the reason must be the one its status implies."""
    given = skip_reason("status") if reason is None else (
        F.col(reason) if isinstance(reason, str) else reason
    )
    checked = sources.select(*DIMENSIONS, "status", given.alias("status_reason"))
    raise_if_any(
        checked.where(~F.col("status_reason").eqNullSafe(skip_reason("status"))
                      | F.col("status_reason").isNull())
        .select(F.format_string(
            "Skip reason %s is invalid for source status %s", "status_reason", "status"
        ).alias("problem"))
    )
    rows = _numbered(checked.select(*DIMENSIONS, "status_reason"), events).select(
        "run_id", *DIMENSIONS, "status_reason",
        F.lit(at).cast("timestamp").alias("started_at"),
        F.lit(at).cast("timestamp").alias("finished_at"),
        F.lit(SKIPPED).alias("status"),
        F.lit(0).cast("bigint").alias("rows_loaded"),
        F.lit(0).alias("event_seq"),
    )
    return align_columns(rows, RUN_EVENTS)


def transition_problems(outcomes: DataFrame, runs: DataFrame, sources: DataFrame) -> DataFrame:
    """Outcomes that may not be recorded, with the reason."""
    known = runs.select(
        "run_id", F.col("status").alias("_run_status"), F.col("source_file_id").alias("_source")
    )
    states = sources.select(
        F.col("source_file_id").alias("_source"), F.col("status").alias("_source_status")
    )
    problem = (
        F.when(F.col("_run_status").isNull(), F.format_string("Unknown run ID: %d", "run_id"))
        .when(
            F.col("_run_status") != RUNNING,
            F.format_string("Run %d is terminal with status %s", "run_id", "_run_status"),
        )
        .when(
            F.col("succeeded") & F.col("_source").isNull(),
            F.format_string("Run %d has no source file", "run_id"),
        )
        .when(
            F.col("succeeded") & ~F.col("_source_status").eqNullSafe(F.lit(READY)),
            F.format_string(
                "Cannot mark source %d loaded from status %s", "_source", "_source_status"
            ),
        )
        .when(
            ~F.col("succeeded") & (F.trim(F.coalesce("error_message", F.lit(""))) == ""),
            F.lit("error_message must not be empty"),
        )
    )
    return (
        outcomes.join(known, "run_id", "left").join(states, "_source", "left")
        .select("run_id", problem.alias("problem"))
        .where(F.col("problem").isNotNull())
    )


def finish_runs(
    outcomes: DataFrame, events: DataFrame, sources: DataFrame, finished_at: datetime
) -> DataFrame:
    """Final events of running attempts: succeeded with counts, or failed with a message.

    A success makes the source loaded at the same instant, because the source's effective
    status is read from this log.
    """
    runs = current_runs(events)
    raise_if_any(transition_problems(outcomes, runs, sources))
    base = runs.select("run_id", *DIMENSIONS, "started_at")
    good = F.col("succeeded")
    rows = outcomes.join(base, "run_id").select(
        "run_id", *DIMENSIONS, "started_at",
        F.lit(finished_at).cast("timestamp").alias("finished_at"),
        F.when(good, F.lit(SUCCEEDED)).otherwise(F.lit(FAILED)).alias("status"),
        F.when(good, F.col("rows_read")).alias("rows_read"),
        F.when(good, F.col("rows_loaded")).alias("rows_loaded"),
        F.when(good, F.lit(0)).alias("warning_count"),
        F.when(good, F.lit(0)).alias("error_count"),
        F.when(~good, fold_message("error_message")).alias("error_message"),
        F.lit(1).alias("event_seq"),
    )
    return align_columns(rows, RUN_EVENTS)


def quality_events(counters: DataFrame, events: DataFrame) -> DataFrame:
    """Later events of succeeded runs that carry their quality counters."""
    last = events.groupBy("run_id").agg(F.max("event_seq").alias("_seq"))
    rows = (
        current_runs(events).drop("warning_count", "error_count")
        .join(counters.select("run_id", "warning_count", "error_count"), "run_id")
        .join(last, "run_id").withColumn("event_seq", F.col("_seq") + 1)
    )
    return align_columns(rows, RUN_EVENTS)


def reconcile_counts(
    manifest: DataFrame, raw: DataFrame, key: str = "source_file_id",
    raw_key: str = "_source_file_id",
) -> DataFrame:
    """Files whose stored rows differ from the registered row count."""
    stored = raw.groupBy(F.col(raw_key).alias(key)).agg(F.count("*").alias("rows_loaded"))
    return (
        manifest.select(key, F.col("row_count").alias("rows_expected"))
        .join(stored, key, "left")
        .select(key, "rows_expected", F.coalesce("rows_loaded", F.lit(0)).alias("rows_loaded"))
        .where(~F.col("rows_expected").eqNullSafe(F.col("rows_loaded")))
    )


def latest_success(
    runs: DataFrame, sources: DataFrame, service: str | None = None, year: int | None = None,
    month: int | None = None,
) -> DataFrame:
    """Newest succeeded run of every partition whose source is still loaded."""
    for name, wanted in (("service_type", service), ("source_year", year), ("source_month", month)):
        if wanted is not None:
            runs = runs.where(F.col(name) == wanted)
    loaded = sources.where(F.col("status") == LOADED).select("source_file_id")
    named = F.col("dataset_name") == F.concat("service_type", F.lit("_tripdata"))
    return (
        runs.where((F.col("status") == SUCCEEDED) & named)
        .join(loaded, "source_file_id", "left_semi")
        .groupBy("service_type", "source_year", "source_month")
        .agg(F.max("run_id").alias("run_id"))
    )


def list_runs(
    runs: DataFrame, service_type: str | None = None, status: str | None = None,
    year: int | None = None, month: int | None = None, source_file_id: int | None = None,
    limit: int = 50, offset: int = 0, detail: bool = False,
) -> DataFrame:
    """Page of runs, latest start first; the failure text is shown only in detail."""
    filters = {"service_type": service_type, "status": status, "source_year": year,
               "source_month": month, "source_file_id": source_file_id}
    for name, wanted in filters.items():
        if wanted is not None:
            runs = runs.where(F.col(name) == wanted)
    ordered = runs.orderBy(F.col("started_at").desc(), F.col("run_id").desc())
    page = ordered.offset(offset).limit(limit)
    return page if detail else page.drop("error_message")


def latest_runs(runs: DataFrame, n: int = 50) -> DataFrame:
    return list_runs(runs, limit=n, detail=True)


def get_run(runs: DataFrame, run_id: int) -> DataFrame:
    return get_one(runs, "run_id", run_id, "run ID")


def run_quality(
    results: DataFrame, run_id: int | None = None, severity: str | None = None,
    status: str | None = None,
) -> DataFrame:
    """Quality results of one run in id order; without an id, of the newest run."""
    if run_id is None:
        newest = results.agg(F.max("run_id").alias("run_id"))
        results = results.join(newest, "run_id", "left_semi")
    else:
        results = results.where(F.col("run_id") == run_id)
    if severity is not None:
        results = results.where(F.col("severity") == severity)
    if status is not None:
        results = results.where(F.col("status") == status)
    return results.orderBy("quality_result_id")


def run_durations(runs: DataFrame) -> DataFrame:
    return runs.select(
        "run_id", "status",
        duration_seconds("started_at", "finished_at").alias("duration_seconds"),
        duration_label("started_at", "finished_at").alias("duration_label"),
    )


def pipeline_kpis(sources: DataFrame, runs: DataFrame) -> DataFrame:
    """Loaded files, successful runs and recorded warnings as one row."""
    files = sources.agg(F.count_if(F.col("status") == LOADED).alias("loaded_source_files"))
    totals = runs.agg(
        F.count_if(F.col("status") == SUCCEEDED).alias("successful_runs"),
        F.coalesce(F.sum(F.coalesce("warning_count", F.lit(0))), F.lit(0)).alias("quality_warnings"),
    )
    return side_by_side(files, totals)

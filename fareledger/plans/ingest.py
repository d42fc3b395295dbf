"""Register and load batches of source files, each version once and all or nothing."""

from __future__ import annotations

from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareledger.operators.registry import (
    current_sources,
    register,
    registration_rows,
)
from fareledger.operators.runs import (
    current_runs,
    finish_runs,
    log_skipped,
    reconcile_counts,
    start_runs,
)
from fareledger.session import literal_table, materialize
from fareledger.sources.manifest import file_manifest, source_list
from fareledger.sources.readers import read_raw
from fareledger.sources.schemas import ALREADY_LOADED, PROCEED, SKIPPED, SOURCE_REVISION
from fareledger.sources.tables import RAW_TABLES, Warehouse


REFUSED = "refused"
REFUSED_TABLE = "ops/refused_files"


class ContractError(ValueError):
    """A file does not match a supported contract."""


class IngestionError(RuntimeError):
    """A load failed after its run had started."""


class SourceRevisionError(RuntimeError):
    """A known partition arrived with other bytes."""


def registry_state(warehouse: Warehouse) -> DataFrame:
    """Registered versions with effective status, as a table small enough to broadcast."""
    return materialize(
        current_sources(warehouse.registrations(), current_runs(warehouse.run_events()))
    )


def ingest_batch(
    warehouse: Warehouse, sources: list[dict], now: datetime | None = None, strict: bool = True,
    manifest: DataFrame | None = None,
) -> DataFrame:
    """Load every new version among ``sources`` and report one row per attempt.

    The run log is written last. Until its succeeded event exists a version's raw rows are
    invisible to every model, and the next attempt replaces them, so a lost job or executor
    leaves nothing half loaded. With ``strict`` a refused file stops the batch before
    anything is registered; otherwise refused files are left out.
    """
    spark, now = warehouse.spark, now or datetime.now(UTC)
    if manifest is None:
        manifest = materialize(file_manifest(source_list(spark, sources)))
    turned_away = materialize(refusals(manifest, now))
    if not turned_away.isEmpty():
        warehouse.append(turned_away, REFUSED_TABLE)
        if strict:
            raise ContractError(turned_away.orderBy("path").select("rejection").first()[0])
    accepted = manifest.where("rejection IS NULL")
    with warehouse.exclusive("registration"):  # ids are given out by one batch at a time
        outcome = materialize(register(accepted, registry_state(warehouse)))
        if not outcome.where("is_new").isEmpty():
            warehouse.append(registration_rows(outcome, now), "ops/source_files")
        attempts = []
        skipped = outcome.where(F.col("decision") != PROCEED)
        if not skipped.isEmpty():
            attempts.append(materialize(log_skipped(skipped, warehouse.run_events(), now)))
            warehouse.append(attempts[-1], "ops/run_events")
        ready = outcome.where(F.col("decision") == PROCEED)
        begun = not ready.isEmpty()
        if begun:
            attempts.append(materialize(start_runs(ready, warehouse.run_events(), now)))
            warehouse.append(attempts[-1], "ops/run_events")
    failures: list[str] = []
    if begun:
        started = attempts[-1]
        paths = accepted.groupBy("partition_key", "checksum_sha256").agg(F.min("path").alias("path"))
        assignments = materialize(
            ready.join(paths, ["partition_key", "checksum_sha256"])
            .join(started.select("source_file_id", "run_id"), "source_file_id")
            .select("path", "source_file_id", "run_id", "row_count", "dataset_name")
        )
        outcomes = []
        for dataset in RAW_TABLES:
            done, failed = _load(warehouse, dataset, assignments, now)
            outcomes += done
            failures += failed
        warehouse.append(
            finish_runs(materialize(reduce(DataFrame.unionByName, outcomes)),
                        warehouse.run_events(), registry_state(warehouse), now),
            "ops/run_events",
        )
    if failures and strict:
        raise IngestionError(failures[0])
    runs = current_runs(warehouse.run_events())
    if attempts:
        mine = reduce(DataFrame.unionByName, [a.select("run_id") for a in attempts])
        runs = runs.join(mine, "run_id", "left_semi")
    else:
        runs = runs.limit(0)
    keys = outcome.select("source_file_id", "partition_key")
    tried = runs.join(keys, "source_file_id").select(
        "partition_key", "source_file_id", "run_id", "status", "status_reason",
        F.coalesce("rows_read", F.lit(0)).alias("rows_read"),
        F.coalesce("rows_loaded", F.lit(0)).alias("rows_loaded"), "error_message",
    )
    return tried.unionByName(turned_away.select(
        "partition_key", F.lit(REFUSED).alias("status"), F.col("rejection").alias("error_message"),
        F.lit(0).cast("bigint").alias("rows_read"), F.lit(0).cast("bigint").alias("rows_loaded"),
    ), allowMissingColumns=True)


def refusals(manifest: DataFrame, now: datetime) -> DataFrame:
    """One row per file that meets no contract; such a file is never registered."""
    return manifest.where("rejection IS NOT NULL").select(
        "partition_key", "path", "dataset_name", "rejection", F.lit(now).cast("timestamp").alias("refused_at"))


OUTCOME = "run_id bigint, succeeded boolean, rows_read bigint, rows_loaded bigint, error_message string"


def _load(
    warehouse: Warehouse, dataset: str, assignments: DataFrame, now: datetime
) -> tuple[list[DataFrame], list[str]]:
    """Load one dataset's files; returns run outcomes and the messages of failures.

    All files go in one job. If it fails it leaves nothing, and the files are halved until the bad
    ones stand alone: with k bad files among n some k * log2(n) jobs more, and every good file loaded.
    """
    spark = warehouse.spark
    mine = assignments.where(F.col("dataset_name") == dataset)
    listed = mine.select("path", "source_file_id", "run_id").orderBy("source_file_id").collect()
    waiting, loaded, failed = [listed] if listed else [], [], []
    while waiting:
        files = waiting.pop()
        part = literal_table(spark, [tuple(f) for f in files],
                             "path string, source_file_id bigint, run_id bigint")
        try:
            warehouse.append_raw(read_raw(spark, dataset, part, [f["path"] for f in files], now), dataset)
        except Exception as error:  # recorded on the run of the file that cannot be loaded
            if len(files) > 1:
                half = len(files) // 2
                waiting += [files[half:], files[:half]]
                continue
            text = " ".join(str(error).split()) or type(error).__name__
            failed.append((files[0]["run_id"], False, None, None, text))
        else:
            loaded += [(f["source_file_id"],) for f in files]
    outcomes, messages = [], [f[-1] for f in failed]
    if failed:
        outcomes.append(literal_table(spark, failed, OUTCOME))
    if loaded:
        ids = literal_table(spark, loaded, "source_file_id bigint")
        kept = mine.join(ids, "source_file_id", "left_semi")
        stored = warehouse.raw(dataset).join(
            ids.withColumnRenamed("source_file_id", "_source_file_id"), "_source_file_id", "left_semi")
        wrong = materialize(reconcile_counts(kept, stored))
        message = F.format_string(
            "Row-count mismatch: read %d, expected %s", "rows_loaded",
            F.coalesce(F.col("rows_expected").cast("string"), F.lit("none")),
        )
        done = materialize(kept.join(wrong, "source_file_id", "left").select(
            "run_id", F.col("rows_loaded").isNull().alias("succeeded"),
            F.col("row_count").alias("rows_read"),
            F.col("row_count").alias("rows_loaded"),
            F.when(F.col("rows_loaded").isNotNull(), message).alias("error_message"),
        ))
        outcomes.append(done)
        messages += [r[0] for r in done.where("NOT succeeded").select("error_message").collect()]
    return outcomes, messages


def ensure_loaded(warehouse: Warehouse, sources: list[dict], now: datetime | None = None) -> DataFrame:
    """Load what is new and name the decision; an unreviewed revision raises."""
    result = materialize(ingest_batch(warehouse, sources, now))
    revised = result.where(
        (F.col("status") == SKIPPED) & (F.col("status_reason") == SOURCE_REVISION)
    ).select("partition_key", "source_file_id", "run_id").limit(1).collect()
    if revised:
        key, file_id, run_id = revised[0]
        raise SourceRevisionError(
            f"Source revision requires review for {key} (source_file_id={file_id}, run_id={run_id})"
        )
    decision = F.when(F.col("status_reason") == ALREADY_LOADED, F.lit(ALREADY_LOADED))
    return result.withColumn("decision", F.coalesce(decision, F.lit("loaded")))

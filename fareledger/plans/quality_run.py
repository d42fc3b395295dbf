"""Evaluate the rule catalogs for loaded runs and store their results."""

from __future__ import annotations

from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareledger.operators.quality import (
    domain_counts,
    measure,
    quality_results,
    quality_values,
    target_problems,
    violation_counters,
)
from fareledger.operators.registry import StateError, active_zone_source, raise_if_any
from fareledger.operators.rules import rule_catalog
from fareledger.operators.runs import current_runs, latest_success, quality_events
from fareledger.plans.ingest import registry_state
from fareledger.session import literal_table, materialize
from fareledger.sources.schemas import TRIP_CONTRACTS
from fareledger.sources.tables import Warehouse, write_partitions


def run_quality_checks(
    warehouse: Warehouse, run_ids: list[int], executed_at: datetime | None = None
) -> DataFrame:
    """Check the files of the given runs, store the results and return one summary per run.

    All files of a dataset are checked together, grouped by file. Results replace those of
    an earlier evaluation of the same run and keep their ids.
    """
    spark, at = warehouse.spark, executed_at or datetime.now(UTC)
    runs, sources = current_runs(warehouse.run_events()), registry_state(warehouse)
    requested = literal_table(spark, [(run_id,) for run_id in run_ids], "run_id bigint")
    targets = materialize(target_problems(requested, runs, sources))
    raise_if_any(targets.where("problem IS NOT NULL"))
    zones = _active_zones(warehouse, sources)

    parts, values = [], []
    for dataset, contract in TRIP_CONTRACTS.items():
        mine = targets.where(F.col("dataset_name") == dataset).withColumnRenamed(
            "source_file_id", "_source_file_id"
        )
        months = mine.select(
            "_source_file_id", F.col("source_year").alias("_source_year"),
            F.col("source_month").alias("_source_month"),
        ).distinct()
        if mine.isEmpty():
            continue
        # The file id is the partition column, so the join prunes the scan.
        rows = warehouse.raw(dataset).join(months, "_source_file_id")
        rules = rule_catalog(dataset)
        counts = materialize(domain_counts(rows, rules, ["_source_file_id"]))
        values.append(quality_values(counts, mine, "_source_file_id"))
        measures = measure(rows, rules, ["_source_file_id"], zones, "LocationID", contract.names,
                           prefilter=True, values=counts)
        parts.append(quality_results(measures, rules, mine, "_source_file_id", at))
    results = materialize(reduce(DataFrame.unionByName, parts))
    write_partitions(reduce(DataFrame.unionByName, values),
                     warehouse.path("ops/quality_values"), "run_id")
    write_partitions(results, warehouse.path("ops/quality_results"), "run_id")
    counters = violation_counters(results)
    warehouse.append(quality_events(counters, warehouse.run_events()), "ops/run_events")
    checked = results.groupBy("run_id").agg(F.max("rows_checked").alias("rows_checked"))
    return targets.select("run_id", "partition_key").join(checked, "run_id").join(
        counters, "run_id"
    ).select(
        "partition_key", "run_id", "rows_checked", "check_count",
        F.col("warning_count").alias("warnings_violated"),
        F.col("error_count").alias("errors_violated"),
    )


def _active_zones(warehouse: Warehouse, sources: DataFrame) -> DataFrame:
    raw = warehouse.raw("taxi_zone_lookup")
    active = active_zone_source(sources, raw).select("source_file_id").collect()
    if not active:
        raise StateError("No loaded Taxi Zone source with rows is available")
    return raw.where(F.col("_source_file_id") == active[0][0])


def run_partition_quality(
    warehouse: Warehouse, service: str, year: int, month: int, executed_at: datetime | None = None
) -> DataFrame:
    """Check the latest successful load of one monthly partition."""
    runs = current_runs(warehouse.run_events())
    found = latest_success(runs, registry_state(warehouse), service, year, month).collect()
    if not found:
        raise StateError(f"No successful loaded run for {service}/{year}/{month:02d}")
    return run_quality_checks(warehouse, [found[0]["run_id"]], executed_at)

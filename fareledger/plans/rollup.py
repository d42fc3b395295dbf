"""Served aggregates kept beside the facts, and the date range of each file.

A file's facts never change once loaded, so their partial sums and counts by date, service and pickup
zone are written once, in a partition of the file's own, and readers merge partials instead of scanning
trips. Averages come from sums and counts, so merging loses nothing. Which files are missing is told by
the partition folders of both tables; a refresh with nothing new reads no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareledger.plans.analytics import named_zones, trip_filter
from fareledger.plans.star import FACT_TABLE, pending, stored_files
from fareledger.sources.tables import Warehouse, write_partitions

ROLLUP_TABLE = "marts/trip_rollup"
RANGES_TABLE = "marts/fct_ranges"
GRAIN = ("source_file_id", "pickup_date_key", "service_type", "pickup_zone_key")
SUMMED = ("total_amount", "trip_distance_miles", "fare_amount", "tip_amount")


def partials(facts: DataFrame) -> DataFrame:
    """Trips, and sum and count of non-null values of each measure, by ``GRAIN``."""
    facts = facts.withColumn("source_file_id", F.col("source_file_id").cast("bigint"))
    return facts.groupBy(*GRAIN).agg(
        F.count("*").alias("trip_count"),
        *[make(c).alias(f"{kind}_{c}") for c in SUMMED for kind, make in (("sum", F.sum), ("count", F.count))],
    )


def file_ranges(rollup: DataFrame) -> DataFrame:
    """Least and greatest known date key of each file, and its rows with and without a known date."""
    known = F.col("pickup_date_key") > 0
    return rollup.groupBy("source_file_id").agg(
        F.min(F.when(known, F.col("pickup_date_key"))).alias("min_date_key"),
        F.max(F.when(known, F.col("pickup_date_key"))).alias("max_date_key"),
        F.sum("trip_count").alias("row_count"),
        F.coalesce(F.sum(F.when(~known, F.col("trip_count"))), F.lit(0)).alias("unknown_count"),
    )


def refresh(warehouse: Warehouse, full_refresh: bool = False, facts: str = FACT_TABLE,
            rollup: str = ROLLUP_TABLE, ranges: str = RANGES_TABLE) -> tuple[DataFrame, DataFrame]:
    """Bring both tables up to the stored facts and return (rollup, ranges).

    Only partitions of files without partials are read. A lost job is repeated by the next refresh:
    a partition is replaced whole, and the ranges are derived from the partials.
    """
    rows = warehouse.read(facts)
    whole = full_refresh or not warehouse.exists(rollup)
    if not whole:
        missing = pending(stored_files(warehouse, facts).join(
            stored_files(warehouse, rollup), "source_file_id", "left_anti"))
        if missing.isEmpty():
            if not warehouse.exists(ranges):
                warehouse.write_table(file_ranges(warehouse.read(rollup)), ranges)
            return warehouse.read(rollup, partials(rows).schema), warehouse.read(ranges)
        rows = rows.join(missing, "source_file_id", "left_semi")
    fresh = partials(rows).repartition("source_file_id")
    if whole:
        fresh.write.mode("overwrite").partitionBy("source_file_id").parquet(warehouse.path(rollup))
    else:
        write_partitions(fresh, warehouse.path(rollup), "source_file_id")
    stored = warehouse.read(rollup, fresh.schema)
    return stored, warehouse.write_table(file_ranges(stored), ranges)


def _average(column: str) -> Column:
    return F.try_divide(F.sum(f"sum_{column}"), F.sum(f"count_{column}"))


def measures() -> list[Column]:
    """The measures of ``analytics``, merged from partials."""
    return [
        F.coalesce(F.sum("trip_count"), F.lit(0)).alias("trip_count"),
        F.sum("sum_total_amount").alias("total_amount"),
        _average("trip_distance_miles").alias("average_trip_distance_miles"),
        _average("fare_amount").alias("average_fare_amount"),
        _average("tip_amount").alias("average_tip_amount"),
    ]


def summary(rollup: DataFrame, dates: DataFrame, **bounds) -> DataFrame:
    """``analytics.summary`` from partials."""
    return trip_filter(rollup, dates, **bounds).agg(*measures())


def monthly(rollup: DataFrame, dates: DataFrame, **bounds) -> DataFrame:
    """``analytics.monthly`` from partials."""
    return (
        trip_filter(rollup, dates, **bounds)
        .groupBy(F.trunc("full_date", "MM").alias("month"), "service_type").agg(*measures())
        .orderBy(F.col("month").asc_nulls_last(), "service_type")
    )


def top_zones(rollup: DataFrame, dates: DataFrame, zones: DataFrame, limit: int = 10, **bounds) -> DataFrame:
    """``analytics.top_zones`` from partials."""
    per_zone = trip_filter(rollup, dates, **bounds).groupBy(F.col("pickup_zone_key").alias("zone_key")).agg(
        F.sum("trip_count").alias("trip_count"), F.sum("sum_total_amount").alias("total_amount"))
    return named_zones(per_zone, zones, limit)

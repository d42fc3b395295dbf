"""Filtered aggregates over the star schema."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareledger.operators.checks import lineage_bits

MEASURES = {
    "trip_count": lambda: F.count("*"),
    "total_amount": lambda: F.sum("total_amount"),
    "average_trip_distance_miles": lambda: F.avg("trip_distance_miles"),
    "average_fare_amount": lambda: F.avg("fare_amount"),
    "average_tip_amount": lambda: F.avg("tip_amount"),
}


def _measures() -> list[Column]:
    return [make().alias(name) for name, make in MEASURES.items()]


def trip_filter(
    facts: DataFrame, dates: DataFrame, service_type: str | None = None,
    start: date | None = None, end: date | None = None, ranges: DataFrame | None = None,
) -> DataFrame:
    """Facts joined to their pickup date, restricted by service and an inclusive date range.

    Any bound drops trips of the Unknown date. Known keys are yyyymmdd, so the bounds are
    also stated on the fact's own key, where they can skip row groups before the join. With the
    stored ``ranges`` of files they become a filter on the partition column as well, and the
    files of other dates are not opened at all.
    """
    if start is not None and end is not None and start > end:
        raise ValueError("start_date must be on or before end_date")
    if service_type is not None:
        facts = facts.where(F.col("service_type") == service_type)
    key = F.col("pickup_date_key")
    if start is not None:
        dates = dates.where(F.col("full_date") >= F.lit(start))
        facts = facts.where(key >= int(start.strftime("%Y%m%d")))
    if end is not None:
        dates = dates.where(F.col("full_date") <= F.lit(end))
        facts = facts.where((key > 0) & (key <= int(end.strftime("%Y%m%d"))))
    if ranges is not None and (start is not None or end is not None):
        first, last = F.col("min_date_key"), F.col("max_date_key")
        holding = ranges.where(first.isNotNull())
        if start is not None:
            holding = holding.where(last >= int(start.strftime("%Y%m%d")))
        if end is not None:
            holding = holding.where(first <= int(end.strftime("%Y%m%d")))
        facts = facts.join(holding.select("source_file_id"), "source_file_id", "left_semi")
    days = dates.select(F.col("date_key").alias("pickup_date_key"), "full_date")
    return facts.join(days, "pickup_date_key")


def summary(facts: DataFrame, dates: DataFrame, **bounds) -> DataFrame:
    """One row: trips, amount and averages; averages are null when nothing qualifies."""
    return trip_filter(facts, dates, **bounds).agg(*_measures())


def monthly(facts: DataFrame, dates: DataFrame, **bounds) -> DataFrame:
    """The same measures by month and service, the Unknown month last."""
    return (
        trip_filter(facts, dates, **bounds)
        .groupBy(F.trunc("full_date", "MM").alias("month"), "service_type")
        .agg(*_measures())
        .orderBy(F.col("month").asc_nulls_last(), "service_type")
    )


def top_zones(
    facts: DataFrame, dates: DataFrame, zones: DataFrame, limit: int = 10, **bounds
) -> DataFrame:
    """Pickup zones by trip count, ties by zone key.

    Trips collapse to one row per zone key before the zone attributes are joined.
    """
    per_zone = (
        trip_filter(facts, dates, **bounds)
        .groupBy(F.col("pickup_zone_key").alias("zone_key"))
        .agg(F.count("*").alias("trip_count"), F.sum("total_amount").alias("total_amount"))
    )
    return named_zones(per_zone, zones, limit)


def named_zones(per_zone: DataFrame, zones: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` busiest zones with their attributes, ties by zone key."""
    if not 1 <= limit <= 100:
        raise ValueError("limit must be between 1 and 100")
    named = zones.select("zone_key", "location_id", "borough", "zone_name")
    return (
        per_zone.join(named, "zone_key")
        .orderBy(F.col("trip_count").desc(), "zone_key").limit(limit)
        .select("location_id", "borough", "zone_name", "trip_count", "total_amount")
    )


def monthly_pivot(
    months: DataFrame, measure: str, services: list[str], how: str = "sum"
) -> DataFrame:
    """Months by services for one measure of ``monthly``; a null month reads Unknown."""
    combine = {"sum": F.sum, "mean": F.avg}[how]
    label = F.coalesce(F.col("month").cast("string"), F.lit("Unknown"))
    return months.groupBy(label.alias("month")).pivot("service_type", services).agg(combine(measure))


def service_share(months: DataFrame) -> DataFrame:
    """Trips per service over the monthly rows, and their share of all trips."""
    per_service = months.groupBy("service_type").agg(F.sum("trip_count").alias("trip_count"))
    everything = Window.partitionBy(F.lit(1))  # one row per service
    return per_service.withColumn(
        "share", F.col("trip_count") / F.sum("trip_count").over(everything)
    )


def zone_labels(top: DataFrame) -> DataFrame:
    return top.withColumn("label", F.concat("borough", F.lit(" · "), "zone_name"))


def lineage_counts(facts: DataFrame) -> DataFrame:
    """Rows and distinct (file, row number) pairs."""
    return lineage_bits(facts).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("lineage_count"), F.lit(0)).alias("lineage_count"),
    )

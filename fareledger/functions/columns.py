"""Scalar column expressions used across the package."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Signed seconds from ``start`` to ``end``, keeping microseconds."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end)) / F.lit(1e6)


def date_key(value: Column | str) -> Column:
    """Order-preserving yyyymmdd integer of a date."""
    value = col(value)
    return (F.year(value) * 10000 + F.month(value) * 100 + F.day(value)).cast("int")


def month_start(year: Column | str, month: Column | str) -> Column:
    return F.make_date(col(year).cast("int"), col(month).cast("int"), F.lit(1))


def outside_month(value: Column | str, year: Column | str, month: Column | str) -> Column:
    """True when a non-null timestamp is outside the half-open month."""
    value, first = col(value), month_start(year, month)
    return value.isNotNull() & (
        (value < first.cast("timestamp_ntz"))
        | (value >= F.add_months(first, 1).cast("timestamp_ntz"))
    )


def rate(part: Column | str, whole: Column | str) -> Column:
    """``part / whole`` as a double, 0.0 when there is nothing to divide by."""
    whole = col(whole)
    return F.coalesce(
        col(part).cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), F.lit(0.0)
    )


def partition_key(service: Column | str, year: Column | str, month: Column | str) -> Column:
    """``service/YYYY/MM``; null unless the year has four digits and the month exists."""
    year, month = col(year), col(month)
    valid = year.between(1000, 9999) & month.between(1, 12)
    return F.when(
        valid, F.format_string("%s/%04d/%02d", col(service), year.cast("int"), month.cast("int"))
    )


def object_key(
    service: Column | str, year: Column | str, month: Column | str, checksum: Column | str
) -> Column:
    """Checksum-addressed key of a stored source; a null service means the zone lookup."""
    zones = F.format_string("landing/reference/taxi_zones/%s.csv", col(checksum))
    monthly = F.concat(
        F.lit("landing/"), partition_key(service, year, month), F.lit("/"), col(checksum),
        F.lit(".parquet"),
    )
    return F.when(col(service).isNull(), zones).otherwise(monthly)


def month_lag(day: Column | str, months: int = 2) -> Column:
    """First day of the month ``months`` before the logical date."""
    return F.add_months(F.trunc(col(day), "MM"), -months)


def finite(value: Column | str) -> Column:
    """NaN and infinities as null, the way reports show them."""
    value = col(value)
    bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(~bad, value)


def fold_message(message: Column | str, prefix: str = "Raw ingestion failed: ") -> Column:
    """Failure text on one line, whole."""
    return F.concat(F.lit(prefix), F.trim(F.regexp_replace(col(message), r"\s+", " ")))


def short_message(message: Column | str, length: int = 1000) -> Column:
    """The first characters of a stored message, for listings."""
    return F.substring(col(message), 1, length)


def duration_seconds(start: Column | str, end: Column | str) -> Column:
    """Whole seconds between two clocks, never below zero; null while the run is open."""
    return F.greatest(F.lit(0), F.timestamp_diff("SECOND", col(start), col(end))).cast("long")


def duration_label(start: Column | str, end: Column | str) -> Column:
    # The labels of a run that has not started, and of one that goes on.
    seconds = duration_seconds(start, end)
    hours = F.floor(seconds / 3600).cast("long")
    minutes = F.floor(F.pmod(seconds, F.lit(3600)) / 60).cast("long")
    rest = F.pmod(seconds, F.lit(60))
    return (
        F.when(col(start).isNull(), F.lit("—"))
        .when(col(end).isNull(), F.lit("In progress"))
        .when(hours > 0, F.format_string("%dh %dm %ds", hours, minutes, rest))
        .when(minutes > 0, F.format_string("%dm %ds", minutes, rest))
        .otherwise(F.format_string("%ds", rest))
    )


def melt(
    df: DataFrame, keys: Sequence[str], cells: dict[str, Column], label: str, value: str,
    keep_nulls: bool = False,
) -> DataFrame:
    """One row per key row and cell, from one scan; null cells are dropped unless asked for.

    An unpivot is a plain projection per cell, so unlike exploding a filtered array it stays
    in generated code.
    """
    names = {f"_cell{i}": name for i, name in enumerate(cells)}
    wide = df.select(*keys, *[cells[name].alias(c) for c, name in names.items()])
    long = wide.unpivot(list(keys), list(names), "_cell", value)
    if not keep_nulls:
        long = long.where(F.col(value).isNotNull())
    labels = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return long.select(*keys, labels[F.col("_cell")].alias(label), value)


def side_by_side(*parts: DataFrame) -> DataFrame:
    """Several one-row aggregates as one row, without joining them."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])

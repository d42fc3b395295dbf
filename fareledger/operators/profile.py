"""Exact column profiles in long format, grouped by a ``source`` column.

Counts and extremes of all columns come from one scan; the exact percentiles come from one more,
which shuffles distinct values with their counts and selects ranks by the totals of its parts.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareledger.functions.columns import finite, melt, outside_month, rate, seconds_between
from fareledger.functions.ranks import percentile_columns, ranked_values
from fareledger.operators.quality import (
    exact_duplicates,
    id_type,
    unresolved_counts,
    value_counts,
)
from fareledger.session import materialize
from fareledger.sources.contracts import missing_text

SOURCE = "source"
PERCENTS = {"p01": 0.01, "p50": 0.5, "p95": 0.95, "p99": 0.99}


def labelled(df: DataFrame, source: Column | str) -> DataFrame:
    """``df`` with the label its profile rows will carry."""
    if SOURCE in df.columns:
        raise ValueError(f"rename the column {SOURCE} before profiling")
    return df.withColumn(SOURCE, F.lit(source) if isinstance(source, str) else source)


def _per_column(wide: DataFrame, columns: Iterable[str], facts: Sequence[str]) -> DataFrame:
    """One row per source and column from aggregates named ``<fact>|<column>``."""
    structs = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{fact}|{c}`").alias(fact) for fact in facts])
        for c in columns
    ]
    return wide.select(SOURCE, F.explode(F.array(*structs)).alias("_c")).select(SOURCE, "_c.*")


def null_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    wide = df.groupBy(SOURCE).agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_count|{c}") for c in columns],
    )
    rated = wide.select(
        "*", *[rate(f"`null_count|{c}`", "_rows").alias(f"null_rate|{c}") for c in columns]
    )
    return _per_column(rated, columns, ["null_count", "null_rate"])


def numeric_profile(df: DataFrame, columns: dict[str, Column] | Sequence[str]) -> DataFrame:
    """Counts, extremes, signs and exact linear percentiles of several numeric columns.

    NaN is not null, but it takes no part in extremes, percentiles or sign counts.
    """
    if not isinstance(columns, dict):
        columns = {c: F.col(c) for c in columns}
    names, ps = list(columns), list(PERCENTS.values())
    shaped = df.select(SOURCE, *[v.cast("double").alias(c) for c, v in columns.items()])
    aggregates = []
    for c in names:
        value = F.col(f"`{c}`")
        number = F.when(~F.isnan(value), value)
        aggregates += [
            F.count(value).alias(f"non_null_count|{c}"),
            F.count_if(value.isNull()).alias(f"null_count|{c}"),
            F.min(number).alias(f"_lo|{c}"),
            F.max(number).alias(f"_hi|{c}"),
            F.count_if(number < 0).alias(f"count_lt_0|{c}"),
            F.count_if(number == 0).alias(f"count_eq_0|{c}"),
            F.count_if(number > 0).alias(f"count_gt_0|{c}"),
        ]
    facts = ["non_null_count", "null_count", "_lo", "_hi", "count_lt_0", "count_eq_0",
             "count_gt_0"]
    stats = materialize(_per_column(shaped.groupBy(SOURCE).agg(*aggregates), names, facts))
    cells = {c: F.when(~F.isnan(f"`{c}`"), F.col(f"`{c}`")) for c in names}
    longs = melt(shaped, [SOURCE], cells, "column", "_v")
    exact = (
        ranked_values(longs, [SOURCE, "column"], "_v", ps)
        .groupBy(SOURCE, "column").agg(*percentile_columns(PERCENTS))
    )
    total = F.col("non_null_count") + F.col("null_count")
    return stats.join(exact, [SOURCE, "column"], "left").select(
        SOURCE, "column", "non_null_count", "null_count",
        rate("null_count", total).alias("null_rate"),
        finite("_lo").alias("minimum"),
        *[finite(p).alias(p) for p in PERCENTS],
        finite("_hi").alias("maximum"),
        "count_lt_0", "count_eq_0", "count_gt_0",
    )


def domain_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each column, nulls included as the null value."""
    cells = {c: F.col(c).cast("string") for c in columns}
    return (
        melt(df, [SOURCE], cells, "column", "value", keep_nulls=True)
        .groupBy(SOURCE, "column", "value").agg(F.count("*").alias("count"))
    )


def datetime_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    wide = df.groupBy(SOURCE).agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_count|{c}") for c in columns],
        *[F.min(c).alias(f"minimum|{c}") for c in columns],
        *[F.max(c).alias(f"maximum|{c}") for c in columns],
    )
    rated = wide.select(
        "*", *[rate(f"`null_count|{c}`", "_rows").alias(f"null_rate|{c}") for c in columns]
    )
    return _per_column(rated, columns, ["null_count", "null_rate", "minimum", "maximum"])


def duration_counts(
    df: DataFrame, start: str, end: str, year: Column | int, month: Column | int
) -> DataFrame:
    """Row counts around a pair of timestamps and the nominal month of the source."""
    y = F.lit(year) if isinstance(year, int) else year
    m = F.lit(month) if isinstance(month, int) else month
    return df.groupBy(SOURCE).agg(
        F.count_if(F.col(end) < F.col(start)).alias("dropoff_before_pickup_count"),
        F.count_if(F.col(start).isNull() | F.col(end).isNull()).alias("either_datetime_null_count"),
        F.count_if(outside_month(start, y, m)).alias("pickup_outside_nominal_month_count"),
    )


def duration_profile(
    df: DataFrame, start: str, end: str, year: Column | int, month: Column | int,
    name: str = "trip_duration_seconds",
) -> DataFrame:
    """Numeric profile of the signed seconds between two timestamps plus their counts."""
    numbers = numeric_profile(df, {name: seconds_between(start, end)})
    return numbers.join(duration_counts(df, start, end, year, month), SOURCE)


def reference_profile(
    df: DataFrame, columns: Sequence[str], dim: DataFrame, dim_key: str
) -> DataFrame:
    """Coverage of lookup ids per column: totals, matches and the unmatched rate."""
    kind = id_type(df, columns, dim, dim_key)
    counts = value_counts(df, {c: c for c in columns}, [SOURCE], kind)
    members = dim.select(F.col(dim_key).cast(kind).alias("value")).where(
        "value IS NOT NULL"
    ).distinct().withColumn("_hit", F.lit(True))
    matched = counts.join(members, "value", "left").groupBy(
        SOURCE, F.col("label").alias("column")
    ).agg(F.sum(F.when(F.col("_hit"), F.col("count")).otherwise(0)).alias("matched_count"))
    totals = df.groupBy(SOURCE).agg(
        F.count("*").alias("_rows"), *[F.count(c).alias(f"non_null_count|{c}") for c in columns]
    )
    shaped = totals.select(
        "*", *[F.col("_rows").alias(f"total_rows|{c}") for c in columns]
    )
    base = _per_column(shaped, columns, ["total_rows", "non_null_count"])
    full = base.join(matched, [SOURCE, "column"], "left").withColumn(
        "matched_count", F.coalesce("matched_count", F.lit(0))
    )
    unmatched = F.col("non_null_count") - F.col("matched_count")
    return full.select(
        SOURCE, "column", "total_rows",
        (F.col("total_rows") - F.col("non_null_count")).alias("null_count"),
        "non_null_count", "matched_count", unmatched.alias("unmatched_count"),
        rate(unmatched, "non_null_count").alias("unmatched_rate_among_non_null"),
    )


def unmatched_ids(df: DataFrame, columns: Sequence[str], dim: DataFrame, dim_key: str) -> DataFrame:
    """Rows per non-null id that the lookup does not hold."""
    found = unresolved_counts(df, {c: c for c in columns}, dim, dim_key, [SOURCE])
    return found.select(
        SOURCE, F.col("label").alias("column"), F.col("value").cast("string").alias("value"), "count"
    )


def duplicate_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact copies per source: totals, unique rows, participants, excess and groups."""
    return exact_duplicates(df, columns, [SOURCE]).select(
        SOURCE, "total_rows",
        (F.col("total_rows") - F.col("excess_rows")).alias("unique_full_rows"),
        F.col("participating_rows").alias("rows_participating_in_duplicate_groups"),
        F.col("excess_rows").alias("duplicate_excess_rows"),
        "duplicate_groups",
    )


def key_profile(df: DataFrame, column: str) -> DataFrame:
    """Repeats (a repeated null counts), distinct non-null values and numeric extremes."""
    counts = df.groupBy(SOURCE, F.col(column).alias("_key")).agg(F.count("*").alias("_n"))
    number = F.expr("try_cast(_key AS double)")
    return counts.groupBy(SOURCE).agg(
        F.sum(F.col("_n") - 1).alias("duplicate_count"),
        F.count("_key").alias("unique_count"),
        F.min(number).alias("minimum"),
        F.max(number).alias("maximum"),
    )


# Readings of a text column, narrowest first, with what a cell must look like.
READINGS = {
    "boolean": lambda v: F.lower(v).isin("true", "false"),
    "int": lambda v: v.rlike(r"^[+-]?[0-9]+$") & v.try_cast("bigint").isNotNull(),
    "double": lambda v: v.try_cast("double").isNotNull(),
}


def inferred_types(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The narrowest reading that holds for every non-null cell of each column.

    Readings form a lattice null < boolean, int < double < text: one flag each, which partial
    aggregates merge by "and", so all columns cost one scan and a row a task. ``read_type`` is the
    type of a column that can hold its nulls too: whole numbers beside nulls are read as double,
    booleans as text, and a column of nulls only as double. Blanks around a cell count as text.
    """
    cells = {c: F.col(c).cast("string") for c in columns}
    v = F.col("_v")
    flags = melt(df, [SOURCE], cells, "column", "_v", keep_nulls=True).groupBy(SOURCE, "column").agg(
        F.count(v).alias("_filled"), F.count_if(v.isNull()).alias("_nulls"),
        *[F.bool_and(F.when(v.isNotNull(), (v == F.trim(v)) & holds(v))).alias(f"_{name}")
          for name, holds in READINGS.items()],
    )
    narrowest = F.when(F.col("_filled") == 0, F.lit("null"))
    for name in READINGS:
        narrowest = narrowest.when(F.col(f"_{name}"), F.lit(name))
    widened = {"null": "double", "int": "double", "boolean": "text"}
    kind, nulls = F.col("inferred_type"), F.col("_nulls") > 0
    read = F.when(kind == "null", F.lit(widened["null"]))
    for name in ("int", "boolean"):
        read = read.when((kind == name) & nulls, F.lit(widened[name]))
    return flags.withColumn("inferred_type", narrowest.otherwise("text")).select(
        SOURCE, "column", "inferred_type", read.otherwise(kind).alias("read_type"))


def schema_profile(fields: DataFrame, documented: Sequence[str] = ()) -> DataFrame:
    """Section ``schema`` of files: place, type and nullability of each column, documented names.

    ``fields`` is (source, ordinal_position, name, arrow_type, nullable), one row a file and column.
    """
    columns = long_format(fields.select(
        SOURCE, F.col("name").alias("column"), "ordinal_position", "arrow_type",
        F.col("nullable").cast("string").alias("nullable")), "schema")
    if not documented:
        return columns
    names = fields.groupBy(SOURCE).agg(F.collect_set("name").alias("_names"))
    present = F.explode(F.array(*[
        F.struct(F.lit(n).alias("column"), F.array_contains("_names", n).cast("string").alias("documented_present"))
        for n in documented]))
    return columns.unionByName(long_format(names.select(SOURCE, present.alias("_d")).select(SOURCE, "_d.*"), "schema"))


def lookup_profile(
    zones: DataFrame, key: str = "LocationID", domains: Sequence[str] = ("Borough", "service_zone")
) -> dict[str, DataFrame]:
    """Profile of a lookup table, reading the usual missing-value texts as null."""
    columns = [c for c in zones.columns if c != SOURCE and not c.startswith("_")]
    texts = [f.name for f in zones.schema.fields if isinstance(f.dataType, T.StringType)]
    read = zones.select(
        SOURCE, *[missing_text(c).alias(c) if c in texts else F.col(c) for c in columns]
    )
    return {
        "columns": null_summary(read, columns),
        "types": inferred_types(read, columns),
        "key": key_profile(read, key),
        "domains": domain_profile(read, [c for c in domains if c in columns]),
        "duplicates": duplicate_profile(read, columns),
    }


@dataclass(frozen=True)
class ProfileSpec:
    """Columns of one service that the profiler looks at."""

    columns: tuple[str, ...]
    domains: tuple[str, ...]
    numerics: tuple[str, ...]
    start: str
    end: str
    references: tuple[str, ...]


def service_spec(contract) -> ProfileSpec:
    """The profile of a trip contract: codes, measures, clocks and lookup ids."""
    names = contract.names
    kinds = dict(contract.fields)
    codes = [c for c in ("VendorID", "RatecodeID", "store_and_fwd_flag", "payment_type",
                         "trip_type") if c in names]
    clocks = [c for c in names if kinds[c] == "timestamp_ntz"]
    measures = [c for c in names if kinds[c] == "double" or c == "passenger_count"]
    return ProfileSpec(
        tuple(names), tuple(codes), tuple(measures), clocks[0], clocks[1],
        ("PULocationID", "DOLocationID"),
    )


def long_format(df: DataFrame, section: str, column: Column | None = None) -> DataFrame:
    """Rows (source, section, column, metric, number, text) from a wide profile part."""
    skip = {SOURCE, "column"}
    name = column if column is not None else F.col("column")
    metrics = []
    for f in df.schema.fields:
        if f.name in skip:
            continue
        numeric = isinstance(f.dataType, T.NumericType)
        value = F.col(f"`{f.name}`")
        metrics.append(F.struct(
            F.lit(f.name).alias("metric"),
            (value.cast("double") if numeric else F.lit(None).cast("double")).alias("number"),
            (F.lit(None).cast("string") if numeric else value.cast("string")).alias("text"),
        ))
    return df.select(
        SOURCE, F.lit(section).alias("section"), name.alias("column"),
        F.explode(F.array(*metrics)).alias("_m"),
    ).select(SOURCE, "section", "column", "_m.*")


def long_counts(df: DataFrame, section: str) -> DataFrame:
    return df.select(
        SOURCE, F.lit(section).alias("section"), "column",
        F.col("value").alias("metric"),  # stays null for null, so no text can be taken for it
        F.col("count").cast("double").alias("number"), F.lit(None).cast("string").alias("text"),
    )


def profile_service(
    df: DataFrame, spec: ProfileSpec, zones: DataFrame, zone_key: str,
    year: Column | int, month: Column | int,
    fields: DataFrame | None = None, documented: Sequence[str] = (),
) -> DataFrame:
    """All profile sections of the labelled rows as one long table.

    With the ``fields`` of the files' footers the schema is a section of its own.

    Duration joins the numeric columns, so numbers, signs and percentiles of everything
    cost two scans; nulls and datetimes, domains, references and duplicates one each.
    """
    columns = [c for c in spec.columns if c in df.columns]
    numerics = {c: F.col(c) for c in spec.numerics if c in df.columns}
    numerics["trip_duration_seconds"] = seconds_between(spec.start, spec.end)
    whole = F.lit("*")
    parts = [
        long_format(null_summary(df, columns), "columns"),
        long_format(numeric_profile(df, numerics), "numeric"),
        long_format(datetime_profile(df, [spec.start, spec.end]), "datetime"),
        long_format(duration_counts(df, spec.start, spec.end, year, month), "duration", whole),
        long_counts(domain_profile(df, [c for c in spec.domains if c in df.columns]), "domain"),
        long_format(reference_profile(df, spec.references, zones, zone_key), "reference"),
        long_counts(unmatched_ids(df, spec.references, zones, zone_key), "unmatched"),
        long_format(duplicate_profile(df, columns), "duplicates", whole),
    ]
    if fields is not None:
        parts.append(schema_profile(fields, documented))
    return reduce(DataFrame.unionByName, parts)


def profile_compare(profile: DataFrame, left: str, right: str) -> DataFrame:
    """Two sources of a long profile side by side with the difference of their numbers."""
    def value(name: str, what: str) -> Column:
        return F.max(F.when(F.col(SOURCE) == name, F.col(what)))

    return (
        profile.where(F.col(SOURCE).isin(left, right))
        .groupBy("section", "column", "metric")
        .agg(
            value(left, "number").alias("left_number"), value(right, "number").alias("right_number"),
            value(left, "text").alias("left_text"), value(right, "text").alias("right_text"),
        )
        .withColumn("delta", F.col("right_number") - F.col("left_number"))
    )

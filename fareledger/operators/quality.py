"""Set-based quality checks over raw rows, for any number of files in one job."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareledger.functions.columns import melt, rate, side_by_side
from fareledger.operators.rules import (
    DOMAIN,
    DUPLICATE,
    ERROR,
    INFO,
    REFERENCE,
    SCALAR,
    WARNING,
    Rule,
    of_kind,
)
from fareledger.session import materialize
from fareledger.sources.schemas import LOADED, SUCCEEDED, TRIP_CONTRACTS

PASSED, VIOLATED = "passed", "violated"
# Result ids are run * RESULTS_PER_RUN + ordinal, so a catalog may hold fewer rules than that.
RESULTS_PER_RUN = 1_000
NO_VALUES = '{"unexpected_value_count":0}'


def scalar_checks(
    df: DataFrame, rules: Sequence[Rule], keys: Sequence[str], also: Sequence[str] = ()
) -> DataFrame:
    """Rows and failing rows of every scalar rule per group, in one scan.

    ``also`` names other checks that get a zero for each group.
    """
    chosen = of_kind(rules, SCALAR)
    wide = df.groupBy(*keys).agg(
        F.count("*").alias("rows_checked"),
        *[F.count_if(rule.condition()).alias(rule.name) for rule in chosen],
        *[F.count_if(F.lit(False)).alias(name) for name in also],
    )
    names = [*(rule.name for rule in chosen), *also]
    return wide.unpivot([*keys, "rows_checked"], names, "check_name", "rows_failed")


def domain_counts(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str]) -> DataFrame:
    """Rows per non-null value outside its domain; whole and exact however many values.

    All domain columns share one scan. Only unexpected cells become rows, integers in
    ``int_value`` and any other type in ``text_value``.
    """
    cells, whole = {}, []
    for rule in of_kind(rules, DOMAIN):
        value = F.col(rule.column)
        cells[rule.name] = F.when(~value.isin(*rule.allowed), value.cast("string"))
        if isinstance(df.schema[rule.column].dataType, T.IntegralType):
            whole.append(rule.name)
    counts = (
        melt(df, keys, cells, "check_name", "value")
        .groupBy(*keys, "check_name", "value").agg(F.count("*").alias("count"))
    )
    number = F.col("check_name").isin(*whole)
    return counts.select(
        *keys, "check_name",
        F.when(number, F.col("value").cast("bigint")).alias("int_value"),
        F.when(~number, F.col("value")).alias("text_value"),
        "count",
    )


def domain_totals(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Failing rows per domain rule and, as details, how many different values they hold.

    Details have one size for any number of values; the values are the rows of ``counts``.
    """
    return counts.groupBy(*keys, "check_name").agg(
        F.sum("count").alias("rows_failed"),
        F.to_json(F.struct(F.count("*").alias("unexpected_value_count"))).alias("details"),
    )


def domain_checks(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str]) -> DataFrame:
    """``domain_totals`` of all domain rules, in one scan."""
    return domain_totals(domain_counts(df, rules, keys), keys)


def quality_values(counts: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """Every unexpected value of every target run as a row, however many there are."""
    return targets.select("run_id", key).join(counts, key).select(
        "run_id", "check_name", "int_value", "text_value", "count"
    )


def id_type(df: DataFrame, columns: Sequence[str], dim: DataFrame, dim_key: str) -> str:
    """Common type to compare ids in: numbers stay numbers when both sides are whole."""
    kinds = [df.schema[c].dataType for c in columns] + [dim.schema[dim_key].dataType]
    return "bigint" if all(isinstance(k, T.IntegralType) for k in kinds) else "string"


def value_counts(
    df: DataFrame, columns: dict[str, str], keys: Sequence[str], kind: str = "string"
) -> DataFrame:
    """Rows per non-null value of several columns, labelled, in one scan."""
    cells = {label: F.col(c).cast(kind) for label, c in columns.items()}
    return (
        melt(df, keys, cells, "label", "value")
        .groupBy(*keys, "label", "value").agg(F.count("*").alias("count"))
    )


def unresolved_counts(
    df: DataFrame, columns: dict[str, str], dim: DataFrame, dim_key: str, keys: Sequence[str]
) -> DataFrame:
    """Rows per value that has no member in ``dim``.

    Rows collapse to one per distinct value before the join, so a hot value costs one row
    and the lookup may be of any size.
    """
    kind = id_type(df, list(columns.values()), dim, dim_key)
    members = dim.select(F.col(dim_key).cast(kind).alias("value")).where("value IS NOT NULL")
    return value_counts(df, columns, keys, kind).join(members, "value", "left_anti")


def reference_checks(
    df: DataFrame, rules: Sequence[Rule], dim: DataFrame, dim_key: str, keys: Sequence[str]
) -> DataFrame:
    """Failing rows per reference rule: non-null ids absent from the lookup."""
    columns = {rule.name: rule.column for rule in of_kind(rules, REFERENCE)}
    return (
        unresolved_counts(df, columns, dim, dim_key, keys)
        .groupBy(*keys, F.col("label").alias("check_name"))
        .agg(F.sum("count").alias("rows_failed"))
    )


def duplicate_groups(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Sizes of groups of rows equal on all columns, nulls, NaN and signed zeros included.

    Copies collapse in the partial aggregate before the shuffle.
    """
    return (
        df.groupBy(*keys, *[F.col(c) for c in columns if c not in keys])
        .agg(F.count("*").alias("group_size"))
    )


def exact_duplicates(
    df: DataFrame, columns: Sequence[str] | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Participating rows, excess rows and groups of exact copies per group of ``keys``."""
    chosen = list(columns) if columns else [c for c in df.columns if not c.startswith("_")]
    size = F.when(F.col("group_size") > 1, F.col("group_size"))
    return duplicate_groups(df, chosen, keys).groupBy(*keys).agg(
        F.coalesce(F.sum(size), F.lit(0)).alias("participating_rows"),
        F.coalesce(F.sum(size - 1), F.lit(0)).alias("excess_rows"),
        F.count(size).alias("duplicate_groups"),
        F.coalesce(F.sum("group_size"), F.lit(0)).alias("total_rows"),
    )


def exact_duplicates_prefiltered(
    df: DataFrame, columns: Sequence[str] | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """``exact_duplicates`` for wide rows: a hash pass first, whole rows only where hashes repeat.

    The first pass shuffles one hash per distinct row of a task instead of the row. Rows
    that share a hash are then compared on all columns, so collisions do not count. The
    repeated hashes are a stored table: Catalyst broadcasts it when it is small, which
    leaves the unique rows where they are, and shuffles by hash when it is not.
    """
    chosen = list(columns) if columns else [c for c in df.columns if not c.startswith("_")]
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, T.FractionalType)}
    whole = [F.col(c) + 0.0 if c in floats else F.col(c) for c in chosen]  # one zero
    hashed = df.select(
        *keys, *[c for c in chosen if c not in keys], F.xxhash64(*whole).alias("_hash")
    )
    sizes = materialize(
        hashed.groupBy(*keys, "_hash").agg(F.count("*").alias("_n"))
        .groupBy(*keys, (F.col("_n") > 1).alias("_repeats"),
                 F.when(F.col("_n") > 1, F.col("_hash")).alias("_hash"))
        .agg(F.sum("_n").alias("_n"))
    )
    repeated = sizes.where("_repeats").select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                                              F.col("_hash").alias("_h"))
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    candidates = hashed.join(repeated, [F.col("_hash") == F.col("_h"), *same], "left_semi")
    found = exact_duplicates(candidates, chosen, keys).drop("total_rows")
    totals = sizes.groupBy(*keys).agg(F.sum("_n").alias("total_rows"))
    names = ["participating_rows", "excess_rows", "duplicate_groups"]
    if not keys:
        return side_by_side(found, totals).select(
            *names, F.coalesce("total_rows", F.lit(0)).alias("total_rows")
        )
    found = found.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *names)
    return totals.join(found, same, "left").select(
        *keys, *[F.coalesce(n, F.lit(0)).alias(n) for n in names], "total_rows"
    )


def duplicate_checks(
    df: DataFrame, rules: Sequence[Rule], columns: Sequence[str], keys: Sequence[str],
    prefilter: bool = False,
) -> DataFrame:
    """Duplicate rules as measures: participating rows fail, the rest goes to details."""
    find = exact_duplicates_prefiltered if prefilter else exact_duplicates
    found = find(df, columns, keys)
    names = F.array(*[F.lit(rule.name) for rule in of_kind(rules, DUPLICATE)])
    return found.select(
        *keys, F.explode(names).alias("check_name"),
        F.col("participating_rows").alias("rows_failed"),
        F.to_json(F.struct(
            F.col("excess_rows").alias("duplicate_excess_rows"), "duplicate_groups"
        )).alias("details"),
    )


def measure(
    df: DataFrame, rules: Sequence[Rule], keys: Sequence[str], dim: DataFrame | None = None,
    dim_key: str | None = None, columns: Sequence[str] | None = None, prefilter: bool = False,
    values: DataFrame | None = None,
) -> DataFrame:
    """All measures of a catalog in long form: one row per group and rule, zero ones included.

    ``prefilter`` looks for duplicates by hash first; it pays on wide rows. ``values`` are the
    stored ``domain_counts`` of the same rows, where they are kept.
    """
    def shaped(part: DataFrame) -> DataFrame:
        return part.select(
            *keys, "check_name", "rows_failed",
            *[
                (F.col(c) if c in part.columns else F.lit(None)).cast(t).alias(c)
                for c, t in (("details", "string"), ("rows_checked", "bigint"))
            ],
        )

    # Rules that tell of failures only have failed nowhere else, which is a measure too.
    sparse = [r.name for kind in (DOMAIN, REFERENCE) for r in of_kind(rules, kind)]
    parts = []
    if sparse or of_kind(rules, SCALAR):
        parts.append(shaped(scalar_checks(df, rules, keys, sparse)))
    if of_kind(rules, DOMAIN):
        counts = domain_counts(df, rules, keys) if values is None else values
        parts.append(shaped(domain_totals(counts, keys)))
    if of_kind(rules, REFERENCE):
        parts.append(shaped(reference_checks(df, rules, dim, dim_key, keys)))
    if of_kind(rules, DUPLICATE):
        chosen = list(columns) if columns else [c for c in df.columns if not c.startswith("_")]
        parts.append(shaped(duplicate_checks(df, rules, chosen, keys, prefilter)))
    return reduce(DataFrame.unionByName, parts).groupBy(*keys, "check_name").agg(
        *[F.max(c).alias(c) for c in ("rows_failed", "details", "rows_checked")])


def quality_results(
    measures: DataFrame, rules: Sequence[Rule], targets: DataFrame, key: str,
    executed_at: datetime | Column,
) -> DataFrame:
    """One result row per target run and rule.

    ``targets`` has ``run_id`` and ``key``. A group without rows has rate 0.0; where there are
    rows, a rule of the catalog that was not measured is an error, and so is a measure of no
    rule. The id depends only on run and rule, so a rerun keeps it.
    """
    if len(rules) >= RESULTS_PER_RUN:
        raise ValueError(f"{len(rules)} rules; result ids have room for {RESULTS_PER_RUN - 1}")
    known = [rule.name for rule in rules]
    measures = measures.where(F.when(F.col("check_name").isin(known), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("measured, but in no catalog: "), "check_name"))
        .cast("boolean")))
    per_group = measures.groupBy(key).agg(
        F.map_from_entries(
            F.collect_list(F.struct("check_name", F.struct("rows_failed", "details")))
        ).alias("_by_check"),
        F.max("rows_checked").alias("_rows"),
    )
    catalog = F.array(*[
        F.struct(
            F.lit(i).alias("ordinal"), F.lit(r.name).alias("check_name"),
            F.lit(r.severity).alias("severity"), F.lit(r.kind).alias("kind"),
        )
        for i, r in enumerate(rules, 1)
    ])
    rows = targets.join(per_group, key, "left").select(
        "run_id", F.explode(catalog).alias("_r"), "_by_check",
        F.coalesce("_rows", F.lit(0)).alias("rows_checked"),
    )
    found = F.try_element_at("_by_check", F.col("_r.check_name"))
    no_details = F.when(F.col("_r.kind") == DOMAIN, F.lit(NO_VALUES)).when(
        F.col("_r.kind") == DUPLICATE,
        F.lit('{"duplicate_excess_rows":0,"duplicate_groups":0}'),
    )
    flat = rows.select(
        (F.col("run_id") * RESULTS_PER_RUN + F.col("_r.ordinal")).alias("quality_result_id"),
        "run_id", "_r.check_name", "_r.severity", "rows_checked",
        F.when(F.col("_by_check").isNull(), F.lit(0)).otherwise(F.coalesce(
            found["rows_failed"], F.raise_error(F.concat(
                F.lit("in the catalog, but not measured: "), F.col("_r.check_name"))).cast("bigint"),
        )).alias("rows_failed"),
        F.coalesce(found["details"], no_details).alias("details"),
    )
    at = executed_at if isinstance(executed_at, Column) else F.lit(executed_at)
    return flat.select(
        "quality_result_id", "run_id", "check_name", "severity",
        F.when(F.col("rows_failed") == 0, F.lit(PASSED)).otherwise(F.lit(VIOLATED)).alias("status"),
        "rows_checked", "rows_failed",
        rate("rows_failed", "rows_checked").alias("failure_rate"),
        "details", at.cast("timestamp").alias("executed_at"),
    )


def violation_counters(results: DataFrame) -> DataFrame:
    """Violated checks (not rows) per run and severity."""
    violated = F.col("status") == VIOLATED
    return results.groupBy("run_id").agg(
        F.count("*").cast("int").alias("check_count"),
        F.count_if(violated & (F.col("severity") == WARNING)).cast("int").alias("warning_count"),
        F.count_if(violated & (F.col("severity") == ERROR)).cast("int").alias("error_count"),
    )


def target_problems(requested: DataFrame, runs: DataFrame, sources: DataFrame) -> DataFrame:
    """Requested runs joined to their source, with the reason they cannot be checked, if any."""
    known = runs.select(
        "run_id", F.col("status").alias("_run_status"), F.col("dataset_name"), "source_file_id"
    )
    files = sources.select(
        "source_file_id", F.col("status").alias("_source_status"), "source_year", "source_month",
        "partition_key",
    )
    problem = (
        F.when(F.col("_run_status").isNull(),
               F.format_string("Unknown pipeline run ID: %d", "run_id"))
        .when(F.col("_run_status") != SUCCEEDED, F.format_string(
            "Run %d has status %s; quality requires succeeded", "run_id", "_run_status"))
        .when(~F.col("dataset_name").isin(*TRIP_CONTRACTS) | F.col("source_file_id").isNull(),
              F.format_string("Run %d is not a supported loaded trip ingestion run", "run_id"))
        .when(~F.col("_source_status").eqNullSafe(F.lit(LOADED)),
              F.format_string("Run %d does not reference a loaded source", "run_id"))
        .when(F.col("source_year").isNull() | F.col("source_month").isNull(),
              F.format_string("Run %d has no monthly source dimensions", "run_id"))
    )
    return (
        requested.join(known, "run_id", "left").join(files, "source_file_id", "left")
        .select("run_id", "dataset_name", "source_file_id", "source_year", "source_month",
                "partition_key", problem.alias("problem"))
    )


def quality_overview(results: DataFrame) -> DataFrame:
    """Headline counts of a set of results as one row."""
    violated = F.col("status") == VIOLATED
    return results.agg(
        F.count("*").alias("checks_run"),
        F.count_if(violated & (F.col("severity") == WARNING)).alias("warnings_violated"),
        F.count_if(violated & (F.col("severity") == ERROR)).alias("errors_violated"),
        F.count_if(F.col("severity") == INFO).alias("info_metrics"),
    )


def results_by_severity(results: DataFrame) -> DataFrame:
    return results.groupBy("severity").agg(F.count("*").alias("results"))


def violated_warnings(results: DataFrame) -> DataFrame:
    """Failed rows of every violated warning."""
    return results.where(
        (F.col("severity") == WARNING) & (F.col("status") == VIOLATED)
    ).select("run_id", "check_name", "rows_failed")

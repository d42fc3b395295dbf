"""Model tests: every check returns the violating rows, and an empty result passes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareledger.functions.columns import melt, side_by_side


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def not_null_many(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns that hold nulls, with their number of null rows, from one scan."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "row_count").where("row_count > 0")


def unique(df: DataFrame, column: str) -> DataFrame:
    """Repeated values; nulls are not compared."""
    return unique_key(df.where(F.col(column).isNotNull()), [column])


def unique_key(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Repeated combinations of the key columns with their row count."""
    return df.groupBy(*columns).agg(F.count("*").alias("row_count")).where("row_count > 1")


def lineage_bits(
    df: DataFrame, file: str = "source_file_id", number: str = "source_row_number"
) -> DataFrame:
    """Rows and distinct row numbers of each file, exactly.

    A row sets one bit of a 64-bit word, and words are combined where the rows are read, so one
    row in 64 is shuffled where row numbers are dense. Null row numbers count as one number.
    """
    n = F.col(number).cast("bigint")
    bit = F.expr(f"shiftleft(1L, cast(pmod(cast(`{number}` as bigint), 64L) as int))")
    words = df.groupBy(F.col(file), F.floor(n / 64).alias("_word")).agg(
        F.count("*").alias("_rows"), F.bit_or(bit).alias("_bits"))
    distinct = F.when(F.col("_word").isNull(), F.lit(1)).otherwise(F.bit_count("_bits"))
    return words.groupBy(file).agg(
        F.sum("_rows").alias("row_count"), F.sum(distinct).alias("lineage_count"))


def unique_lineage(
    df: DataFrame, file: str = "source_file_id", number: str = "source_row_number"
) -> DataFrame:
    """Files that hold a row number more than once."""
    return lineage_bits(df, file, number).where("row_count <> lineage_count")


def relationships(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Non-null child values without a parent, with the rows that carry them.

    The child collapses to distinct values before the join.
    """
    values = child.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count("*").alias("row_count")
    )
    members = parent.select(F.col(key).alias(column))
    return values.join(members, column, "left_anti")


def relationships_many(
    child: DataFrame, parents: dict[str, tuple[DataFrame, str]]
) -> DataFrame:
    """``relationships`` of several child columns, from one scan of the child."""
    cells = {column: F.col(column).cast("string") for column in parents}
    values = melt(child, [], cells, "column_name", "value").groupBy("column_name", "value").agg(
        F.count("*").alias("row_count")
    )
    members = reduce(DataFrame.unionAll, [
        parent.select(F.lit(column).alias("column_name"), F.col(key).cast("string").alias("value"))
        for column, (parent, key) in parents.items()
    ])
    return values.join(members, ["column_name", "value"], "left_anti")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Non-null values outside the list with their row count."""
    return df.where(~F.col(column).isin(*values)).groupBy(column).agg(
        F.count("*").alias("row_count")
    )


def _sizes(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias(name))


def grain_match(
    left: DataFrame, right: DataFrame, key: str, names: tuple[str, str] = ("left_rows", "right_rows")
) -> DataFrame:
    """Keys whose row counts differ between two relations, or that only one of them has."""
    both = _sizes(left, key, names[0]).join(_sizes(right, key, names[1]), key, "full_outer")
    return both.where(~F.col(names[0]).eqNullSafe(F.col(names[1])))


def grain_match_left(
    expected: DataFrame, raw: DataFrame, staging: DataFrame, key: str,
    names: tuple[str, str] = ("raw_row_count", "staging_row_count"),
) -> DataFrame:
    """Expected keys whose raw and staged counts differ; an absent count is zero."""
    raw_sizes, staged = _sizes(raw, key, names[0]), _sizes(staging, key, names[1])
    return (
        expected.select(key).join(raw_sizes, key, "left").join(staged, key, "left")
        .select(key, *[F.coalesce(n, F.lit(0)).alias(n) for n in names])
        .where(F.col(names[0]) != F.col(names[1]))
    )


def count_equal(
    left: DataFrame, right: DataFrame, names: tuple[str, str] = ("left_rows", "right_rows")
) -> DataFrame:
    """Both row counts as one row when they differ."""
    sizes = [df.agg(F.count("*").alias(n)) for df, n in zip((left, right), names)]
    return side_by_side(*sizes).where(F.col(names[0]) != F.col(names[1]))


def exactly_one(df: DataFrame, condition: Column, name: str = "row_count") -> DataFrame:
    """The number of matching rows when it is not one."""
    return df.agg(F.count_if(condition).alias(name)).where(F.col(name) != 1)


def unknown_members(dimensions: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Names of dimensions that do not hold exactly one Unknown member."""
    return reduce(DataFrame.unionAll, [
        exactly_one(df, condition).select(F.lit(name).alias("dimension_name"))
        for name, (df, condition) in dimensions.items()
    ])


def range_violations(df: DataFrame, table: str, constraints: dict[str, Column]) -> DataFrame:
    """Rows that break each CHECK condition, all conditions in one scan; null passes."""
    wide = df.agg(*[F.count_if(~condition).alias(name) for name, condition in constraints.items()])
    return wide.unpivot([], list(constraints), "constraint_name", "violations").select(
        F.lit(table).alias("table_name"), "constraint_name", "violations"
    )


def key_violations(df: DataFrame, table: str, name: str, columns: Sequence[str]) -> DataFrame:
    return unique_key(df, columns).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("violations")
    ).select(F.lit(table).alias("table_name"), F.lit(name).alias("constraint_name"), "violations")


def foreign_violations(
    df: DataFrame, table: str, name: str, column: str, parent: DataFrame, key: str
) -> DataFrame:
    return relationships(df, column, parent, key).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("violations")
    ).select(F.lit(table).alias("table_name"), F.lit(name).alias("constraint_name"), "violations")


def positive(column: str) -> Column:
    return F.col(column) > 0


def not_negative(column: str) -> Column:
    return F.col(column) >= 0


def valid_month(column: str) -> Column:
    return F.col(column).between(1, 12)


def constraint_audit(
    sources: DataFrame, runs: DataFrame, raw_tables: dict[str, DataFrame], zones: str | None = None
) -> DataFrame:
    """The stored tables against their declared constraints, one row per constraint.

    ``raw_tables`` maps table names to raw rows; ``zones`` names the one whose location ids
    are unique per file.
    """
    parts = [
        range_violations(sources, "source_files", {
            "file_size_positive": positive("file_size_bytes"),
            "row_count_nonnegative": not_negative("row_count"),
            "source_month_valid": valid_month("source_month"),
        }),
        key_violations(sources, "source_files", "pk_source_files", ["source_file_id"]),
        key_violations(sources, "source_files", "uq_partition_checksum",
                       ["partition_key", "checksum_sha256"]),
        range_violations(runs, "pipeline_runs", {
            "rows_read_nonnegative": not_negative("rows_read"),
            "rows_loaded_nonnegative": not_negative("rows_loaded"),
            "warning_count_nonnegative": not_negative("warning_count"),
            "error_count_nonnegative": not_negative("error_count"),
            "source_month_valid": valid_month("source_month"),
        }),
        key_violations(runs, "pipeline_runs", "pk_pipeline_runs", ["run_id"]),
        foreign_violations(runs, "pipeline_runs", "fk_source_file", "source_file_id",
                           sources, "source_file_id"),
    ]
    for table, raw in raw_tables.items():
        parts += [
            range_violations(raw, table, {
                "source_row_number_positive": positive("_source_row_number"),
            }),
            key_violations(raw, table, f"pk_{table}", ["_source_file_id", "_source_row_number"]),
            foreign_violations(raw, table, "fk_source_file", "_source_file_id",
                               sources, "source_file_id"),
            foreign_violations(raw, table, "fk_pipeline_run", "_pipeline_run_id", runs, "run_id"),
        ]
        if table == zones:
            parts.append(key_violations(raw, table, "uq_source_file_location",
                                        ["_source_file_id", "LocationID"]))
    return reduce(DataFrame.unionAll, parts)

"""Column statistics of the facts, kept by file and merged by the readers.

A file's facts never change once loaded, so counts, extremes and a sketch of the distinct values of each
column are written once, in a partition of the file's own. Sketches of a few kilobytes merge without
loss, so a table's distinct counts need its files' sketches and no fact. A refresh reads the partitions
of files without statistics only, and no row if there are none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareledger.plans.star import FACT_TABLE, pending, stored_files
from fareledger.sources.tables import Warehouse, write_partitions

STATISTICS_TABLE = "marts/fct_column_statistics"
KEYS = ("pickup_date_key", "dropoff_date_key", "pickup_zone_key", "dropoff_zone_key", "vendor_key", "payment_type")
TEXTS = ("service_type", "rate_code_name", "payment_type_name")
#: Binary logarithm of a sketch's buckets: the estimate's standard error is about 1.6 %.
SKETCH_BITS = 12


def _least_and_greatest(column: str, kind: str, wanted: str) -> list[Column]:
    value = F.col(column).cast(kind) if kind == wanted else F.lit(None).cast(wanted)
    return [F.min(value), F.max(value)]


def _sketched(column: str, kind: str) -> Column:
    """The value as a sketch takes it: sketches leave out the empty text, so texts get a prefix."""
    return F.concat(F.lit("="), F.col(column)) if kind == "string" else F.col(column).cast(kind)


def file_statistics(facts: DataFrame, keys: tuple[str, ...] = KEYS, texts: tuple[str, ...] = TEXTS) -> DataFrame:
    """One row for each file and column, from one pass with partial aggregates.

    Rows, nulls, extremes (numbers and texts apart) and a distinct-count sketch of the non-null values;
    a column without values has null extremes and an empty sketch.
    """
    columns = [(c, "bigint") for c in keys] + [(c, "string") for c in texts]
    fields = ("null_count", "min_key", "max_key", "min_text", "max_text", "sketch")
    aggregates = [
        value.alias(f"{field}_{column}")
        for column, kind in columns
        for field, value in zip(fields, [
            F.count_if(F.col(column).isNull()),
            *_least_and_greatest(column, kind, "bigint"), *_least_and_greatest(column, kind, "string"),
            F.hll_sketch_agg(_sketched(column, kind), SKETCH_BITS),
        ])
    ]
    by_file = facts.groupBy(F.col("source_file_id").cast("bigint").alias("source_file_id")).agg(
        F.count("*").alias("row_count"), *aggregates)
    cells = F.array(*[
        F.struct(F.lit(column).alias("column_name"), "row_count", *[F.col(f"{f}_{column}").alias(f) for f in fields])
        for column, _ in columns
    ])
    return by_file.select("source_file_id", F.inline(cells))


def refresh(warehouse: Warehouse, full_refresh: bool = False, facts: str = FACT_TABLE,
            table: str = STATISTICS_TABLE) -> DataFrame:
    """Bring the statistics up to the stored facts; a lost job is repeated by the next refresh."""
    rows = warehouse.read(facts)
    whole = full_refresh or not warehouse.exists(table)
    schema = file_statistics(rows).schema
    if not whole:
        missing = pending(stored_files(warehouse, facts).join(
            stored_files(warehouse, table), "source_file_id", "left_anti"))
        if missing.isEmpty():
            return warehouse.read(table, schema)
        rows = rows.join(missing, "source_file_id", "left_semi")
    fresh = file_statistics(rows).repartition("source_file_id")
    if whole:
        fresh.write.mode("overwrite").partitionBy("source_file_id").parquet(warehouse.path(table))
    else:
        write_partitions(fresh, warehouse.path(table), "source_file_id")
    return warehouse.read(table, schema)


def merged(statistics: DataFrame, *by: str) -> DataFrame:
    """Statistics of all files, or of the groups of files named by ``by``, for each column."""
    return statistics.groupBy(*by, "column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.min("min_key").alias("min_key"), F.max("max_key").alias("max_key"),
        F.min("min_text").alias("min_text"), F.max("max_text").alias("max_text"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"),
    )

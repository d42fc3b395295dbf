"""Scans of trip and lookup files with row-level lineage."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareledger.session import literal_table, spread
from fareledger.sources.schemas import CONTRACTS, ZONES, Contract, struct


def file_uris(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Listed paths with the spelling that ``_metadata.file_path`` gives them.

    The spelling is worked out once per file here, so scanned rows join on the reader's own
    per-file constant as it is. Local files occur with one or three slashes.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    rows = set()
    for text in paths:
        path = jvm.org.apache.hadoop.fs.Path(text)
        uri = path.getFileSystem(conf).makeQualified(path).toUri().toString()
        rows |= {(text, uri), (text, re.sub("^file:/+", "file:/", uri))}
    return literal_table(spark, sorted(rows), "path string, _file string")


def align_columns(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns of ``target`` in order and type; a column the source lacks becomes null."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.fields
    ])


def read_trips(spark: SparkSession, paths: Sequence[str] | str, contract: Contract) -> DataFrame:
    """Any number of trip files in one scan, with absent additive columns as nulls.

    Adds ``_file`` and the 1-based ``_source_row_number`` from the reader's own row index,
    which needs no shuffle and does not change with the number of tasks.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(contract.schema).parquet(*paths).select(
        *contract.names,
        F.col("_metadata.file_path").alias("_file"),
        (F.col("_metadata.row_index") + 1).alias("_source_row_number"),
    )


def zone_header(spark: SparkSession, path: str) -> list[str]:
    """Column names in the first line of a CSV file."""
    return spark.read.option("header", True).option("multiLine", True).csv(path).columns


def read_zones(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Zone CSV files by column name, with text cells kept as text; a malformed id fails.

    A quoted cell may span lines, so each file is read by one task and the running id of
    that task, less its smallest value in the file, is the row's position.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path in [paths] if isinstance(paths, str) else paths:
        by_header.setdefault(tuple(zone_header(spark, path)), []).append(path)
    parts = []
    for header, files in by_header.items():
        raw = (
            spark.read.option("header", True).option("mode", "FAILFAST")
            .option("multiLine", True).option("escape", '"').option("emptyValue", "")
            .schema(struct([(name, "string") for name in header])).csv(files)
        )
        parts.append(raw.select(
            F.col("LocationID").cast("int").alias("LocationID"),
            *[F.coalesce(name, F.lit("")).alias(name) for name in ZONES.names[1:]],
            F.col("_metadata.file_path").alias("_file"),
            F.monotonically_increasing_id().alias("_position"),
        ))
    numbered = reduce(DataFrame.unionByName, parts)
    first = numbered.groupBy("_file").agg(F.min("_position").alias("_first"))
    return numbered.join(first, "_file").select(
        *ZONES.names, "_file",
        (F.col("_position") - F.col("_first") + 1).alias("_source_row_number"),
    )


def stamp_lineage(rows: DataFrame, assignments: DataFrame, ingested_at: datetime) -> DataFrame:
    """Attach file id, run id and ingest time to rows that carry ``_file``.

    ``assignments`` has one row per file (path, source_file_id, run_id); Catalyst broadcasts
    it while it is under the threshold.
    """
    paths = [row[0] for row in assignments.select("path").collect()]
    ids = file_uris(rows.sparkSession, paths).join(assignments, "path").select(
        "_file",
        F.col("source_file_id").cast("bigint").alias("_source_file_id"),
        F.col("run_id").cast("bigint").alias("_pipeline_run_id"),
    )
    return rows.join(ids, "_file").withColumn(
        "_ingested_at", F.lit(ingested_at).cast("timestamp")
    ).drop("_file")


def read_raw(spark: SparkSession, dataset: str, assignments: DataFrame, paths: Sequence[str],
             ingested_at: datetime) -> DataFrame:
    """Source columns and lineage of the given files, in the raw table's column order."""
    contract = CONTRACTS[dataset]
    if contract is ZONES:
        stamped = stamp_lineage(read_zones(spark, paths), assignments, ingested_at)
    else:
        rows = read_trips(spark, paths, contract)
        stamped = spread(stamp_lineage(rows, assignments, ingested_at), rows)
    return align_columns(stamped, contract.raw_schema)


def empty(spark: SparkSession, fields: T.StructType | Sequence[tuple[str, str]]) -> DataFrame:
    schema = fields if isinstance(fields, T.StructType) else struct(fields)
    return spark.range(0).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    )

"""File manifests: identity, footers and schema fingerprints, one row or more per file."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareledger.session import literal_table, materialize
from fareledger.sources.contracts import validate_contract, validate_zones
from fareledger.sources.schemas import TRIP_CONTRACTS

HASH_CHUNK = 1 << 20
FILE_SCHEMA = (
    "path string, file_size_bytes bigint, checksum_sha256 string, row_count bigint, "
    "row_group_count int, column_count int, created_by string, footer_problem string"
)
FIELD_SCHEMA = (
    "path string, ordinal_position int, name string, arrow_type string, nullable boolean, "
    "physical_type string, logical_type string, max_definition_level int, "
    "max_repetition_level int"
)
SOURCE_SCHEMA = (
    "path string, dataset_name string, service_type string, source_year smallint, "
    "source_month smallint, partition_key string, source_url string, landing_path string, "
    "source_format string"
)


def _open(path: str):
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file(path)
    system, name = fs.FileSystem.from_uri(path)
    return system.open_input_file(name)


def _identity(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import hashlib

    import pyarrow as pa
    import pyarrow.parquet as pq

    for batch in batches:
        rows = []
        for path in batch["path"]:
            with _open(path) as stream:
                digest, size = hashlib.sha256(), 0
                while chunk := stream.read(HASH_CHUNK):
                    digest.update(chunk)
                    size += len(chunk)
                footer = problem = None
                if size and not path.endswith(".csv"):
                    stream.seek(0)
                    try:
                        footer = pq.ParquetFile(stream).metadata
                    except (pa.ArrowException, OSError) as error:
                        problem = f"Unreadable Parquet footer: {error}"
            rows.append((
                path, size, digest.hexdigest(),
                footer.num_rows if footer else None,
                footer.num_row_groups if footer else None,
                footer.num_columns if footer else None,
                footer.created_by if footer else None,
                problem,
            ))
        yield pd.DataFrame(rows, columns=[
            "path", "file_size_bytes", "checksum_sha256", "row_count", "row_group_count",
            "column_count", "created_by", "footer_problem",
        ]).astype({c: "Int64" for c in ("row_count", "row_group_count", "column_count")})


def _fields(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq

    for batch in batches:
        for path in batch["path"]:
            with _open(path) as stream:
                parquet = pq.ParquetFile(stream)
                leaves = {}
                for i in range(len(parquet.schema)):
                    leaf = parquet.schema.column(i)
                    leaves.setdefault(leaf.path.split(".")[0], leaf)
                rows = [
                    (
                        path, i, field.name, str(field.type), field.nullable,
                        leaves[field.name].physical_type,
                        str(leaves[field.name].logical_type),
                        leaves[field.name].max_definition_level,
                        leaves[field.name].max_repetition_level,
                    )
                    for i, field in enumerate(parquet.schema_arrow)
                ]
            yield pd.DataFrame(rows, columns=[
                "path", "ordinal_position", "name", "arrow_type", "nullable", "physical_type",
                "logical_type", "max_definition_level", "max_repetition_level",
            ])


def list_files(spark: SparkSession, folder: str | list[str], pattern: str = "*.parquet") -> DataFrame:
    """Paths below ``folder``, or a list of folders and files, listed by Spark; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path")
    )


def _spread(paths: DataFrame) -> DataFrame:
    """A few files per task. Adaptive coalescing would see only the tiny path texts."""
    most = paths.sparkSession.sparkContext.defaultParallelism * 4
    return paths.repartition(max(1, min(paths.count(), most)))


def file_identity(paths: DataFrame) -> DataFrame:
    """Size, SHA-256 and footer counts of every file in column ``path``.

    Bytes are hashed in chunks inside the tasks; no file passes through the driver.
    """
    return _spread(paths.select("path")).mapInPandas(_identity, FILE_SCHEMA)


def footer_stats(paths: DataFrame) -> DataFrame:
    """One row per file and column with its Arrow and Parquet types."""
    return _spread(paths.select("path")).mapInPandas(_fields, FIELD_SCHEMA)


def schema_fingerprint(fields: DataFrame) -> DataFrame:
    """SHA-256 of the canonical JSON description of each file's ordered columns."""
    described = F.struct("ordinal_position", "name", "arrow_type", "nullable")
    return fields.groupBy("path").agg(
        F.sha2(F.to_json(F.sort_array(F.collect_list(described))), 256).alias(
            "schema_fingerprint"
        )
    )


def source_list(spark: SparkSession, sources: Iterable[dict]) -> DataFrame:
    """The files to inspect, one per registered partition, as built by ``landing``."""
    names = [part.split()[0] for part in SOURCE_SCHEMA.split(", ")]
    return literal_table(spark, [tuple(s.get(n) for n in names) for s in sources], SOURCE_SCHEMA)


def file_manifest(sources: DataFrame) -> DataFrame:
    """Identity, structure and contract outcome of every listed source.

    ``rejection`` holds the first reason to refuse a file, or null. Every file is read once
    for its bytes and once for its footer; lookups are read as CSV for their row count.
    """
    identity = materialize(file_identity(sources))
    trips = (
        sources.where((F.col("source_format") == "parquet")
                      & F.col("dataset_name").isin(*TRIP_CONTRACTS))
        .join(identity.where("file_size_bytes > 0 AND footer_problem IS NULL"), "path", "left_semi")
        .select("path", "dataset_name")
    )
    fields = materialize(footer_stats(trips))
    checked = validate_contract(fields, trips).join(schema_fingerprint(fields), "path")
    manifest = sources.join(identity, "path").join(checked, "path", "left")
    lookups = _lookup_counts(sources.join(
        identity.where("file_size_bytes > 0"), "path", "left_semi"
    ).where(F.col("source_format") == "csv"))
    if lookups is not None:
        manifest = (
            manifest.join(lookups, "path", "left")
            .withColumn("row_count", F.coalesce("row_count", "_rows"))
            .withColumn("contract_problem", F.coalesce("contract_problem", "_problem"))
            .drop("_rows", "_problem")
        )
    parquet = F.col("source_format") == "parquet"
    rejection = (
        F.when(F.col("file_size_bytes") == 0, F.lit("Source file is empty"))
        .when(~F.col("source_format").isin("parquet", "csv"),
              F.concat(F.lit("Unsupported source format: "), "source_format"))
        .when(parquet & ~F.col("dataset_name").isin(*TRIP_CONTRACTS),
              F.concat(F.lit("Unsupported Parquet dataset: "), "dataset_name"))
        .when(parquet & F.col("footer_problem").isNotNull(), F.col("footer_problem"))
        .when(F.col("contract_problem").isNotNull(), F.col("contract_problem"))
        .when(parquet & (F.col("row_count") == 0), F.lit("Parquet source contains zero rows"))
    )
    return manifest.withColumn("rejection", rejection).drop("contract_problem", "footer_problem")


def _lookup_counts(lookups: DataFrame) -> DataFrame | None:
    """Row count and problem of each listed CSV lookup; a batch lists one or a few."""
    spark, parts = lookups.sparkSession, []
    for (path,) in lookups.select("path").collect():
        rows = spark.read.option("header", True).option("multiLine", True).csv(path)
        parts.append(validate_zones(rows, rows.columns).select(
            F.lit(path).alias("path"), F.col("row_count").alias("_rows"),
            F.col("problem").alias("_problem"),
        ))
    return reduce(DataFrame.unionAll, parts) if parts else None

"""Path-based Parquet tables and views of one warehouse folder."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fareledger.sources.readers import empty
from fareledger.sources.schemas import (
    CONTRACTS,
    QUALITY_RESULTS,
    QUALITY_VALUES,
    RUN_EVENTS,
    SOURCE_FILES,
)

RAW_TABLES = {
    "yellow_tripdata": "raw/yellow_trips",
    "green_tripdata": "raw/green_trips",
    "taxi_zone_lookup": "raw/taxi_zones",
}


def write_view(df: DataFrame, name: str) -> DataFrame:
    """A named view: staging and intermediate models are recomputed where they are used."""
    df.createOrReplaceTempView(name)
    return df


def write_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Replace exactly the partitions present in ``df``; a retry gives the same table."""
    (
        df.write.mode("overwrite")
        .partitionBy(*by)
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


class Warehouse:
    """Tables below one root folder. A missing table reads as empty with its schema."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def exists(self, table: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(table))
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    @contextmanager
    def exclusive(self, name: str, wait: float = 600.0, lease: float = 3600.0) -> Iterator[None]:
        """Hold a marker file that one writer at a time can create.

        The file system creates it only if it is not there. Another writer waits; a marker older
        than ``lease`` seconds belongs to a writer that died and is taken over.
        """
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(self.path(f"ops/_held/{name}"))
        files, until = path.getFileSystem(conf), time.monotonic() + wait

        def taken() -> bool:
            try:
                files.create(path, False).close()
                return False
            except Py4JJavaError as error:
                if not files.exists(path) and "Exist" not in error.java_exception.getClass().getName():
                    raise
                return True

        while taken():
            if time.monotonic() > until:
                raise TimeoutError(f"another writer holds {path}")
            held = files.globStatus(path)  # empty if the holder has just let go
            if held and time.time() - held[0].getModificationTime() / 1000 > lease:
                files.delete(path, False)
            time.sleep(0.2)
        try:
            yield
        finally:
            files.delete(path, False)

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        if not self.exists(table):
            if schema is None:
                raise ValueError(f"Unknown table: {table}")
            return empty(self.spark, schema)
        reader = self.spark.read
        return (reader.schema(schema) if schema is not None else reader).parquet(self.path(table))

    def write_table(self, df: DataFrame, table: str) -> DataFrame:
        """Rebuild a table in full and read it back."""
        df.write.mode("overwrite").parquet(self.path(table))
        return self.read(table, df.schema)

    def append(self, df: DataFrame, table: str) -> None:
        df.write.mode("append").parquet(self.path(table))

    def append_raw(self, df: DataFrame, dataset: str) -> None:
        """Store the rows of one or more file versions, one partition per version.

        The rows count as loaded only once the run log says so, hence a failed or repeated
        attempt is never visible.
        """
        write_partitions(df, self.path(RAW_TABLES[dataset]), "_source_file_id")

    def raw(self, dataset: str) -> DataFrame:
        return self.read(RAW_TABLES[dataset], CONTRACTS[dataset].raw_schema)

    def registrations(self) -> DataFrame:
        return self.read("ops/source_files", SOURCE_FILES)

    def run_events(self) -> DataFrame:
        return self.read("ops/run_events", RUN_EVENTS)

    def quality_results(self) -> DataFrame:
        return self.read("ops/quality_results", QUALITY_RESULTS)

    def quality_values(self) -> DataFrame:
        """Unexpected values of domain rules, one row each."""
        return self.read("ops/quality_values", QUALITY_VALUES)


def write_profile(profile: DataFrame, path: str) -> None:
    """Long-format profile as JSON lines in a fixed order.

    A profile has one row per source, column and metric; the range sort keeps it split
    over several files when there are many sources.
    """
    order = [c for c in ("source", "section", "column", "position", "metric") if c in profile.columns]
    profile.orderBy(*order).write.mode("overwrite").json(path)

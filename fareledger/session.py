"""Session settings and durable intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Runtime SQL settings every plan in this package is written for.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("fareledger")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; only a local master may fall back to a private one."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    path = tempfile.mkdtemp(prefix="fareledger-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back as a Parquet table.

    The result survives lost executors, is evaluated exactly once however often it is
    used, and gives Catalyst its true size, so a join broadcasts it only when the files
    are under the broadcast threshold and shuffles it otherwise.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_splits(spark: SparkSession, size: int = 32 << 20) -> Iterator[None]:
    """Scans run inside read at most ``size`` bytes a task, for work that holds a task's rows in memory."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    given = re.fullmatch(r"(\d+)([kmgt]?)b?", before.strip().lower())
    unit = 1024 ** " kmgt".index(given[2] or " ") if given else 1
    if not given or int(given[1]) * unit > size:
        spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """Driver-side rows as a local relation: Catalyst knows their size and may broadcast them."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(schema, timestamp_utc=True)
    columns = list(zip(*rows)) if rows else [()] * len(schema.fields)
    table = pa.table(
        [pa.array(list(values), type=field.type) for values, field in zip(columns, arrow)],
        schema=arrow,
    )
    return spark.createDataFrame(table, schema=schema)


def spread(rows: DataFrame, scan: DataFrame | None = None) -> DataFrame:
    """Deal rows over all cores when the files of their scan give fewer splits than cores.

    One row group is one task however many cores wait. Inputs of many files or row groups,
    the normal case on a cluster, are returned as they are, without a shuffle. ``scan`` is
    the plain file scan to count splits of, where ``rows`` are more than that.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    splits = (rows if scan is None else scan).rdd.getNumPartitions()
    return rows.repartition(cores) if splits < cores else rows

"""Helpers shared by the training-data operators: tables, written intermediates, batch slices."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareledger.session import shared_dir

# Rows per Arrow batch handed to Python: bounds what a worker holds next to one task's state.
ARROW_ROWS = "500"
# Text bytes worked on at once inside a batch; one longer text is one slice of its own.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, with small Arrow batches for the Python operators."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back: survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shards(df: DataFrame, rows: int, least: int = 1) -> int:
    """Number of groups that hold about ``rows`` rows each."""
    return max(least, -(-df.count() // rows))


def text_of(column: str = "text") -> Column:
    """The text column as string, null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def once(value: Column) -> Column:
    """``value``, worked out where it stands.

    The partition id counts as non-deterministic, so Catalyst neither pushes a filter below this
    column nor writes its expression into every place of a lambda that uses it.
    """
    return F.when(F.spark_partition_id() >= 0, value)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A key of a row for joining facts about its own text back to it.

    Two rows with the same key have the same id and text (or, beyond that, a colliding hash),
    so it spreads null and repeated ids instead of meeting in one task.
    """
    return F.xxhash64(F.col(doc_id), F.col(text))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of whole rows with at most ``limit`` text bytes, or one row."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    total = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def record(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A record batch of ``schema`` from arrays or lists by name."""
    return pa.RecordBatch.from_arrays(
        [v if isinstance(v, pa.Array) else pa.array(v, type=schema.field(k).type)
         for k, v in ((name, columns[name]) for name in schema.names)],
        schema=schema)

"""Exact order statistics and row numbers that never sort a whole group in one task."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fareledger.session import literal_table, materialize, shared_dir

def number_rows(df: DataFrame, *order: Column | str, name: str = "row_number") -> DataFrame:
    """Add a dense 1-based number in the total order ``order``.

    A range-partitioned sort writes the rows once; the number is the row's position in its
    part file plus the sizes of the earlier part files. Only one count per part file
    reaches the driver.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/numbered-{uuid.uuid4().hex}"
    df.orderBy(*order).write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    sizes = (
        stored.groupBy(F.col("_metadata.file_name").alias("_file"))
        .agg(F.count("*").alias("_rows"))
        .collect()
    )
    # By the number of the task: as text, part-100000 would come before part-99999.
    sizes.sort(key=lambda row: int(re.search(r"part-(\d+)", row["_file"])[1]))
    offsets, total = [], 0
    for row in sizes:
        offsets.append((row["_file"], total))
        total += row["_rows"]
    base = literal_table(spark, offsets, "_file string, _offset bigint")
    return (
        stored.select(
            "*",
            F.col("_metadata.file_name").alias("_file"),
            F.col("_metadata.row_index").alias("_index"),
        )
        .join(base, "_file")
        .withColumn(name, F.col("_offset") + F.col("_index") + 1)
        .drop("_file", "_index", "_offset")
    )


def running_counts(schema: pa.Schema, keys: Sequence[str]):
    """Adds the part's number and the running count of each group inside the part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, carried = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            first = tuple(batch.column(k)[0].as_py() for k in keys)
            starts = np.zeros(n, bool)
            starts[0] = first != last
            for key in keys:
                column = batch.column(key)
                now, before = column.slice(1), column.slice(0, n - 1)
                same = pc.or_kleene(pc.equal(now, before), pc.and_(pc.is_null(now), pc.is_null(before)))
                starts[1:] |= ~pc.fill_null(same, False).to_numpy(zero_copy_only=False)
            counts = batch.column("_n").to_numpy()
            total = np.cumsum(counts)
            at = np.flatnonzero(starts)
            base = np.concatenate([[-carried], total[at] - counts[at]])
            upto = total - base[np.cumsum(starts)]
            last, carried = tuple(batch.column(k)[n - 1].as_py() for k in keys), int(upto[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(upto)], schema=schema)
    return run


def ordered_counts(longs: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct values with their counts (_value, _n), range-partitioned in order, written once.

    ``_upto`` is the running count of a group inside its part ``_part``; parts follow the order of
    the values. Equal values are combined before any shuffle, and a group may span all parts.
    """
    counted = longs.groupBy(*keys, F.col(value).alias("_value")).agg(F.count("*").alias("_n"))
    schema = T.StructType(counted.schema.fields + [
        T.StructField("_part", T.IntegerType()), T.StructField("_upto", T.LongType())])
    ordered = counted.orderBy(*keys, "_value")
    return materialize(ordered.mapInArrow(running_counts(to_arrow_schema(schema), keys), schema))


def rank_span(percent: float, total: Column, method: str) -> tuple[Column, Column, Column]:
    """First and second rank that a percentile of ``total`` values is made of, and the second's weight."""
    if method == "linear":
        position = F.lit(float(percent)) * (total - 1)
        return F.floor(position) + 1, F.ceil(position) + 1, position - F.floor(position)
    rank = F.greatest(F.ceil(F.lit(float(percent)) * total), F.lit(1).cast("long"))
    return rank, rank, F.lit(0.0)


def ranked_values(
    longs: DataFrame, keys: Sequence[str], value: str, percents: Sequence[float], method: str = "linear"
) -> DataFrame:
    """Values and running ranks of the parts that hold a wanted rank.

    Each part's total of a group is one row; prefix sums over them (as many as there are parts)
    say where each rank lies, and only those parts are opened again. No group of values is
    sorted or gathered in one task, whatever its size.
    """
    table = ordered_counts(longs, keys, value)
    sizes = table.groupBy(*keys, "_part").agg(F.sum("_n").alias("_size"))
    by_part = Window.partitionBy(*keys).orderBy("_part")
    placed = sizes.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_at"),
        (F.sum("_size").over(by_part.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size")).alias("_before"),
        "_size", F.sum("_size").over(Window.partitionBy(*keys)).alias("_total"),
    )
    holds = F.lit(False)
    for p in percents:
        for rank in rank_span(p, F.col("_total"), method)[:2]:
            holds = holds | ((rank > F.col("_before")) & (rank <= F.col("_before") + F.col("_size")))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return table.join(placed.where(holds), [F.col("_part") == F.col("_at"), *same]).select(
        *keys, "_value", "_n", (F.col("_before") + F.col("_upto")).alias("_upto"), "_total")


def percentile_columns(percents: dict[str, float], method: str = "linear") -> list[Column]:
    """Aggregates over ``ranked_values`` that return each percentile exactly.

    ``linear`` interpolates between neighbouring ranks, ``nearest`` takes rank ceil(p*n).
    """
    out = []
    for name, p in percents.items():
        lower, upper, weight = rank_span(p, F.col("_total"), method)
        weight = F.max(weight)

        def pick(rank: Column) -> Column:
            found = (F.col("_upto") - F.col("_n") < rank) & (rank <= F.col("_upto"))
            return F.max(F.when(found, F.col("_value")))

        below, above = pick(lower), pick(upper)
        out.append(F.when(weight == 0, below).otherwise(below + (above - below) * weight).alias(name))
    return out


def exact_percentiles(
    df: DataFrame,
    value: Column | str,
    percents: dict[str, float],
    keys: Sequence[str] = (),
    method: str = "linear",
) -> DataFrame:
    """Exact percentiles per group by rank selection over ordered value counts."""
    for p in percents.values():
        if not 0 <= p <= 1:
            raise ValueError("percentile must be between 0 and 1")
    v = F.col(value) if isinstance(value, str) else value
    grouping = list(keys) or ["_all"]
    base = df if keys else df.withColumn("_all", F.lit(1))
    values = base.select(*grouping, v.cast("double").alias("_v")).where(F.col("_v").isNotNull())
    result = (
        ranked_values(values, grouping, "_v", list(percents.values()), method)
        .groupBy(*grouping)
        .agg(*percentile_columns(percents, method))
    )
    return result if keys else result.drop("_all")


def nearest_rank_percentile(
    df: DataFrame, value: Column | str, percent: float, keys: Sequence[str] = (),
    name: str = "percentile",
) -> DataFrame:
    """Smallest observed value whose rank is at least ``percent`` of its group."""
    if not 0 < percent <= 1:
        raise ValueError("percentile must be greater than 0 and at most 1")
    return exact_percentiles(df, value, {name: percent}, keys, "nearest")


def median_by(
    df: DataFrame, value: Column | str, keys: Sequence[str], name: str = "median"
) -> DataFrame:
    return exact_percentiles(df, value, {name: 0.5}, keys)

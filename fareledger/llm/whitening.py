"""Embedding whitening on the leading principal components, found by Jacobi-Davidson.

The covariance is never formed. Each distinct vector is stored once, in blocks; a product V U is one
pass in which every task adds up its blocks' centred products and only sums of dimensions x columns
meet. The eigensolver (``jacobi_davidson``) runs on the driver with matrices of that size only.

Defined results: rows with a null vector, a null or non-finite component, or another length than the
commonest take no part; repeats of a vector weigh once in the fit and each get their rows; a vector of
one dimension has one component. A component without variance (equal vectors, or fewer than components)
gives whitened 0 and explained 0 and is left out of ``identity_error``. ``deviation`` is null where it
exceeds a long. A table without usable vectors gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareledger.llm.common import stored
from fareledger.llm.jacobi_davidson import largest
from fareledger.llm.vectors import matrix, usable

COMPONENTS = 4
BLOCK = 4096  # vectors of a stored block
#: An eigenvalue below this share of the largest counts as no variance.
FLAT = 1e-13
LONG = 2**63


def packer(dim: int):
    """Vectors to blocks of little-endian longs."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(matrix(batch.column("x"), dim))
                n += batch.num_rows
            if n >= BLOCK:
                yield pa.record_batch({"block": [np.concatenate(held).tobytes()]})
                held, n = [], 0
        if n:
            yield pa.record_batch({"block": [np.concatenate(held).tobytes()]})
    return pack


def blocks_of(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for block in batch.column("block"):
            yield np.frombuffer(block.as_buffer(), "<i8").reshape(-1, dim)


def totals(blocks: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of vectors and their sum in each dimension, exactly."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * dim
        for x in blocks_of(batches, dim):
            n += len(x)
            # Halves of 32 bits, so no sum of a block leaves a long.
            high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
            sums = [s + (h << 32) + rest for s, h, rest in zip(sums, high, low)]
        if n:
            yield pa.record_batch({"cell": pa.array(range(dim + 1), pa.int32()),
                                   "value": pa.array([Decimal(v) for v in (n, *sums)], pa.decimal128(38, 0))})
    rows = blocks.mapInArrow(add, "cell int, value decimal(38,0)").groupBy("cell").agg(
        F.sum("value").cast("decimal(38,0)").alias("value")).collect()
    found = {r["cell"]: int(r["value"]) for r in rows}
    return found.get(0, 0), [found.get(k + 1, 0) for k in range(dim)]


def summed(blocks: DataFrame, dim: int, shape: tuple[int, int], part) -> np.ndarray:
    """The sum over all blocks of ``part(block)``; only ``shape`` sums of each task are shuffled."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(shape)
        for x in blocks_of(batches, dim):
            out += part(x)
        yield pa.record_batch({"cell": pa.array(range(out.size), pa.int32()), "value": out.ravel()})
    rows = blocks.mapInArrow(add, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    out = np.zeros(shape[0] * shape[1])
    for cell, value in rows.collect():
        out[cell] = value
    return out.reshape(shape)


class Covariance:
    """Products with the covariance (divisor n) of the blocks' vectors."""

    def __init__(self, blocks: DataFrame, dim: int, n: int, sums: list[int]) -> None:
        self.blocks, self.dim, self.n = blocks, dim, n
        self.mean = np.array([s / n for s in sums])
        self.passes = 0

    def times(self, columns: np.ndarray) -> np.ndarray:
        mean = self.mean
        self.passes += 1

        def part(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ columns)
        return summed(self.blocks, self.dim, columns.shape, part) / self.n

    def trace(self) -> float:
        mean = self.mean
        return float(summed(self.blocks, self.dim, (1, 1), lambda x: ((x - mean)**2).sum().reshape(1, 1))[0, 0]) / self.n

    def along(self, columns: np.ndarray) -> np.ndarray:
        """Covariance of the vectors' projections on ``columns``."""
        mean, k = self.mean, columns.shape[1]

        def part(x: np.ndarray) -> np.ndarray:
            w = (x - mean) @ columns
            return np.vstack([w.T @ w, w.sum(axis=0)])
        both = summed(self.blocks, self.dim, (k + 1, k), part) / self.n
        return both[:k] - np.outer(both[k], both[k])


def deviations(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list[int | None]]:
    """(n x - S) / n as doubles, and the sum of squares of n x - S as whole numbers."""
    top = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n + max(map(abs, sums), default=0)
    if top * top * max(1, x.shape[1]) < LONG:
        off = x * n - np.array(sums, np.int64)
        return off / n, (off * off).sum(axis=1).tolist()
    off = x.astype(object) * n - np.array(sums, object)
    squares = [int(s) for s in (off * off).sum(axis=1)]
    return (off / n).astype(np.float64), [s if s < LONG else None for s in squares]


OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
       "identity_error double")


def whitener(dim: int, n: int, sums: list[int], columns: np.ndarray, explained: list[float], error: float):
    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = columns.shape[1]
        for batch in batches:
            rows = batch.num_rows
            if rows:
                centred, square = deviations(matrix(batch.column("x"), dim), n, sums)
                repeat = pa.array(np.repeat(np.arange(rows), k))
                yield pa.record_batch({
                    "vec_id": batch.column("vec_id").take(repeat),
                    "component": pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                    "n": pa.array(np.full(rows * k, n)),
                    "deviation": pa.array(square, pa.int64()).take(repeat),
                    "whitened": (centred @ columns).ravel(),
                    "explained": np.tile(np.array(explained), rows),
                    "identity_error": np.full(rows * k, error)})
    return whiten


def whitening(embeddings: DataFrame, count: int = COMPONENTS) -> DataFrame:
    """One row per usable row of ``embeddings`` (vec_id, embedding) and component."""
    rows, dim = usable(embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"))
    rows = stored(rows.select("vec_id", "x"))
    # Equal vectors are combined in the task that reads them, before any shuffle.
    blocks = stored(rows.select("x").distinct().mapInArrow(packer(dim), "block binary"))
    n, sums = totals(blocks, dim)
    if not n:
        return rows.select("vec_id").where("false").selectExpr(
            *[f"cast(null as {kind}) as {name}" if name != "vec_id" else name
              for name, kind in (c.split() for c in OUT.split(", "))])
    covariance = Covariance(blocks, dim, n, sums)
    trace = covariance.trace()
    values, vectors = largest(covariance.times, dim, count)
    some = values > FLAT * max(trace, np.finfo(np.float64).tiny)
    columns = np.where(some, vectors / np.sqrt(np.where(some, values, 1)), 0.0)
    error = 0.0
    if some.any():
        own = covariance.along(columns[:, some])
        error = float(np.abs(own - np.eye(len(own))).max())
    explained = [float(v / trace) if s else 0.0 for v, s in zip(values, some)]
    return rows.mapInArrow(whitener(dim, n, sums, columns, explained, error), OUT)

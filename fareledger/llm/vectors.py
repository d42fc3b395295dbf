"""Embedding rows as vectors of whole numbers, for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256


def finite(vector: str = "embedding") -> Column:
    """True where the vector is there and all its entries are finite numbers."""
    ok = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce(ok, F.lit(False))


def whole_numbers(vector: str = "embedding") -> Column:
    """``floor(256 * c)`` of each entry, as long; entries beyond a long's range end at its bounds."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long"))


def usable(embeddings: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """Rows with a finite vector, with ``x`` beside them, and the number of dimensions.

    Vectors of different lengths have no product, so the commonest length (the longest of those
    that are equally common) is the table's, and rows of another length take no part.
    """
    rows = embeddings.where(finite(vector)).withColumn("x", whole_numbers(vector))
    lengths = rows.groupBy(F.size(vector).alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    best = lengths.orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    dim = best[0]["dim"] if best else 0
    return rows.where(F.size(vector) == dim), dim


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column of one length as rows of int64."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)

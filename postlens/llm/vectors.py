"""Vectors of whole numbers, as the vector operators compute with them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Doubles hold every whole number up to here.
EXACT = 1 << 53


def is_finite(vector: str | Column) -> Column:
    """True for vectors without null or non-finite entries; false for a null vector."""
    every = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(every, F.lit(False))


def whole(vector: str | Column, scale: float) -> Column:
    """``floor(scale * entry)`` of every entry, as long."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def padded(vectors: DataFrame, col: str) -> tuple[DataFrame, int]:
    """(``vectors`` with zeros after the shorter ones, length of the longest)."""
    width = vectors.agg(F.max(F.size(col))).first()[0] or 0
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size(col))
    return vectors.withColumn(col, F.concat(F.col(col), zeros)), width


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a column of padded vectors."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def largest(values: np.ndarray) -> int:
    return max(abs(int(values.max())), abs(int(values.min()))) if values.size else 0


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` with the rows of ``b``, whole numbers as long."""
    if largest(a) * largest(b) * max(a.shape[1], 1) < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    # Beyond a long, this fails rather than wraps.
    return (a.astype(object) @ b.astype(object).T).astype(np.int64)

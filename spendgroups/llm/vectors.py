"""Embedding columns: which vectors count, and how tasks read them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str = "embedding") -> Column:
    """Whether a vector is there, has only finite components and is not zero."""
    x = F.col(vector)
    finite = F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    )
    return F.coalesce(finite & F.exists(x, lambda c: c != 0), F.lit(False))


def commonest_length(vectors: DataFrame, vector: str = "embedding") -> int:
    """The number of components that most vectors have; of equals the smallest, 0 if none."""
    lengths = vectors.groupBy(F.size(vector).alias("d")).count()
    first = lengths.orderBy(F.desc("count"), "d").first()
    return 0 if first is None else int(first["d"])


def matrix(column: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    """Rows of an array column without NULLs as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, added up in the order of the components, so that equal
    vectors have equal results wherever they stand."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        total += a[:, k] * b[:, k]
    return total

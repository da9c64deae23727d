"""What the vector operators share: the rows that take part, and matrices of their batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def finite(vector: Column) -> Column:
    """The vector is no null and holds neither nulls nor non-finite components."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, number)


def usable(df: DataFrame, vector_col: str = "embedding") -> DataFrame:
    return df.where(finite(F.col(f"`{vector_col}`")))


def by_length(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and their vectors as a matrix of doubles, for each length that occurs in the batch."""
    vectors = batch.column(column)
    ends = vectors.offsets.to_numpy()
    sizes = np.diff(ends)
    flat = vectors.values.to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, flat[ends[rows][:, None] + np.arange(size)].astype(np.float64)

"""What the two vector operators share: valid vectors as numpy blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid(vector: Column) -> Column:
    """Not null, not empty, not zero, without null or non-finite components."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~wrong & F.exists(vector, lambda x: x != 0), F.lit(False))


def valid_rows(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) with vector as array<double>, of the rows that take part. All have to have one length."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), vector.alias("vector"))
    return rows.filter(F.col("id").isNotNull() & valid(F.col("vector")))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column as the rows of a matrix."""
    if not len(column):
        return np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, first by their largest component, so that no square overflows or vanishes."""
    if not x.size:
        return x
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def spread_out(x: np.ndarray, limit: int, similarity: float) -> np.ndarray:
    """Rows of unit vectors picked one by one unless nearer than ``similarity`` to one picked before."""
    picked = np.zeros((0, x.shape[1] if x.ndim == 2 else 0))
    for at in range(0, len(x), 256):
        for row in x[at : at + 256]:
            if len(picked) == limit:
                return picked
            if not len(picked) or (picked @ row).max() < similarity:
                picked = np.vstack([picked, row])
    return picked

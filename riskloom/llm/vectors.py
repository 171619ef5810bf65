"""What vector operators share: which rows take part, and equal rows as one class."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(column: str) -> Column:
    """Not NULL, not empty, without NULL or non-finite components, not zero."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(column, lambda x: x != 0)
    return F.coalesce(F.col(column).isNotNull() & ~bad & some, F.lit(False))


def with_class(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add `k1` and `k2`, together 128 bits of a hash of the columns; equal for equal values."""
    return df.withColumn("k1", F.xxhash64(F.lit(1), *columns)).withColumn("k2", F.xxhash64(F.lit(2), *columns))


def matrix_of(rows) -> np.ndarray:
    return np.array([np.asarray(v, dtype=np.float64) for v in rows])


def norms(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scale, length) with lengths of scale * length; neither the largest nor the smallest numbers overflow in between."""
    scale = np.abs(matrix).max(1)
    scaled = matrix / scale[:, None]
    return scale, np.sqrt((scaled * scaled).sum(1))


def unit(matrix: np.ndarray) -> np.ndarray:
    """Vectors of length 1 in the same directions. A row's components are first divided by the largest of them."""
    scale, length = norms(matrix)
    return matrix / scale[:, None] / length[:, None]

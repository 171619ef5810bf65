"""Quantiles that merge: one sketch per group and column, from one pass over a table or over each batch of a stream.

A sketch of size k answers a share within `rank_error(k)` of the rank asked for, with 99 % confidence. Sketches of parts
merge into that of the whole with the same bound, and their size does not grow with the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.nulls import nan_to_null

SIZE = 1000


def rank_error(k: int = SIZE) -> float:
    """How far, as a share of all rows, the rank of an answer may lie from the rank asked for."""
    return 2.296 / k**0.9723  # fixed values of the library's bound for single quantiles


def quantile_cells(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: int = SIZE) -> DataFrame:
    """(*by, column, n, least, most, sketch): NULL and NaN left out, groups without values have none."""
    values = df.select(*by, *[nan_to_null(F.col(c).cast("double")).alias(c) for c in columns])
    long = values.unpivot(list(by), list(columns), "column", "value").where(F.col("value").isNotNull())
    return long.groupBy(*by, "column").agg(
        F.count("*").alias("n"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
        F.kll_sketch_agg_double("value", k).alias("sketch"),
    )


def merge_cells(cells: DataFrame, by: Sequence[str] = (), k: int = SIZE) -> DataFrame:
    """Cells of batches or of finer groups, added up."""
    return cells.groupBy(*by, "column").agg(
        F.sum("n").alias("n"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.kll_merge_agg_double("sketch", k).alias("sketch"),
    )


def quantile(share: float) -> Column:
    """The value at a share of a cell's rows."""
    return F.kll_sketch_get_quantile_double("sketch", F.lit(float(share)))


def box_cells(cells: DataFrame) -> DataFrame:
    """Cells as box plots: (..., n, least, q1, median, q3, most, low_limit, high_limit)."""
    shares = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    found = cells.withColumns({name: quantile(share) for name, share in shares.items()}).drop("sketch")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    return found.withColumns({"low_limit": F.col("q1") - reach, "high_limit": F.col("q3") + reach})

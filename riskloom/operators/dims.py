"""Small dimension tables and the joins that use them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def local_table(spark: SparkSession, schema: str | T.StructType, rows: Sequence[Sequence]) -> DataFrame:
    """A literal table; its size is known to the planner, which broadcasts it by itself."""
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = [pa.array([row[i] for row in rows]) for i in range(len(struct))]
    return spark.createDataFrame(pa.table(columns, struct.names), struct)


def members(spark: SparkSession, column: str, values: Sequence[str], rank: str = "rank") -> DataFrame:
    """Dimension of ordered members: (column, rank)."""
    return local_table(spark, f"{column} string, {rank} int", [(v, i) for i, v in enumerate(values)])


def complete(df: DataFrame, dim: DataFrame, on: str | list[str], fill: Mapping[str, object]) -> DataFrame:
    """Every member of `dim`, with `fill` where the grouped result has no row for it."""
    return dim.join(df, on, "left").fillna(dict(fill))


def absent(df: DataFrame, dim: DataFrame, on: str | list[str]) -> DataFrame:
    """Members of `dim` that the grouped result lacks."""
    return dim.join(df, on, "left_anti")


def add_absent(df: DataFrame, dim: DataFrame, on: str, fill: Mapping[str, object]) -> DataFrame:
    """Append one filled row per member that the grouped result lacks.

    Filled rows are offered for every member and give way to the result's own row, so the
    result is computed once and not a second time to find out what it lacks.
    """
    others = [c for c in df.columns if c != on]
    filled = dim.select(on, *[F.lit(fill.get(c)).cast(df.schema[c].dataType).alias(c) for c in others])
    offered = df.withColumn("_own", F.lit(1)).unionByName(filled.withColumn("_own", F.lit(0)))
    kept = offered.groupBy(on).agg(F.max(F.struct("_own", *others)).alias("_row"))
    return kept.select(on, *[F.col(f"_row.{c}").alias(c) for c in others])


def with_order(df: DataFrame, order: DataFrame, on: str) -> DataFrame:
    """Look up each value's rank (or any other attribute) in a dimension."""
    return df.join(order, on, "left")

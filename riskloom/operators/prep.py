"""Batch preparation: missing values, outliers, required columns, positional attach."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.bands import first_match
from riskloom.functions.nulls import count_if, is_missing, nan_to_null
from riskloom.operators.ranges import exact_quantiles, number_rows


def table_size(df: DataFrame) -> DataFrame:
    """One row: n_rows, n_cols."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def missing_counts(df: DataFrame) -> DataFrame:
    """(column, missing) for every column, counted in one pass."""
    counts = df.agg(*[count_if(is_missing(f)).alias(f.name) for f in df.schema])
    return counts.unpivot([], df.columns, "column", "missing")


def column_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n): the most frequent non-NULL value, the smallest one on a tie.

    Counting by (column, value) combines map-side, so a frequent value is no hot spot.
    """
    long = df.select([F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    counts = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))
    # min over (-n, value): most frequent first, then smallest.
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("value"), F.col("n")))
    return counts.groupBy("column").agg(best.alias("best")).select("column", "best.value", "best.n")


def column_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row of means, NaN left out."""
    return df.agg(*[F.avg(nan_to_null(F.col(c).cast("double"))).alias(c) for c in columns])


def impute(
    df: DataFrame, categorical: Sequence[str] = (), numeric: Sequence[str] = ()
) -> DataFrame:
    """Fill the columns that miss values: categories with their mode, numbers with their mean.

    Numeric columns become double whether or not a value is missing, so the type never depends on the data;
    a column without any value stays empty. The statistics are one value per column.
    """
    stats = df.agg(
        *[count_if(is_missing(_field(df, c))).alias(f"missing_{c}") for c in (*categorical, *numeric)],
        *[F.avg(nan_to_null(F.col(c).cast("double"))).alias(f"mean_{c}") for c in numeric],
    ).first()
    fill: dict[str, object] = {c: stats[f"mean_{c}"] for c in numeric}
    gappy = [c for c in categorical if stats[f"missing_{c}"]]
    if gappy:
        fill.update((r["column"], r["value"]) for r in column_modes(df, gappy).collect())
    filled = {c: _fill(_field(df, c), value) for c, value in fill.items() if value is not None}
    empty = {c: F.col(c).cast("double") for c in numeric if fill[c] is None}
    return df.withColumns({**filled, **empty}) if filled or empty else df


def _field(df: DataFrame, name: str) -> T.StructField:
    return next(f for f in df.schema if f.name.lower() == name.lower())


def _fill(field: T.StructField, value: object) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        column = nan_to_null(column)
    target = "double" if isinstance(value, float) else field.dataType
    return F.coalesce(column.cast(target), F.lit(value).cast(target))


def iqr_bounds(
    df: DataFrame,
    columns: Sequence[str],
    k: float = 1.5,
    exact: bool = False,
    relative_error: float = 0.05,
) -> DataFrame:
    """(column, q1, q3, lower, upper) with bounds k interquartile ranges outside the quartiles.

    The default reads one tree-aggregated sketch per column set in a single job.
    """
    if exact:
        quartiles = exact_quantiles(df, columns, (0.25, 0.75))
        wide = quartiles.groupBy("column").agg(
            F.max(F.when(F.col("share") == 0.25, F.col("value"))).alias("q1"),
            F.max(F.when(F.col("share") == 0.75, F.col("value"))).alias("q3"),
        )
    else:
        cleaned = df.select([nan_to_null(F.col(c).cast("double")).alias(c) for c in columns])
        found = cleaned.approxQuantile(list(columns), [0.25, 0.75], relative_error)
        rows = [(c, *q) for c, q in zip(columns, found, strict=True) if q]
        wide = df.sparkSession.createDataFrame(rows, "column string, q1 double, q3 double")
    margin = k * (F.col("q3") - F.col("q1"))
    return wide.withColumns({"lower": F.col("q1") - margin, "upper": F.col("q3") + margin})


def clip(value: Column, lower: float, upper: float) -> Column:
    """Value limited to the bounds; NULL stays NULL."""
    return first_match([(value < lower, F.lit(lower)), (value > upper, F.lit(upper))], value)


def iqr_clip(
    df: DataFrame,
    columns: Sequence[str],
    k: float = 1.5,
    exact: bool = False,
    relative_error: float = 0.05,
) -> DataFrame:
    """Pull outliers of each column onto its interquartile bounds; NaN becomes NULL."""
    bounds = iqr_bounds(df, columns, k, exact, relative_error).collect()  # one row per column
    return df.withColumns(
        {b["column"]: clip(nan_to_null(F.col(b["column"]).cast("double")), b["lower"], b["upper"]) for b in bounds}
    )


def ensure_columns(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Add the columns that are absent, filled with their default."""
    present = {c.lower() for c in df.columns}
    added = {c: F.lit(v) for c, v in defaults.items() if c.lower() not in present}
    return df.withColumns(added) if added else df


def attach_by_position(
    left: DataFrame,
    right: DataFrame,
    columns: Sequence[str],
    left_order: str,
    right_order: str,
) -> DataFrame:
    """Attach `columns` of the row at the same position of `right`, NULL past its end.

    Only columns that `left` lacks, or holds no value in, are attached. Positions come from
    an explicit unique order column on each side.
    """
    present = [c for c in columns if c in left.columns]
    values = left.agg(*[F.count(c).alias(c) for c in present]).first() if present else {}
    needed = [c for c in columns if c not in present or values[c] == 0]
    if not needed:
        return left
    numbered = number_rows(left.drop(*needed), left_order, "_position")
    source = number_rows(right.select(right_order, *[c for c in needed if c != right_order]), right_order, "_position")
    return numbered.join(source.select("_position", *needed), "_position", "left").drop("_position")


def zscore(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns standardised to mean 0 and sample deviation 1; a constant column becomes 0."""
    stats = df.agg(
        *[F.avg(nan_to_null(F.col(c).cast("double"))).alias(f"{c}_mean") for c in columns],
        *[F.stddev_samp(nan_to_null(F.col(c).cast("double"))).alias(f"{c}_sd") for c in columns],
    ).first()
    return df.withColumns({c: _scaled(F.col(c), stats[f"{c}_mean"], stats[f"{c}_sd"]) for c in columns})


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns scaled to 0..1; a constant column becomes 0."""
    stats = df.agg(
        *[F.min(nan_to_null(F.col(c).cast("double"))).alias(f"{c}_min") for c in columns],
        *[F.max(nan_to_null(F.col(c).cast("double"))).alias(f"{c}_max") for c in columns],
    ).first()
    spread = {c: None if stats[f"{c}_min"] is None else stats[f"{c}_max"] - stats[f"{c}_min"] for c in columns}
    return df.withColumns({c: _scaled(F.col(c), stats[f"{c}_min"], spread[c]) for c in columns})


def _scaled(value: Column, origin: float | None, unit: float | None) -> Column:
    value = nan_to_null(value.cast("double"))
    if origin is None or not unit:
        return F.when(value.isNotNull(), F.lit(0.0))
    return (value - origin) / unit


def with_position_share(df: DataFrame, part: str, row: str, order: str, out: str) -> DataFrame:
    """Middle of each stacked segment: shares before it in its row plus half of its own."""
    before = Window.partitionBy(row).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.coalesce(F.sum(part).over(before), F.lit(0.0)) + F.col(part) / 2)

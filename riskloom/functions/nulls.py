"""Null-safe building blocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def is_missing(field: T.StructField) -> Column:
    """NULL, or NaN where the type can hold it."""
    value = F.col(field.name)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 when the denominator is 0 or NULL."""
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def same(left: Column, right: Column) -> Column:
    """Equality flag that is False, not NULL, when a side is NULL."""
    return F.coalesce(left == right, F.lit(False))


def count_if(condition: Column) -> Column:
    return F.coalesce(F.sum(condition.cast("long")), F.lit(0).cast("long"))


def integral(value: Column) -> Column:
    """Integer from a double that holds a whole number (JSON `0.0`), else NULL."""
    return F.when(value == F.floor(value), value.try_cast("int"))

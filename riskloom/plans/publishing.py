"""Prepared rows back to messages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from riskloom.operators.prep import attach_by_position, ensure_columns
from riskloom.schema import CATEGORICAL, REQUIRED_DEFAULTS
from riskloom.sinks.kafka import to_messages
from riskloom.sources.files import read_csv_or


def message_rows(
    prepared: DataFrame,
    original: DataFrame | None = None,
    order: tuple[str, str] | None = None,
) -> DataFrame:
    """Prepared rows with every field a message needs.

    The categories come from the row at the same position of the original table, when it and
    the order column of each side are given; fields still absent get their default.
    """
    rows = prepared
    if original is not None and order is not None:
        found = [c for c in CATEGORICAL if c in original.columns]
        rows = attach_by_position(rows, original, found, *order)
    return ensure_columns(rows, REQUIRED_DEFAULTS)


def publish(
    spark: SparkSession,
    paths: Sequence[str],
    key: str,
    send: Callable[[DataFrame], None],
    schema: T.StructType | str | None = None,
    stamp: Column | None = None,
    original: DataFrame | None = None,
    order: tuple[str, str] | None = None,
) -> DataFrame:
    """Read the first existing CSV of `paths`, encode its rows and hand the messages to `send`.

    With `original` and `order` the categories come from the original table, as in `message_rows`.
    """
    rows = message_rows(read_csv_or(spark, paths, schema), original, order)
    messages = to_messages(rows, key, stamp)
    send(messages)
    return messages

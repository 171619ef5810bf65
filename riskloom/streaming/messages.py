"""JSON messages to typed rows, and tables replayed as messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.nulls import integral, nan_to_null
from riskloom.schema import EVENT_SCHEMA
from riskloom.sinks.files import write_parquet

CORRUPT = "_corrupt_record"


def parse_messages(
    messages: DataFrame,
    schema: T.StructType = EVENT_SCHEMA,
    value: str = "value",
    keep: tuple[str, ...] = (),
    keep_corrupt: bool = False,
) -> DataFrame:
    """Flat typed rows from a JSON column; a bad field is NULL, junk is an all-NULL row.

    Whole-number fields are read as doubles first, so `0.0` is 0 and not NULL.
    With `keep_corrupt` the text of messages that do not parse is in `_corrupt_record`.
    """
    wide = T.StructType([T.StructField(f.name, _json_type(f.dataType)) for f in schema])
    if keep_corrupt:
        wide = wide.add(CORRUPT, T.StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    data = F.from_json(F.col(value).cast("string"), wide, options)
    flat = messages.select(*keep, data.alias("data")).select(*keep, "data.*")
    return flat.withColumns({f.name: _typed(f) for f in schema})


def _json_type(data_type: T.DataType) -> T.DataType:
    return T.DoubleType() if isinstance(data_type, (T.IntegerType, T.LongType)) else data_type


def _typed(field: T.StructField) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, T.IntegerType):
        return integral(value)
    if isinstance(field.dataType, T.LongType):
        return F.when(value == F.floor(value), value.try_cast("long"))
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return nan_to_null(value)
    return value


def stamped(events: DataFrame, now: Column | None = None) -> DataFrame:
    """Add the scoring time, and the event's own time next to it."""
    return events.withColumns(
        {
            "processing_time": F.current_timestamp() if now is None else now,
            "event_time": F.timestamp_seconds("timestamp"),
        }
    )


def replay(messages: DataFrame, path: str, files: int | None = None) -> None:
    """Write messages as files that `read_file_stream` plays back, one file or more per batch."""
    write_parquet(messages, path, mode="append", files=files)

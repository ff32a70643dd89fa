"""Conversions that never fail a row: text to number, JSON to struct, text to time."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, LongType, StringType, StructType

# Fixed value: seconds from 1970 to the start of the trace, 2019-01-01 00:00:00 UTC.
TRACE_START = 1546300800


def safe_double(text: Column) -> Column:
    """Number or null. The JVM also reads '1d', '1f' and hexadecimal, which are refused here."""
    last = F.lower(F.right(F.trim(text), F.lit(1)))
    word = F.lower(text).contains("inf")
    jvm_only = (last.isin("d", "f") & ~word) | F.lower(text).contains("x")
    return F.when(~jvm_only, text.try_cast("double"))


def convert_text(text: Column, kind: DataType, on_error: str = "default") -> Column:
    """Typed value of a text field.

    ``default`` turns what cannot be converted into 0, 0.0 or ''; ``null`` leaves it null.
    A long is the whole part of the number, so '12.9' is 12.
    """
    if isinstance(kind, LongType):
        value, default = safe_double(text).try_cast("bigint"), F.lit(0).cast("bigint")
    elif isinstance(kind, DoubleType):
        value, default = safe_double(text), F.lit(0.0)
    elif isinstance(kind, StringType):
        value, default = text, F.lit("")
    else:
        return text.try_cast(kind)
    return F.coalesce(value, default) if on_error == "default" else value


def decode_text(value: Column) -> Column:
    return value.cast("string")


def parse_json(df: DataFrame, column: str, schema: StructType, keep: list[str] | None = None) -> DataFrame:
    """Fields of a JSON text column as columns; what does not fit the schema is null."""
    parsed = F.from_json(decode_text(F.col(column)), schema)
    kept = [F.col(c) for c in keep or []]
    return df.select(*kept, parsed.alias("data")).select(*kept, "data.*")


def shift_epoch(seconds: Column, offset: int = TRACE_START) -> Column:
    return seconds + F.lit(offset)


def epoch_to_time(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def text_to_time(text: Column) -> Column:
    """Null for text that is not a time."""
    return F.try_to_timestamp(text)


def time_to_text(time: Column) -> Column:
    return time.cast("string")


def event_time_or_arrival(event_time: Column, arrival: Column) -> Column:
    """Falls back on the arrival time when a record carries no time of its own."""
    return F.coalesce(event_time, arrival)


def to_message(df: DataFrame, key: str) -> DataFrame:
    """One ``key`` and JSON ``value`` per row."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def utc_time(moment: datetime) -> Column:
    """A point in time as a literal. Without a zone it is UTC, whatever zone the driver's clock has."""
    return F.lit(moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc))

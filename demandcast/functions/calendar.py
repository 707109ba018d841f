"""Calendar expressions: parse, ISO week start, ISO week number, month.

All of them work on ``timestamp_ntz`` / ``date`` so the result does not
depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_timestamp_ntz(c: Column, dtype: T.DataType, fmt: str | None = None) -> Column:
    """Bring a transaction-date column of any supported type to timestamp_ntz.

    Text is parsed (malformed text raises under ANSI mode); dates and
    timestamps are cast.
    """
    if isinstance(dtype, T.StringType):
        return F.to_timestamp_ntz(c, F.lit(fmt)) if fmt else F.to_timestamp_ntz(c)
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, (T.DateType, T.TimestampType)):
        return c.cast("timestamp_ntz")
    raise TypeError(f"unsupported date column type: {dtype.simpleString()}")


def require_not_null(c: Column, message: str) -> Column:
    """Pass ``c`` through; fail the job when a row has null (checked in-plan)."""
    return F.when(c.isNull(), F.raise_error(F.lit(message))).otherwise(c)


def week_start(ts: Column) -> Column:
    """Monday 00:00 of the ISO week containing ``ts`` (timestamp_ntz)."""
    return F.trunc(F.to_date(ts), "week").cast("timestamp_ntz")


def iso_week(ts: Column) -> Column:
    """ISO-8601 week number (1..53) as bigint."""
    return F.weekofyear(ts).cast("bigint")


def month_of(ts: Column) -> Column:
    return F.month(ts).cast("bigint")

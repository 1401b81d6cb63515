"""Date and time helpers. They assume a UTC session (see ``configure``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F, types as T

DAY_PATTERN = "yyyy-MM-dd"


def parse_utc(value: Column, dtype: T.DataType, lenient: bool = False) -> Column:
    """Text to timestamp (offsets honoured); timestamps pass through."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return value
    return F.try_to_timestamp(value) if lenient else F.to_timestamp(value)


def parse_to_minute(value: Column, dtype: T.DataType, lenient: bool = False) -> Column:
    return F.date_trunc("minute", parse_utc(value, dtype, lenient))


def epoch_to_minute(seconds: Column, dtype: T.DataType) -> Column:
    """UNIX seconds to a timestamp without seconds; NULL and NaN stay missing."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc("minute", seconds)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        seconds = F.when(~F.isnan(seconds), seconds)
    return F.date_trunc("minute", F.timestamp_seconds(seconds))


def day_text(value: Column) -> Column:
    return F.date_format(value, DAY_PATTERN)


def utc_midnight(value: Column) -> Column:
    """Text or date to the timestamp at the start of that day."""
    return F.to_timestamp(value)


def run_day(as_of: Column | str | dt.date) -> Column:
    """The day a run processes: the one before ``as_of``."""
    if isinstance(as_of, dt.datetime):
        as_of = as_of.date()
    if isinstance(as_of, (str, dt.date)):
        as_of = F.lit(str(as_of))
    return F.date_sub(as_of.cast("date"), 1)

"""Date columns of match tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from matchlake.functions import (
    day_text,
    epoch_to_minute,
    parse_to_minute,
    parse_utc,
    quoted,
    run_day,
    utc_midnight,
)


def event_date_derive(df: DataFrame, lenient: bool = False) -> DataFrame:
    """Add ``event_date`` from the kick-off, which is itself turned into a timestamp.

    The raw name ``fixture.date`` wins over the cleaned ``fixture_date``; a frame
    with neither comes back unchanged.
    """
    for name in ("fixture.date", "fixture_date"):
        if name in df.columns:
            kickoff = parse_utc(quoted(name), df.schema[name].dataType, lenient)
            return df.withColumn(name, kickoff).withColumn("event_date", F.to_date(quoted(name)))
    return df


def parse_ts_minute(df: DataFrame, column: str = "fixture_date", lenient: bool = False) -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumn(column, parse_to_minute(quoted(column), df.schema[column].dataType, lenient))


def epoch_ts_minute(
    df: DataFrame,
    columns: tuple[str, ...] = ("fixture_periods_first", "fixture_periods_second"),
) -> DataFrame:
    return df.withColumns(
        {c: epoch_to_minute(quoted(c), df.schema[c].dataType) for c in columns if c in df.columns}
    )


def date_to_string(df: DataFrame, column: str = "event_date") -> DataFrame:
    return df.withColumn(column, day_text(quoted(column)))


def event_date_utc(df: DataFrame, column: str = "event_date") -> DataFrame:
    """Day text or date to midnight UTC, if the column is there."""
    if column not in df.columns:
        return df
    return df.withColumn(column, utc_midnight(quoted(column)))


def run_day_minus_one(df: DataFrame, column: str, into: str = "run_day") -> DataFrame:
    return df.withColumn(into, run_day(quoted(column)))

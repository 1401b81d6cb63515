"""Row filters, written so that partition and Parquet filters reach the scan."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from matchlake.functions import quoted


def _as_type_of(df: DataFrame, column: str, value: str | dt.date) -> Column:
    """A literal of the column's own type, so that the column needs no cast."""
    return F.lit(str(value)).cast(df.schema[column].dataType)


def date_range_filter(
    df: DataFrame, first: str | dt.date, last: str | dt.date, column: str = "event_date"
) -> DataFrame:
    """Both ends included; rows without a date are left out."""
    return df.filter(
        quoted(column).between(_as_type_of(df, column, first), _as_type_of(df, column, last))
    )


def partition_eq_filter(
    df: DataFrame, value: str | dt.date, column: str = "event_date"
) -> DataFrame:
    return df.filter(quoted(column) == _as_type_of(df, column, value))


def _missing(df: DataFrame, column: str) -> Column:
    absent = quoted(column).isNull()
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        absent = absent | F.isnan(quoted(column))
    return absent


def drop_null_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Keep rows that have a value (NaN is none) in every one of the columns."""
    return df.filter(~reduce(or_, [_missing(df, c) for c in columns]))


def select_null_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with a missing value in any of the columns: what ``drop_null_rows`` drops."""
    return df.filter(reduce(or_, [_missing(df, c) for c in columns]))

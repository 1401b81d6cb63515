"""Casts applied to the columns that are present."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, types as T

from matchlake.functions import nan_to_null, quoted, whole_number
from matchlake.schemas import (
    GOLD_CATEGORY_COLUMNS,
    SCORE_FLOAT_COLUMNS,
    SILVER_INT_COLUMNS,
    SILVER_TEXT_COLUMNS,
)


def _present(df: DataFrame, columns: Iterable[str], wanted: T.DataType | None) -> list[str]:
    """The columns that are there and not of the wanted type already."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return [c for c in columns if c in types and types[c] != wanted]


def cast_float_if_exists(df: DataFrame, columns: Iterable[str] = SCORE_FLOAT_COLUMNS) -> DataFrame:
    # Doubles are not passed over: their NaN has to become NULL.
    return df.withColumns(
        {
            c: nan_to_null(quoted(c), df.schema[c].dataType).cast("double")
            for c in _present(df, columns, None)
        }
    )


def cast_int_if_exists(df: DataFrame, columns: Iterable[str] = SILVER_INT_COLUMNS) -> DataFrame:
    return df.withColumns(
        {
            c: whole_number(quoted(c), df.schema[c].dataType)
            for c in _present(df, columns, T.LongType())
        }
    )


def cast_string_if_exists(df: DataFrame, columns: Iterable[str] = SILVER_TEXT_COLUMNS) -> DataFrame:
    return df.withColumns(
        {c: quoted(c).cast("string") for c in _present(df, columns, T.StringType())}
    )


def cast_categorical(df: DataFrame, columns: Iterable[str] = GOLD_CATEGORY_COLUMNS) -> DataFrame:
    """Low-cardinality text. Values stay as they are; Parquet dictionary-encodes them."""
    return cast_string_if_exists(df, columns)


def cast_year_int(df: DataFrame, column: str = "current_year") -> DataFrame:
    return df.withColumn(column, quoted(column).cast("int"))

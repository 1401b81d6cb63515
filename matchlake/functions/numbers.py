"""Numeric helpers. NaN is treated as a missing value throughout."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def ticked(name: str) -> str:
    """A column name, possibly with dots, as it is written in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    """Reference a column whose name may hold dots."""
    return F.col(ticked(name))


def nan_to_null(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value)
    return value


def whole_number(value: Column, dtype: T.DataType) -> Column:
    """Cast to long; NaN becomes NULL and a fractional value raises."""
    if not isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        return value.cast("long")
    clean = nan_to_null(value, dtype)
    return (
        F.when(clean.isNull(), F.lit(None).cast("long"))
        .when(clean == F.floor(clean), clean.cast("long"))
        .otherwise(
            F.raise_error(F.concat(F.lit("not a whole number: "), clean.cast("string"))).cast("long")
        )
    )


def round2(value: Column) -> Column:
    """Two decimals; a tie goes to the even digit."""
    return F.bround(value, 2)


def pct_of_total(part: Column, total: Column) -> Column:
    """Percentage with one decimal, ties to even; NULL for an empty total."""
    return F.bround(F.try_divide(part * F.lit(100.0), total), 1)


def pct_label(part: Column, total: Column) -> Column:
    """The percentage as it is shown: one decimal and a percent sign."""
    shown = F.call_function("format_number", pct_of_total(part, total), F.lit("0.0"))
    return F.concat(shown, F.lit("%"))

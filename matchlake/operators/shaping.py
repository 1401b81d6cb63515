"""Column shape and names."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from matchlake.functions import quoted, ticked
from matchlake.schemas import GOLD_COLUMNS, SILVER_DROPPED_COLUMNS


def _leaves(schema: T.StructType, path: list[str]):
    for field in schema.fields:
        here = [*path, field.name]
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield here


def flatten_nested(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs become ``a.b.c`` columns; arrays are left whole."""
    return df.selectExpr(
        *[
            f"{'.'.join(ticked(n) for n in path)} AS {ticked(sep.join(path))}"
            for path in _leaves(df.schema, [])
        ]
    )


def rename_key(df: DataFrame, old: str = "fixture.id", new: str = "fixture_id") -> DataFrame:
    return df.withColumnRenamed(old, new)


def standardize_names(df: DataFrame) -> DataFrame:
    """Lower case, dots to underscores; two names that would collide raise."""
    names = [c.lower().replace(".", "_") for c in df.columns]
    clashes = sorted(n for n, times in Counter(names).items() if times > 1)
    if clashes:
        raise ValueError(f"column names collide after standardizing: {clashes}")
    return df.toDF(*names)


def drop_if_exists(df: DataFrame, columns: Iterable[str] = SILVER_DROPPED_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def drop_column(df: DataFrame, column: str) -> DataFrame:
    """Drop one column that must be there."""
    if column not in df.columns:
        raise ValueError(f"no column {column!r} to drop")
    return df.drop(column)


def select_curated(df: DataFrame, columns: Iterable[str] = GOLD_COLUMNS) -> DataFrame:
    """The compact Gold columns; a missing one is an analysis error."""
    return df.select(*[quoted(c) for c in columns])


def head_n(df: DataFrame, n: int, *order_by: str | Column) -> DataFrame:
    """First ``n`` rows in a stated order (tables have no order of their own)."""
    if not order_by:
        raise ValueError("head_n needs an order")
    return df.orderBy(*order_by).limit(n)


def sort_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values in ascending order; copies collapse before the sort shuffle."""
    return df.select(quoted(column)).distinct().orderBy(F.col(f"`{column}`").asc())

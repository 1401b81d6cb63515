"""Stored tables: partitioned Parquet with the schema of the first write beside it."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

from matchlake.functions import quoted
from matchlake.operators.filters import date_range_filter, partition_eq_filter
from matchlake.schemas import LAYERS
from matchlake.sources import files

_SCHEMA_FILE = "_table_schema.json"  # hidden from readers by its underscore


@dataclass(frozen=True)
class TableInfo:
    schema: T.StructType
    partition: tuple[str, ...]


def table_path(root: str, layer: str, source: str, entity: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    return f"{root.rstrip('/')}/{layer}/{source}/{entity}"


def save_info(spark: SparkSession, path: str, schema: T.StructType, partition) -> None:
    # Files hold nullable columns whatever the writing frame declared.
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    body = {"schema": json.loads(loose.json()), "partition": list(partition)}
    files.write_text(spark, f"{path}/{_SCHEMA_FILE}", json.dumps(body))


OLD, NEW = "__old_", "__new_"


def recover(spark: SparkSession, path: str) -> None:
    """Finish an overwrite that broke off between its two renames.

    The old table is moved away only when the new one is complete, so the new one takes its
    place; without it, the old one returns. Only writers do so: to a reader the overwrite
    may be one that is going on (``standing``).
    """
    if files.exists(spark, path):
        return
    for old in files.beginning_with(spark, path + OLD):
        new = path + NEW + old[len(path + OLD) :]
        files.rename(spark, new if files.exists(spark, new) else old, path)
        if files.exists(spark, old):
            files.delete(spark, old)
        return


def standing(spark: SparkSession, path: str) -> str:
    """Where a table is to be read: between the two renames of an overwrite the new table
    still is beside its place."""
    if not files.exists(spark, path):
        for old in files.beginning_with(spark, path + OLD):
            new = path + NEW + old[len(path + OLD) :]
            return new if files.exists(spark, new) else old
    return path


def load_info(spark: SparkSession, path: str) -> TableInfo | None:
    text = files.read_text(spark, f"{standing(spark, path)}/{_SCHEMA_FILE}")
    if text is None:
        return None
    body = json.loads(text)
    return TableInfo(T.StructType.fromJson(body["schema"]), tuple(body["partition"]))


def table_exists(spark: SparkSession, path: str) -> bool:
    """A bare directory is no table; a written one is, even with no rows."""
    path = standing(spark, path)
    return files.exists(spark, f"{path}/{_SCHEMA_FILE}") or files.has_data_file(spark, path)


def add_columns(spark: SparkSession, path: str, fields: list[T.StructField]) -> None:
    """Declare further columns, which are null in what is stored already."""
    info = load_info(spark, path)
    if info is None:
        raise ValueError(f"the table at {path} has no schema file")
    new = [f for f in fields if f.name not in info.schema.names]
    if new:
        save_info(spark, path, T.StructType([*info.schema.fields, *new]), info.partition)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All partitions. A missing table raises.

    The declared schema keeps partition columns in their own type (Spark would read
    day text back as a date) and lets an empty table be read.
    """
    if schema is None:
        info = load_info(spark, path)
        if info is None:
            return spark.read.parquet(standing(spark, path))
        schema = info.schema
    if not table_exists(spark, path):
        raise FileNotFoundError(f"no table at {path}")
    df = spark.read.schema(schema).parquet(standing(spark, path))
    return df.select(*[quoted(c) for c in schema.names])


def _day(as_of: str | dt.date) -> dt.date:
    if isinstance(as_of, dt.datetime):
        return as_of.date()
    return as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(as_of)


def _read_directories(
    spark: SparkSession, path: str, info: TableInfo, column: str, values: list[str]
) -> DataFrame:
    """Some partitions without listing the others, of which a long history has many."""
    path = standing(spark, path)
    found = [f"{path}/{column}={v}" for v in values]
    found = [f for f in found if files.exists(spark, f)]
    if not found:
        return spark.createDataFrame([], info.schema)
    df = spark.read.schema(info.schema).option("basePath", path).parquet(*found)
    return df.select(*[quoted(c) for c in info.schema.names])


def read_partition_day(
    spark: SparkSession, path: str, as_of: str | dt.date, column: str = "event_date"
) -> DataFrame:
    """The partition of the day before ``as_of``; a day without data gives no rows."""
    day = _day(as_of) - dt.timedelta(days=1)
    try:
        info = load_info(spark, path)
        if info is not None and info.partition == (column,):
            return partition_eq_filter(
                _read_directories(spark, path, info, column, [str(day)]), day, column
            )
        return partition_eq_filter(read_table(spark, path), day, column)
    except (AnalysisException, OSError, ValueError) as error:
        raise RuntimeError(f"could not read the day before {as_of} from {path}: {error}") from error


def read_partition_days(
    spark: SparkSession,
    path: str,
    first: str | dt.date,
    last: str | dt.date,
    column: str = "event_date",
) -> DataFrame:
    """Several days, both ends included: a late or first run over many days."""
    return date_range_filter(read_table(spark, path), first, last, column)


#: Days that are looked up one by one; for more the table is listed.
LOOKED_UP_DAYS = 400


def read_days(
    spark: SparkSession, path: str, days: Iterable[str | dt.date], column: str = "event_date"
) -> DataFrame:
    """The partitions of the days named; those without data give no rows."""
    days = sorted({str(day) for day in days})
    info = load_info(spark, path)
    if len(days) <= LOOKED_UP_DAYS and info is not None and info.partition == (column,):
        return _read_directories(spark, path, info, column, days)
    return read_table(spark, path).filter(quoted(column).cast("string").isin(days))

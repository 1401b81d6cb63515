"""Landed records to Bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame

from matchlake.operators.calendar import event_date_derive
from matchlake.operators.merging import of_one_document, one_per_key
from matchlake.operators.retype import cast_float_if_exists
from matchlake.operators.shaping import flatten_nested, rename_key
from matchlake.schemas import DELIVERED, ENTITIES, UNDECLARED
from matchlake.sources import read_table, save_new, save_upsert, table_exists, write_table
from matchlake.sources.exchange import Batch
from matchlake.sources.tables import add_columns, load_info


def bronze_static(records: DataFrame) -> DataFrame:
    """Countries and leagues: flattened, otherwise as received."""
    return records.transform(flatten_nested)


def bronze_fixtures(records: DataFrame, lenient: bool = False) -> DataFrame:
    """Matches: flattened, key renamed, scores as floats, day of play added."""
    return (
        records.transform(flatten_nested)
        .transform(rename_key)
        .transform(cast_float_if_exists)
        .transform(event_date_derive, lenient)
    )


def load_static(records: DataFrame, path: str) -> None:
    write_table(bronze_static(records), path, "overwrite")


def load_fixtures(
    records: DataFrame,
    path: str,
    merge_mode: str = "insert",
    lenient: bool = False,
    dedup_source: bool = False,
    batch: Batch | None = None,
) -> DataFrame:
    """Merge landed matches into Bronze; returns the rows that were merged."""
    rows = delivered_fixtures(records, merge_mode, lenient, dedup_source)
    store(rows, path, merge_mode, batch)
    return rows


def delivered_fixtures(
    records: DataFrame, merge_mode: str = "insert", lenient: bool = False, dedup_source: bool = False
) -> DataFrame:
    """Landed matches as rows to be merged.

    If records tell when they were delivered, the first delivery of a match is inserted and
    the latest one upserted, as if documents had come one by one. ``dedup_source`` also
    keeps a single row of a match that one document repeats.
    """
    rows, keys = bronze_fixtures(records, lenient), ENTITIES["fixtures"].keys
    if DELIVERED in rows.columns:
        rows = of_one_document(rows, keys, DELIVERED, latest=merge_mode == "upsert").drop(DELIVERED)
    return one_per_key(rows, keys) if dedup_source else rows


def _undeclared_fitted(df: DataFrame, path: str) -> DataFrame:
    """A table of before undeclared keys were kept gets their column."""
    spark = df.sparkSession
    if UNDECLARED not in df.columns or not table_exists(spark, path):
        return df
    if load_info(spark, path) is None:  # another writer's table keeps its form
        return df if UNDECLARED in read_table(spark, path).columns else df.drop(UNDECLARED)
    add_columns(spark, path, [df.schema[UNDECLARED]])
    return df


def store(
    df: DataFrame, path: str, merge_mode: str = "insert", batch: Batch | None = None
) -> set[str]:
    """Merge a batch of matches into a day-partitioned table by match key; returns the days
    on which stored matches were replaced."""
    if merge_mode not in ("insert", "upsert"):
        raise ValueError(f"unknown merge mode {merge_mode!r}")
    entity = ENTITIES["fixtures"]
    save = save_new if merge_mode == "insert" else save_upsert
    replaced = save(_undeclared_fitted(df, path), path, entity.keys, entity.partition, batch=batch)
    return {str(days[0]) for days in replaced or () if days and days[0] is not None}

"""Silver to Gold."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from matchlake.operators.calendar import date_to_string, event_date_utc
from matchlake.operators.metrics import CUBE_COLUMNS, gold_metrics, match_counts, metrics_of_counts
from matchlake.operators.retype import cast_categorical, cast_int_if_exists, cast_string_if_exists
from matchlake.operators.shaping import select_curated
from matchlake.sources import read_table
from matchlake.sources.sinks import replace_partitions


class Gold(NamedTuple):
    """The typed history for analysis, and the compact table that is stored."""

    full: DataFrame
    curated: DataFrame


def gold_fixtures(silver: DataFrame) -> Gold:
    """Restore types, then keep nine columns with the day as text. Both lazy."""
    full = (
        silver.transform(cast_int_if_exists)
        .transform(cast_string_if_exists)
        .transform(cast_categorical)
        .transform(event_date_utc)
    )
    return Gold(full, full.transform(select_curated).transform(date_to_string))


def refresh_counts(
    changed: DataFrame, path: str, values: Iterable[object], column: str = "event_date"
) -> None:
    """Count anew the combinations of the partitions that changed, of which ``changed`` holds
    all rows, and put them in the place of what is stored of those partitions."""
    columns = [column, *[c for c in CUBE_COLUMNS if c != column]]
    replace_partitions(match_counts(changed, columns), path, column, values)


def stored_metrics(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """``gold_metrics`` from the counts stored of each partition, without a look at a match."""
    return metrics_of_counts(read_table(spark, path))


__all__ = ["Gold", "gold_fixtures", "gold_metrics", "refresh_counts", "stored_metrics"]

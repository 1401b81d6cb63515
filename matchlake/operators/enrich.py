"""Derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from matchlake import functions as fn
from matchlake.functions import quoted
from matchlake.schemas import WINNER_FLAG_COLUMNS


def _goals(df: DataFrame):
    if not {"goals_home", "goals_away"} <= set(df.columns):
        return None
    return [
        fn.nan_to_null(quoted(c), df.schema[c].dataType) for c in ("goals_home", "goals_away")
    ]


def match_winner(df: DataFrame) -> DataFrame:
    """Add ``match_winner`` from the goals and drop the two raw winner flags."""
    goals = _goals(df)
    if goals:
        df = df.withColumn("match_winner", fn.winner(*goals))
    return df.drop(*WINNER_FLAG_COLUMNS)


def total_goals(df: DataFrame) -> DataFrame:
    """Add ``total_goals``; missing when either side is missing."""
    goals = _goals(df)
    return df.withColumn("total_goals", fn.total_goals(*goals)) if goals else df


def label_map(df: DataFrame, column: str = "match_winner", into: str = "Resultado") -> DataFrame:
    return df.withColumn(into, fn.result_label(quoted(column)))


def season_years(df: DataFrame, column: str = "seasons") -> DataFrame:
    """First, last and current season year of each league."""
    seasons = quoted(column)
    return df.withColumns(
        {
            "min_year": fn.min_year(seasons),
            "max_year": fn.max_year(seasons),
            "current_year": fn.current_year(seasons),
        }
    )

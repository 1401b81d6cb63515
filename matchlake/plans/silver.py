"""Bronze to Silver."""

from __future__ import annotations

from pyspark.sql import DataFrame

from matchlake.operators.calendar import (
    date_to_string,
    epoch_ts_minute,
    event_date_derive,
    parse_ts_minute,
)
from matchlake.operators.enrich import match_winner, season_years, total_goals
from matchlake.operators.filters import drop_null_rows
from matchlake.operators.retype import (
    cast_categorical,
    cast_int_if_exists,
    cast_string_if_exists,
    cast_year_int,
)
from matchlake.operators.shaping import drop_column, drop_if_exists, standardize_names
from matchlake.schemas import LEAGUE_TEXT_COLUMNS


def silver_fixtures(bronze: DataFrame) -> DataFrame:
    """Clean names, types and dates; derive winner and total goals. All narrow steps."""
    return (
        bronze.transform(standardize_names)
        .transform(parse_ts_minute)
        .transform(epoch_ts_minute)
        .transform(drop_if_exists)
        .transform(match_winner)
        .transform(total_goals)
        .transform(cast_int_if_exists)
        .transform(cast_string_if_exists)
        .transform(event_date_derive)
        .transform(date_to_string)
    )


def silver_leagues(bronze: DataFrame) -> DataFrame:
    """Season list to three years; leagues without a current season are left out."""
    return (
        bronze.transform(standardize_names)
        .transform(season_years)
        .transform(drop_null_rows, "current_year")
        .transform(cast_year_int, "current_year")
        .transform(drop_column, "seasons")
        .transform(cast_string_if_exists, LEAGUE_TEXT_COLUMNS)
        .transform(cast_categorical, ["league_type"])
    )

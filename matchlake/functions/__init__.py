"""Column functions; every one is built from native Spark expressions."""

from matchlake.functions.dates import (
    day_text,
    epoch_to_minute,
    parse_to_minute,
    parse_utc,
    run_day,
    utc_midnight,
)
from matchlake.functions.numbers import (
    nan_to_null,
    pct_label,
    pct_of_total,
    quoted,
    round2,
    ticked,
    whole_number,
)
from matchlake.functions.outcome import label_for, result_label, total_goals, winner
from matchlake.functions.seasons import current_year, first_element, max_year, min_year

__all__ = [
    "current_year",
    "day_text",
    "epoch_to_minute",
    "first_element",
    "label_for",
    "max_year",
    "min_year",
    "nan_to_null",
    "parse_to_minute",
    "parse_utc",
    "pct_label",
    "pct_of_total",
    "quoted",
    "result_label",
    "round2",
    "run_day",
    "ticked",
    "total_goals",
    "utc_midnight",
    "whole_number",
    "winner",
]

"""Match outcome expressions."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column, functions as F

from matchlake.schemas import RESULT_LABELS


def winner(home: Column, away: Column) -> Column:
    """Home, Away or Draw; NULL when a side has no goals recorded."""
    return F.when(home > away, "Home").when(home < away, "Away").when(home == away, "Draw")


def total_goals(home: Column, away: Column) -> Column:
    return home + away


def label_for(value: Column, labels: Mapping[str, str]) -> Column:
    """Dictionary lookup; values outside the dictionary give NULL."""
    pairs = [F.lit(x) for x in chain.from_iterable(labels.items())]
    return F.create_map(*pairs)[value]


def result_label(value: Column) -> Column:
    return label_for(value, RESULT_LABELS)

"""Reductions of a league's season list (array of year/current structs)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _years(seasons: Column) -> Column:
    return F.transform(seasons, lambda s: s["year"])


def min_year(seasons: Column) -> Column:
    return F.array_min(_years(seasons))


def max_year(seasons: Column) -> Column:
    return F.array_max(_years(seasons))


def current_year(seasons: Column) -> Column:
    """Year of the first season, in list order, that is flagged current."""
    return F.get(F.filter(seasons, lambda s: s["current"]), F.lit(0))["year"]


def first_element(values: Column) -> Column:
    return F.get(values, F.lit(0))

"""Descriptive statistics of a match table.

Every function takes an optional ``weight`` column holding a number of matches per
row, so it works on raw rows and on the pre-aggregated frame of ``match_counts``.
``gold_metrics`` uses the latter: one scan and one map-side combined shuffle, after
which all metrics come from a frame as small as the combinations of its values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from matchlake.functions import (
    nan_to_null,
    pct_of_total,
    quoted,
    result_label,
    round2,
    ticked,
)
from matchlake.schemas import GOAL_MEASURES, RESULT_LABELS, RESULT_ORDER, SIDE_MEASURES
from matchlake.session import pinned

COUNT = "matches"
#: Bins of a histogram that are made as one array.
BIN_CHUNK = 65_536
CUBE_COLUMNS = [
    "match_winner",
    "goals_home",
    "goals_away",
    "total_goals",
    "fixture_status_elapsed",
    "league_season",
]


def without_nan(df: DataFrame) -> DataFrame:
    """NaN means missing: it becomes NULL in every floating-point column."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    floating = [c for c, t in kinds.items() if isinstance(t, (T.DoubleType, T.FloatType))]
    if not floating:
        return df
    return df.select(
        *[nan_to_null(quoted(c), t).alias(c) if c in floating else quoted(c) for c, t in kinds.items()]
    )


def _matches(weight: str | None, where: str = "true") -> Column:
    """Number of matches, all or those for which a condition is true."""
    each = "1L" if weight is None else ticked(weight)
    return F.expr(f"coalesce(sum(if({where}, {each}, NULL)), 0L)")


def _matches_by_result(column: str, weight: str | None) -> list[Column]:
    """One count per result in display order, named by its label; codes are compared
    as stored, so no label is looked up per row."""
    code_of = {label: code for code, label in RESULT_LABELS.items()}
    return [_matches(weight, f"{ticked(column)} = '{code_of[r]}'").alias(r) for r in RESULT_ORDER]


def _weighted_sum(column: str, weight: str | None) -> Column:
    value = ticked(column) + ("" if weight is None else f" * {ticked(weight)}")
    return F.expr(f"coalesce(sum({value}), 0)")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _rows(one_row: DataFrame, names: str, *values: Sequence[str]) -> DataFrame:
    """Turn the columns of a one-row frame into rows, given as SQL text."""
    cells = ", ".join(cell for row in values for cell in row)
    return one_row.selectExpr(f"stack({len(values)}, {cells}) AS ({names})")


def match_counts(df: DataFrame, columns: Sequence[str] = CUBE_COLUMNS) -> DataFrame:
    """Number of matches per combination of the columns the metrics need."""
    df = without_nan(df)
    return df.groupBy(*[quoted(c) for c in columns]).agg(F.count(F.lit(1)).alias(COUNT))


# --- Counts and profiles -----------------------------------------------------


def row_count(df: DataFrame, weight: str | None = None) -> DataFrame:
    return df.agg(_matches(weight).alias("rows"))


def _per_column(df: DataFrame, columns: Sequence[str], count: str, name: str) -> DataFrame:
    """One aggregate of every column in one pass, turned into one row per column."""
    counts = df.selectExpr(
        *[f"{count.format(ticked(c))} AS n{i}" for i, c in enumerate(columns)]
    )
    return _rows(
        counts, f"column_name, {name}", *[(_text(c), f"n{i}") for i, c in enumerate(columns)]
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    df = without_nan(df)
    return _per_column(df, list(columns or df.columns), "count_if({} IS NULL)", "nulls")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values, a missing one included."""
    df = without_nan(df)
    return df.select(quoted(column)).distinct()


def n_unique(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column; exact unless ``approximate``."""
    df = without_nan(df)
    count = "approx_count_distinct({})" if approximate else "count(DISTINCT {})"
    return _per_column(df, columns, count, "n_unique")


def unique_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Sketches of the distinct values of columns, one row for each group, such as a day.

    Sketches of several days can be united, so a new day is all that has to be read to know
    the distinct values of the whole history (``n_unique_of_sketches``).
    """
    df = without_nan(df)
    sketches = [F.hll_sketch_agg(quoted(c).cast("string")).alias(c) for c in columns]
    return df.groupBy(*[quoted(c) for c in by]).agg(*sketches)


def n_unique_of_sketches(sketches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``n_unique`` of all groups together, within about 2 % (exact for a few hundred values)."""
    count = "coalesce(hll_sketch_estimate(hll_union_agg({})), 0L)"
    return _per_column(sketches, columns, count, "n_unique")


def column_profile(df: DataFrame) -> DataFrame:
    """Position, name, type and number of non-null values of every column."""
    df = without_nan(df)
    fields = df.schema.fields
    counts = df.selectExpr(*[f"count({ticked(f.name)}) AS n{i}" for i, f in enumerate(fields)])
    return _rows(
        counts,
        "position, column_name, data_type, non_null",
        *[
            (str(i), _text(f.name), _text(f.dataType.simpleString()), f"n{i}")
            for i, f in enumerate(fields)
        ],
    )


def value_counts(df: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """Matches per value, most frequent first, ties by value; missing values left out."""
    df = without_nan(df)
    return (
        df.filter(quoted(column).isNotNull())
        .groupBy(quoted(column))
        .agg(_matches(weight).alias(COUNT))
        .orderBy(F.col(COUNT).desc(), quoted(column).asc())
    )


def elapsed_counts(
    df: DataFrame, column: str = "fixture_status_elapsed", weight: str | None = None
) -> DataFrame:
    """Matches per value in ascending order of the value."""
    df = without_nan(df)
    return (
        df.filter(quoted(column).isNotNull())
        .groupBy(quoted(column))
        .agg(_matches(weight).alias(COUNT))
        .orderBy(quoted(column).asc())
    )


# --- Results -----------------------------------------------------------------


def result_distribution(
    df: DataFrame, column: str = "match_winner", weight: str | None = None
) -> DataFrame:
    """Three rows in display order; the share is of all matches, unplayed ones included."""
    counts = df.agg(_matches(weight).alias("total"), *_matches_by_result(column, weight))
    return _rows(
        counts,
        f"position, Resultado, {COUNT}, total",
        *[(str(i), _text(r), ticked(r), "total") for i, r in enumerate(RESULT_ORDER)],
    ).select(
        "position", "Resultado", COUNT, pct_of_total(F.col(COUNT), F.col("total")).alias("pct")
    )


def results_by_season(
    df: DataFrame,
    season: str = "league_season",
    column: str = "match_winner",
    weight: str | None = None,
) -> DataFrame:
    """One row per season in ascending order, one column per result, zero-filled."""
    df = without_nan(df)
    return (
        df.filter(quoted(season).isNotNull())
        .groupBy(quoted(season))
        .agg(*_matches_by_result(column, weight))
        .orderBy(quoted(season).asc())
    )


# --- Goals -------------------------------------------------------------------


def goals_sum(df: DataFrame, column: str = "total_goals", weight: str | None = None) -> DataFrame:
    df = without_nan(df)
    return df.agg(_weighted_sum(column, weight).alias("goals"))


def goals_by_condition(df: DataFrame, weight: str | None = None) -> DataFrame:
    df = without_nan(df)
    sums = df.agg(*[_weighted_sum(c, weight).alias(c) for c in SIDE_MEASURES.values()])
    return _rows(
        sums,
        "`Condición`, Goles",
        *[(_text(label), ticked(c)) for label, c in SIDE_MEASURES.items()],
    )


def _frequencies(
    df: DataFrame, measures: Mapping[str, str], weight: str | None
) -> DataFrame:
    """(category, value, matches) for several measures, (value, matches) for one.

    The combinations are counted before they are unpivoted, so input rows are not
    multiplied by the number of measures.
    """
    df = without_nan(df)
    names = list(measures.values())
    if len(names) == 1:
        return df.groupBy(quoted(names[0]).alias("value")).agg(_matches(weight).alias("n"))
    counts = df.groupBy(*[quoted(c) for c in names]).agg(_matches(weight).alias(COUNT))
    return (
        _rows(
            counts,
            "category, value, n",
            *[(_text(label), ticked(c), COUNT) for label, c in measures.items()],
        )
        .groupBy("category", "value")
        .agg(F.sum("n").alias("n"))
    )


def _statistics(frequencies: DataFrame, *by: str, median: bool = True) -> DataFrame:
    """Mean, exact median, lowest mode and sample deviation from value frequencies.

    The state of the median is one counter per distinct value, which for goals is a
    handful; ``wide_stats`` serves measures with very many distinct values.
    """
    played = "if(value IS NULL, NULL, n)"
    total, mass = f"sum({played})", "sum(value * n)"
    squares = "sum(cast(value AS DOUBLE) * value * n)"
    spread = f"({squares} - cast({mass} AS DOUBLE) * {mass} / {total}) / ({total} - 1)"
    aggregates = {
        "mean": f"{mass} / {total}",
        "median": "percentile(value, 0.5D, n)",
        "mode": "max_by(value, if(value IS NULL, NULL, struct(n, -value)))",
        "std": f"if({total} > 1, sqrt(greatest({spread}, 0D)), NULL)",
    }
    if not median:
        del aggregates["median"]
    return frequencies.groupBy(*[quoted(c) for c in by]).agg(*[F.expr(e).alias(n) for n, e in aggregates.items()])


def goals_stats(df: DataFrame, column: str = "total_goals", weight: str | None = None) -> DataFrame:
    """One row: mean, median, mode and deviation of one measure, two decimals."""
    one = _statistics(_frequencies(df, {column: column}, weight))
    return one.select(
        round2(F.col("mean")).alias("mean"),
        round2(F.col("median")).alias("median"),
        "mode",
        round2(F.col("std")).alias("std"),
    )


def stats_by_category(df: DataFrame, weight: str | None = None) -> DataFrame:
    """The four statistics, one row for total, home and away goals."""
    stats = _statistics(_frequencies(df, GOAL_MEASURES, weight), "category")
    return stats.select(
        F.col("category").alias("Categoría"),
        round2(F.col("mean")).alias("Media"),
        round2(F.col("median")).alias("Mediana"),
        F.col("mode").alias("Moda"),
        round2(F.col("std")).alias("Desvío estándar"),
    )


def approximate_stats(df: DataFrame, column: str, accuracy: int = 10_000) -> DataFrame:
    """Mean, sketch median and deviation for measures with very many distinct values."""
    value = nan_to_null(quoted(column), df.schema[column].dataType)
    return df.agg(
        round2(F.avg(value)).alias("mean"),
        F.percentile_approx(value, 0.5, accuracy).alias("median"),
        round2(F.stddev_samp(value)).alias("std"),
    )


def exact_median(df: DataFrame, column: str, few: int = 100_000) -> float | None:
    """Median of a measure with any number of distinct values.

    Values are counted, and the counts narrowed to the range that holds the middle
    ranks until few are left; no task or driver ever holds the others.
    """
    value = nan_to_null(quoted(column), df.schema[column].dataType).alias("value")
    counts = df.select(value).filter("value IS NOT NULL").groupBy("value")
    counts = pinned(counts.agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).first()[0]
    if total is None:
        return None
    ranks = sorted({(total - 1) // 2, total // 2})
    return float(sum(_value_at(counts, rank, few) for rank in ranks) / len(ranks))


def group_medians(frequencies: DataFrame, by: Sequence[str], few: int = 100_000) -> DataFrame:
    """(by..., median) of frequencies (by..., value, n): exact, for all groups at once.

    Where a group has more than ``few`` values, its values are cut into 64 parts, of which
    those that hold its middle ranks go on to the next round. No task sorts more values of a
    group than that, and none holds a counter for every value.
    """
    keys = [quoted(c) for c in by]
    left = frequencies.filter("value IS NOT NULL AND n > 0").groupBy(*keys, "value").agg(F.sum("n").alias("n"))
    left = pinned(left)
    ranks = left.groupBy(*keys).agg(F.sum("n").alias("total"))
    ranks = ranks.select(
        *keys, F.expr("(total - 1) div 2").alias("low"), F.expr("total div 2").alias("high")
    )
    same = lambda a, b: reduce(and_, [F.col(f"{a}.{ticked(c)}").eqNullSafe(F.col(f"{b}.{ticked(c)}")) for c in by])
    while True:
        sizes = left.groupBy(*keys).count()
        if sizes.filter(F.col("count") > few).isEmpty():
            break
        # Pivots split a group's distinct values evenly, whatever their counts; a group with
        # few values has none and goes on whole.
        shares = ", ".join(f"{i / 64}D" for i in range(1, 64))
        pivots = left.groupBy(*keys).agg(
            F.expr(f"if(count(*) > {few}, percentile_approx(value, array({shares}), 10000), array())").alias("pivots")
        )
        parts = left.alias("l").join(pivots.alias("r"), same("l", "r")).select(
            "l.*", F.expr("size(filter(array_distinct(pivots), p -> p < l.value))").alias("part")
        )
        parts = pinned(parts)
        sums = parts.groupBy(*keys, "part").agg(F.sum("n").alias("matches"))
        before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.coalesce(F.sum("matches").over(before), F.lit(0)))
        at = sums.alias("l").join(ranks.alias("r"), same("l", "r"))
        at = at.filter("before + matches > low AND before <= high")
        chosen = at.groupBy(*[F.col(f"l.{ticked(c)}").alias(c) for c in by]).agg(
            F.min("part").alias("first"), F.max("part").alias("last"), F.min("before").alias("before"),
            F.first("low").alias("low"), F.first("high").alias("high"),
        )
        chosen = pinned(chosen)
        inside = parts.alias("l").join(chosen.alias("r"), same("l", "r")).filter("part BETWEEN first AND last")
        left = pinned(inside.select(*[F.col(f"l.{ticked(c)}").alias(c) for c in by], "value", "n"))
        ranks = chosen.select(*keys, (F.col("low") - F.col("before")).alias("low"), (F.col("high") - F.col("before")).alias("high"))
    reached = F.sum("n").over(Window.partitionBy(*keys).orderBy("value"))
    at = left.withColumn("reached", reached).alias("l").join(ranks.alias("r"), same("l", "r"))
    low, high = (F.expr(f"min(if(reached > {r}, value, NULL))").cast("double") for r in ("low", "high"))
    return at.groupBy(*[F.col(f"l.{ticked(c)}").alias(c) for c in by]).agg(((low + high) / 2).alias("median"))


def wide_stats(df: DataFrame, column: str, by: Sequence[str], few: int = 100_000) -> DataFrame:
    """(by..., mean, median, mode, std) of a measure with any number of distinct values, such
    as a price, for each group: the statistics of ``stats_by_category``, with a bounded state."""
    df = without_nan(df)
    keys = [quoted(c) for c in by]
    frequencies = pinned(df.groupBy(*keys, quoted(column).alias("value")).agg(_matches(None).alias("n")))
    others = _statistics(frequencies, *by, median=False)
    medians = group_medians(frequencies, by, few)
    same = reduce(and_, [F.col(f"l.{ticked(c)}").eqNullSafe(F.col(f"r.{ticked(c)}")) for c in by])
    return others.alias("l").join(medians.alias("r"), same, "left").select(
        *[F.col(f"l.{ticked(c)}").alias(c) for c in by],
        round2(F.col("mean")).alias("mean"),
        round2(F.col("median")).alias("median"),
        "mode",
        round2(F.col("std")).alias("std"),
    )


def _value_at(counts: DataFrame, rank: int, few: int):
    """The value at a rank (from 0) among counted values."""
    while counts.count() > few:
        # Pivots split the distinct values evenly, whatever their counts.
        shares = ", ".join(f"{i / 64}D" for i in range(1, 64))
        pivots = counts.agg(F.expr(f"percentile_approx(value, array({shares}), 10000)")).first()[0]
        limits = F.array(*[F.lit(p) for p in sorted(set(pivots))])
        parts = counts.withColumn("part", F.size(F.filter(limits, lambda p: p < F.col("value"))))
        for part, matches in sorted(parts.groupBy("part").agg(F.sum("n")).collect()):
            if rank < matches:
                break
            rank -= matches
        counts = parts.filter(F.col("part") == part).select("value", "n")
    reached = F.sum("n").over(Window.orderBy("value"))
    return (
        counts.withColumn("reached", reached)
        .filter(F.col("reached") > rank)
        .agg(F.min("value"))
        .first()[0]
    )


def goals_histogram(
    df: DataFrame, column: str = "total_goals", weight: str | None = None
) -> DataFrame:
    """Matches per whole number of goals from 0 to the maximum, empty bins kept."""
    df = without_nan(df)
    counts = (
        df.filter(quoted(column).isNotNull())
        .groupBy(quoted(column).alias("goals"))
        .agg(_matches(weight).alias("n"))
    )
    # Naming the count in the maximum keeps both uses of ``counts`` alike, so that the
    # table is scanned once and the exchange is reused.
    top = counts.agg(F.expr("max(if(n > 0, cast(goals AS LONG), NULL))").alias("top"))
    # Bins are made chunk by chunk, in as many tasks as there are many chunks, so that a
    # single very large value costs rows but no task its memory.
    many, some = 1_000_000_000, BIN_CHUNK
    blocks = top.selectExpr("top", f"explode(if(top >= 0, sequence(0L, top, {many}L), NULL)) AS block")
    chunks = blocks.selectExpr(
        "top", f"explode(sequence(block, least(top, block + {many - 1}L), {some}L)) AS first"
    ).repartition("first")
    bins = chunks.selectExpr(f"explode(sequence(first, least(top, first + {some - 1}L))) AS goals")
    return bins.join(counts, "goals", "left").selectExpr("goals", f"coalesce(n, 0L) AS {COUNT}")


# --- Everything at once ------------------------------------------------------


def gold_metrics(df: DataFrame) -> dict[str, DataFrame]:
    """All metrics of a typed Gold frame, from one scan of it."""
    return metrics_of_counts(pinned(match_counts(df)))


def metrics_of_counts(cube: DataFrame) -> dict[str, DataFrame]:
    """All metrics from counted combinations (``match_counts``); a combination may be there
    several times, once for each day that has it."""
    return {
        "row_count": row_count(cube, COUNT),
        "value_counts": value_counts(
            cube.withColumn("Resultado", result_label(F.col("match_winner"))), "Resultado", COUNT
        ),
        "result_distribution": result_distribution(cube, weight=COUNT),
        "goals_sum": goals_sum(cube, weight=COUNT),
        "goals_stats": goals_stats(cube, weight=COUNT),
        "stats_by_category": stats_by_category(cube, weight=COUNT),
        "goals_by_condition": goals_by_condition(cube, weight=COUNT),
        "goals_histogram": goals_histogram(cube, weight=COUNT),
        "elapsed_counts": elapsed_counts(cube, weight=COUNT),
        "results_by_season": results_by_season(cube, weight=COUNT),
    }


def metrics_report(metrics: Mapping[str, DataFrame]) -> DataFrame:
    """The metrics in one long table: metric, item, value."""

    def long(metric: str, df: DataFrame) -> DataFrame:
        text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        # Tables without a text column are keyed by their first column, one-row ones by none.
        single = metric in ("row_count", "goals_sum", "goals_stats")
        key = None if single else (text[0] if text else df.columns[0])
        values = [c for c in df.columns if c not in (key, "position")]
        item = "''" if key is None else f"cast({ticked(key)} AS STRING)"
        return _rows(
            df,
            "metric, item, measure, value",
            *[(_text(metric), item, _text(v), f"cast({ticked(v)} AS DOUBLE)") for v in values],
        )

    return reduce(DataFrame.unionByName, [long(m, df) for m, df in metrics.items()])

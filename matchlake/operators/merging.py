"""Keyed merges as DataFrame plans.

A merge compares a batch (source) with a stored table (target) on key columns.
Three things decide what that costs on a large table, and the plans below follow
from them:

* only key columns of the table are read to find out which keys are stored, and of
  those only the row groups within the batch's range of keys;
* when the batch's distinct keys are measured and small, they are broadcast, so
  the table is not shuffled at all; otherwise distinct keys are shuffled, which
  collapses the copies of a repeated key before the exchange;
* full rows are shuffled only if the deciding key set is too large to broadcast,
  and then keys with many copies are settled by a small broadcast list while
  their rows, and rows without a key, spread by input partition.

NULL keys never match, so such rows always count as new.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F, types as T

from matchlake.functions import quoted, ticked
from matchlake.session import pinned

_HIT, _HOT, _HOT_HIT, _SPREAD, _COPIES = "__hit", "__hot", "__hot_hit", "__spread", "__copies"
_CHOSEN = "__chosen"
#: Parts a hot key's rows are spread over at most.
_MOST_PARTS = 256


# Key types whose range is worth a scan filter.
_RANGED = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.StringType, T.DateType)


@dataclass(frozen=True)
class MergeLimits:
    """When a key set counts as small, and when a key counts as hot."""

    broadcast_rows: int = 2_000_000
    broadcast_bytes: int = 64 << 20
    # A key is hot above this share of the rows, so at most 1 / share keys are.
    hot_share: float = 1e-4


@dataclass(frozen=True)
class KeyProfile:
    """Size of a batch's key set, and the range of each key column."""

    rows: int
    distinct: int
    bytes: int
    max_copies: int
    ranges: tuple[tuple[str, object, object], ...] = ()

    def fits(self, limits: MergeLimits) -> bool:
        return self.distinct <= limits.broadcast_rows and self.bytes <= limits.broadcast_bytes


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, [quoted(k).isNull() for k in keys])


def key_copies(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Each complete key once, with its number of rows; combined map-side."""
    keys = _keys(keys)
    return (
        df.select(*[quoted(k) for k in keys])
        .filter(~_any_null(keys))
        .groupBy(*[quoted(k) for k in keys])
        .agg(F.count(F.lit(1)).alias(_COPIES))
    )


def distinct_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    return key_copies(df, keys).drop(_COPIES)


def _key_width(df: DataFrame, keys: Sequence[str]) -> Column:
    width = F.lit(0)
    for k in keys:
        is_text = isinstance(df.schema[k].dataType, (T.StringType, T.BinaryType))
        width = width + (F.octet_length(quoted(k)) if is_text else F.lit(8))
    return width


def profile_keys(copies: DataFrame, keys: str | Sequence[str]) -> KeyProfile:
    """Measure a ``key_copies`` frame: one distributed aggregate, one row back."""
    keys = _keys(keys)
    ranged = [k for k in keys if isinstance(copies.schema[k].dataType, _RANGED)]
    got = copies.agg(
        F.coalesce(F.sum(_COPIES), F.lit(0)),
        F.count(F.lit(1)),
        F.coalesce(F.sum(_key_width(copies, keys).cast("long")), F.lit(0)),
        F.coalesce(F.max(_COPIES), F.lit(0)),
        *[edge(quoted(k)) for k in ranged for edge in (F.min, F.max)],
    ).first()
    edges = zip(ranged, got[4::2], got[5::2])
    return KeyProfile(*[int(x) for x in got[:4]], tuple(edges))


def near_keys(target: DataFrame, profile: KeyProfile) -> DataFrame:
    """The table's rows within the batch's key ranges, which hold every possible match.

    The bounds reach the Parquet scan, so where keys grow with time a daily batch
    reads the key column of the recent row groups only.
    """
    for key, low, high in profile.ranges:
        if low is not None:
            target = target.filter(quoted(key).between(F.lit(low), F.lit(high)))
    return target


def _rows_by_broadcast(
    rows: DataFrame, keyset: DataFrame, keys: list[str], present: bool
) -> DataFrame:
    marks = F.broadcast(keyset.withColumn(_HIT, F.lit(True)))
    marked = rows.join(marks, keys, "left")
    keep = quoted(_HIT).isNotNull() | _any_null(keys) if present else quoted(_HIT).isNull()
    return marked.filter(keep).select(*[quoted(c) for c in rows.columns])


def _rows_by_shuffle(
    rows: DataFrame,
    keyset: DataFrame,
    keys: list[str],
    present: bool,
    limits: MergeLimits,
    copies: DataFrame | None,
) -> DataFrame:
    if copies is None:
        copies = key_copies(rows, keys)
    keyed_rows = copies.agg(F.coalesce(F.sum(_COPIES), F.lit(0))).first()[0]
    hot_above = max(int(keyed_rows * limits.hot_share), 1)
    hits = keyset.withColumn(_HIT, F.lit(True))
    hot = (
        copies.filter(quoted(_COPIES) > hot_above)
        .join(hits.withColumnRenamed(_HIT, _HOT_HIT), keys, "left")
        .select(*[quoted(k) for k in keys], F.lit(True).alias(_HOT), quoted(_HOT_HIT))
    )
    # Rows whose fate is settled already get a spread value no stored key carries. The
    # other side's zero is computed from its key: a literal would be folded away, and
    # the exchange would then go by the key alone.
    settled = quoted(_HOT).isNotNull() | _any_null(keys)
    zero = F.pmod(F.hash(*[quoted(k) for k in keys]), F.lit(1))
    marked = (
        rows.join(F.broadcast(hot), keys, "left")
        .withColumn(_SPREAD, F.when(settled, 1 + F.spark_partition_id()).otherwise(0))
        .join(hits.withColumn(_SPREAD, zero), keys + [_SPREAD], "left")
    )
    hit = F.coalesce(quoted(_HIT), quoted(_HOT_HIT))
    keep = hit.isNotNull() | _any_null(keys) if present else hit.isNull()
    return marked.filter(keep).select(*[quoted(c) for c in rows.columns])


def rows_by_keyset(
    rows: DataFrame,
    keyset: DataFrame,
    keys: str | Sequence[str],
    present: bool,
    limits: MergeLimits = MergeLimits(),
    small: bool | None = None,
    copies: DataFrame | None = None,
) -> DataFrame:
    """Rows whose key is in (``present``) or not in a set of unique keys.

    Rows without a complete key are kept either way: for a merge they are new.
    ``small`` says that the key set was measured already; by default it is here.
    ``copies`` are the rows' ``key_copies`` where the caller has them at hand.
    """
    keys = _keys(keys)
    if small is None:
        small = profile_keys(keyset.withColumn(_COPIES, F.lit(1)), keys).fits(limits)
    if small:
        return _rows_by_broadcast(rows, keyset, keys, present)
    return _rows_by_shuffle(rows, keyset, keys, present, limits, copies)


def new_rows(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    limits: MergeLimits = MergeLimits(),
) -> DataFrame:
    """Source rows whose key the target does not hold; copies in the source all stay."""
    keys = _keys(keys)
    copies = key_copies(source, keys)
    incoming = copies.drop(_COPIES)
    profile = profile_keys(copies, keys)
    stored = near_keys(target, profile).select(*[quoted(k) for k in keys])
    if profile.fits(limits):
        # At most as many keys as the batch has, so this set is small as well.
        stored = stored.join(F.broadcast(incoming), keys, "left_semi").distinct()
        return rows_by_keyset(source, stored, keys, present=False, small=True)
    known = distinct_keys(stored, keys).withColumn(_HIT, F.lit(True))
    judged = pinned(copies.join(known, keys, "left"))
    fresh = judged.filter(quoted(_HIT).isNull()).select(*[quoted(k) for k in keys])
    return rows_by_keyset(source, fresh, keys, True, limits, copies=judged.drop(_HIT))


def merge_insert_new(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    limits: MergeLimits = MergeLimits(),
) -> DataFrame:
    """The merged table: stored rows untouched, unmatched source rows added."""
    return target.unionByName(new_rows(target, source, keys, limits))


def checked_unique(source: DataFrame, keys: str | Sequence[str]) -> KeyProfile:
    """Profile the batch; a key that occurs twice makes an upsert ambiguous."""
    keys = _keys(keys)
    profile = profile_keys(key_copies(source, keys), keys)
    if profile.max_copies > 1:
        raise ValueError(f"upsert source repeats a key of {keys} ({profile.max_copies} rows)")
    return profile


def unmatched_target(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    profile: KeyProfile,
    limits: MergeLimits = MergeLimits(),
) -> DataFrame:
    """Stored rows that an upsert leaves as they are."""
    return rows_by_keyset(
        target, distinct_keys(source, keys), keys, False, limits, profile.fits(limits)
    )


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    limits: MergeLimits = MergeLimits(),
) -> DataFrame:
    """The merged table: matched rows replaced by the source's, others added."""
    profile = checked_unique(source, keys)
    return unmatched_target(target, source, keys, profile, limits).unionByName(source)


_SAME_KEY = re.compile(r"\s*(source|target)\.(\w+)\s*=\s*(source|target)\.(\w+)\s*")


def equality_keys(condition: str | Column) -> list[str]:
    """The keys of a condition that only equates like-named columns of both sides.

    ``target.id = source.id and target.day = source.day`` gives ``[id, day]``; any other
    condition gives nothing.
    """
    if not isinstance(condition, str):
        return []
    found = [_SAME_KEY.fullmatch(part) for part in re.split(r"\band\b", condition, flags=re.I)]
    if not all(m and m[1] != m[3] and m[2] == m[4] for m in found):
        return []
    return [m[2] for m in found]


_WORD = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|\(|\)|\w+|.""", re.S)


def _conjuncts(condition: str) -> list[str]:
    """The parts of a condition that AND joins at its outermost level."""
    parts, depth, between = [""], 0, False
    for word in _WORD.findall(condition):
        depth += (word == "(") - (word == ")")
        lower = word.lower()
        if lower in ("or", "not") and depth == 0 or lower == "case":
            return [condition]  # another structure: taken as a whole
        if lower == "and" and depth == 0 and not between:
            parts.append("")
            continue
        between = depth == 0 and (lower == "between" or between and lower != "and")
        parts[-1] += word
    return parts


def equated(condition: str | Column) -> list[tuple[str, str]]:
    """(source column, target column) that a condition equates among other things."""
    if not isinstance(condition, str):
        return []
    found = [_SAME_KEY.fullmatch(part) for part in _conjuncts(condition)]
    pairs = [(m[2], m[4]) if m[1] == "source" else (m[4], m[2]) for m in found if m and m[1] != m[3]]
    return list(dict.fromkeys(pairs))


def _needed(target: DataFrame, joined: Callable[[DataFrame], DataFrame]) -> list[str]:
    """The target's columns without which the join is not valid."""
    joined(target)
    needed = []
    for column in target.columns:
        try:
            joined(target.drop(column))
        except AnalysisException:
            needed.append(column)
    return needed


def _refuse_all_pairs(df: DataFrame) -> None:
    plan = df._jdf.queryExecution().sparkPlan().toString()
    if "NestedLoop" in plan or "CartesianProduct" in plan:
        raise ValueError("the merge condition needs an equality between source and target")


def new_rows_where(
    target: DataFrame,
    source: DataFrame,
    condition: str | Column,
    limits: MergeLimits = MergeLimits(),
) -> DataFrame:
    """Source rows no target row matches, for a condition over ``source`` and ``target``.

    The condition must hold at least one equality between the two sides; a plan
    that would compare every pair is refused. Use keys where they are enough:
    they have the measured plans.

    Where a condition in text equates columns, source rows that lack one of them are new
    without a join. Keys with many source rows are spread over tasks: their rows by input
    partition, the stored rows they are compared with to every part.
    """
    test = F.expr(condition) if isinstance(condition, str) else condition

    def unmatched(rows: DataFrame, stored: DataFrame, more: Column | None = None) -> DataFrame:
        on = test if more is None else test & more
        return rows.alias("source").join(stored.alias("target"), on, "left_anti")

    # Only the columns the condition needs, each combination once: copies collapse
    # before the exchange.
    needed = _needed(target, lambda stored: unmatched(source, stored))
    stored = target.select(*[quoted(c) for c in needed]).distinct()
    _refuse_all_pairs(unmatched(source, stored))
    pairs = equated(condition)
    if not pairs:
        return unmatched(source, stored)
    own = list(dict.fromkeys(p[0] for p in pairs))
    keyed = source.filter(~_any_null(own))
    copies = key_copies(source, own)
    total, most = copies.agg(F.coalesce(F.sum(_COPIES), F.lit(0)), F.coalesce(F.max(_COPIES), F.lit(0))).first()
    hot_above = max(int(total * limits.hot_share), 1)
    if most <= hot_above:
        return unmatched(keyed, stored).unionByName(source.filter(_any_null(own)))
    parts = F.least(F.ceil(quoted(_COPIES) / hot_above), F.lit(_MOST_PARTS)).cast("int").alias(_HOT)
    hot = copies.filter(quoted(_COPIES) > hot_above).select(*[quoted(k) for k in own], parts)
    hot = F.broadcast(pinned(hot))
    many = F.coalesce(quoted(_HOT), F.lit(1))
    # Parts are told apart in the join by a column no key can fold into a constant.
    rows = keyed.join(hot, own, "left").withColumn(_SPREAD, F.pmod(F.spark_partition_id(), many)).drop(_HOT)
    by_target = {t: s for s, t in reversed(pairs)}
    hot_there = F.broadcast(hot.select(*[quoted(s).alias(t) for t, s in by_target.items()], quoted(_HOT)))
    spread = stored.join(hot_there, list(by_target), "left")
    spread = spread.withColumn(_SPREAD, F.explode(F.sequence(F.lit(0), many - 1))).drop(_HOT)
    found = unmatched(rows, spread, F.col(f"source.{_SPREAD}") == F.col(f"target.{_SPREAD}"))
    return found.drop(_SPREAD).unionByName(source.filter(_any_null(own)))


def matching_pairs(
    target: DataFrame,
    source: DataFrame,
    condition: str | Column,
    target_id: Sequence[str],
    source_id: str,
) -> DataFrame:
    """Ids of the target and source rows that match each other; an equality is needed."""
    test = F.expr(condition) if isinstance(condition, str) else condition

    def matched(stored: DataFrame) -> DataFrame:
        return stored.alias("target").join(source.alias("source"), test)

    needed = _needed(target.drop(*target_id), matched)
    slim = target.select(*[quoted(c) for c in dict.fromkeys([*needed, *target_id])])
    found = matched(slim).select(*[quoted(c) for c in target_id], quoted(source_id))
    _refuse_all_pairs(found)
    return found


def of_one_document(
    df: DataFrame, keys: str | Sequence[str], document: str, latest: bool = False
) -> DataFrame:
    """Of each key the rows of one document, the earliest or the latest that has the key.

    What is stored then does not depend on how many documents came in one batch. Copies
    within the document stay, and so do rows without a key.
    """
    keys = _keys(keys)
    pick = F.max if latest else F.min
    # Rows without a key would all meet in one task.
    keyless, df = df.filter(_any_null(keys)), df.filter(~_any_null(keys))
    chosen = df.groupBy(*[quoted(k) for k in keys]).agg(pick(quoted(document)).alias(_CHOSEN))
    same = [F.col(f"l.{ticked(k)}") == F.col(f"r.{ticked(k)}") for k in keys]
    both = df.alias("l").join(chosen.alias("r"), reduce(and_, same)).select("l.*", _CHOSEN)
    return both.filter(quoted(document) == quoted(_CHOSEN)).drop(_CHOSEN).unionByName(keyless)


def one_per_key(
    df: DataFrame, keys: str | Sequence[str], latest_by: str | None = None
) -> DataFrame:
    """Optional clean-up of a batch: one row per key, the one with the largest ``latest_by``
    (without it the largest row, which makes the choice repeatable).

    Partial aggregation keeps one candidate per key and task, whatever the number
    of copies; rows without a key are kept as they are.
    """
    keys = _keys(keys)
    row = F.struct(*[quoted(c) for c in df.columns])
    order = row if latest_by is None else F.struct(quoted(latest_by), row)
    best = (
        df.filter(~_any_null(keys))
        .groupBy(*[quoted(k) for k in keys])
        .agg(F.max_by(row, order).alias("row"))
        .select("row.*")
    )
    return best.unionByName(df.filter(_any_null(keys)))

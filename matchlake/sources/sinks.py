"""Writing tables: modes, keyed merges, exports."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from matchlake.functions import quoted
from matchlake.operators.merging import (
    MergeLimits,
    checked_unique,
    distinct_keys,
    equality_keys,
    matching_pairs,
    near_keys,
    new_rows,
    new_rows_where,
    rows_by_keyset,
    unmatched_target,
)
from matchlake.session import scratch_dir
from matchlake.sources import files
from matchlake.sources.exchange import Batch, batch_done, exchange, finish
from matchlake.sources.tables import (
    NEW,
    OLD,
    load_info,
    read_table,
    recover,
    save_info,
    table_exists,
)

MODES = ("overwrite", "append", "error", "ignore")


def _listed(columns: str | Sequence[str] | None) -> tuple[str, ...]:
    if columns is None:
        return ()
    return (columns,) if isinstance(columns, str) else tuple(columns)


def _writer(df: DataFrame, partition: Sequence[str]):
    """Partitioned writes gather each day's rows, so a day is few files, not one per task.

    REBALANCE lets adaptive execution cut a day that holds much of the data into
    several tasks and files, and join small days into one task.
    """
    if not partition:
        return df.write
    return df.hint("rebalance", *partition).write.partitionBy(*partition)


def _put(df: DataFrame, path: str, partition: Sequence[str], mode: str) -> None:
    _writer(df, partition).mode(mode).parquet(path)


def _fitted(
    df: DataFrame, path: str, partition_cols: str | Sequence[str] | None = None
) -> tuple[DataFrame, tuple[str, ...]]:
    """Order and type the columns as the stored table has them, and tell its partitioning.

    A table some other writer made has no schema file; its partition columns are then
    those the caller names.
    """
    spark = df.sparkSession
    info = load_info(spark, path)
    schema = info.schema if info else read_table(spark, path).schema
    extra = sorted(set(df.columns) - set(schema.names))
    if extra:
        raise ValueError(f"columns not in the table at {path}: {extra}")
    fitted = df.select(*[quoted(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return fitted, info.partition if info else _listed(partition_cols)


def _settle(spark: SparkSession, path: str) -> None:
    """Finish what an earlier writer left half done."""
    recover(spark, path)
    finish(spark, path)


@contextmanager
def _held(df: DataFrame) -> Iterator[DataFrame]:
    """A batch in the shared scratch folder, for steps that read it several times."""
    path = scratch_dir(df.sparkSession, "batch")
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        files.delete(df.sparkSession, path)


def _replace(df: DataFrame, path: str, partition: Sequence[str]) -> None:
    """Write beside the table, then swap: a failed job leaves the old table whole, and
    the frame may read the table it replaces. A swap that breaks off is finished when the
    table is opened next (``tables.recover``)."""
    spark = df.sparkSession
    mark = uuid.uuid4().hex[:8]
    staged, old = f"{path}{NEW}{mark}", f"{path}{OLD}{mark}"
    recover(spark, path)
    save_info(spark, staged, df.schema, partition)
    _put(df, staged, partition, "append")
    if files.exists(spark, path):
        files.rename(spark, path, old)
    else:
        files.make_parents(spark, path)
    files.rename(spark, staged, path)
    if files.exists(spark, old):
        files.delete(spark, old)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_cols: str | Sequence[str] | None = None,
) -> None:
    """Save a frame as a table, optionally partitioned by one or several columns.

    ``overwrite`` replaces the table, ``append`` adds rows as they are, ``error`` raises
    and ``ignore`` does nothing when the table exists. The first write fixes the
    partition columns of later appends.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, use one of {MODES}")
    spark = df.sparkSession
    partition = _listed(partition_cols)
    _settle(spark, path)
    if mode == "overwrite":
        _replace(df, path, partition)
        return
    if table_exists(spark, path):
        if mode == "error":
            raise FileExistsError(f"table exists: {path}")
        if mode == "append":
            fitted, stored_partition = _fitted(df, path, partition)
            _put(fitted, path, stored_partition, "append")
        return
    # Schema first: should the write fail, a rerun finds an empty table with its types.
    save_info(spark, path, df.schema, partition)
    _put(df, path, partition, "append")


def save_new(
    source: DataFrame,
    path: str,
    keys: str | Sequence[str],
    partition_cols: str | Sequence[str] | None = None,
    limits: MergeLimits = MergeLimits(),
    batch: Batch | None = None,
) -> None:
    """Add the rows whose key is not stored yet; stored rows never change.

    Without a table the batch is written as it is. Appending while reading is safe, as
    the files to read are listed before. A rerun adds nothing (rows without a key
    excepted); with ``batch``, a stream's name and number, one that comes again adds nothing
    at all. Two writers at once are not kept apart: Parquet has no transactions.
    """
    spark = source.sparkSession
    _settle(spark, path)
    if not table_exists(spark, path):
        if batch is None:
            write_table(source, path, "append", partition_cols)
            return
        save_info(spark, path, source.schema, _listed(partition_cols))
    if batch_done(spark, path, batch):
        return
    fitted, partition = _fitted(source, path, partition_cols)
    fresh = new_rows(read_table(spark, path), fitted, keys, limits)
    if batch is None:
        _put(fresh, path, partition, "append")
    else:
        exchange(spark, path, lambda folder: _put(fresh, folder, partition, "append"), batch=batch)


def merge_where(
    source: DataFrame,
    path: str,
    condition: str | Column,
    partition_cols: str | Sequence[str] | None = None,
) -> None:
    """``save_new`` for a condition over the aliases ``source`` and ``target``.

    A condition that just equates keys takes the measured plan of ``save_new``; for others
    hot keys and rows without a key are settled apart (``new_rows_where``).
    """
    keys = equality_keys(condition)
    if keys:
        save_new(source, path, keys, partition_cols)
        return
    spark = source.sparkSession
    _settle(spark, path)
    if not table_exists(spark, path):
        write_table(source, path, "append", partition_cols)
        return
    fitted, partition = _fitted(source, path, partition_cols)
    _put(new_rows_where(read_table(spark, path), fitted, condition), path, partition, "append")


_FILE, _AT, _FROM = "__file", "__at", "__from"
#: Files that are named one by one to the reader; more are found by a join.
LISTED_FILES = 5000


def _with_places(df: DataFrame) -> DataFrame:
    """A table's rows with their file and their number in it."""
    return df.select(
        "*", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_AT)
    )


def _of_files(spark: SparkSession, path: str, uris: list[str]) -> DataFrame:
    """The rows of some files of a table, with their places."""
    info = load_info(spark, path)
    schema = info.schema if info else read_table(spark, path).schema
    if not uris:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn(_FILE, F.lit("")).withColumn(_AT, F.lit(0).cast("long"))
    if len(uris) > LISTED_FILES:
        listed = F.broadcast(spark.createDataFrame([(u,) for u in uris], f"{_FILE} string"))
        return _with_places(read_table(spark, path)).join(listed, _FILE, "left_semi")
    names = [f"{path}/{files.inside(spark, path, u)}" for u in uris]
    df = spark.read.schema(schema).option("basePath", path).parquet(*names)
    return _with_places(df.select(*[quoted(c) for c in schema.names]))


def save_upsert(
    source: DataFrame,
    path: str,
    keys: str | Sequence[str],
    partition_cols: str | Sequence[str] | None = None,
    limits: MergeLimits = MergeLimits(),
    batch: Batch | None = None,
) -> list[tuple]:
    """Replace the rows whose key is stored and add the others; repeated keys raise.

    Only files that hold a matched key are rewritten, whatever partition their rows move
    to; all others keep their names. A break-off at any step loses no row (``exchange``).
    Without a table the batch is written, unpartitioned unless ``partition_cols`` says
    otherwise. ``batch`` is as in ``save_new``. Returns the partitions that replaced rows
    were in, as tuples of their values.
    """
    spark = source.sparkSession
    keys = list(_listed(keys))
    _settle(spark, path)
    if not table_exists(spark, path):
        if batch is None:
            checked_unique(source, keys)
            write_table(source, path, "append", partition_cols)
            return []
        save_info(spark, path, source.schema, _listed(partition_cols))
    if batch_done(spark, path, batch):
        return []
    fitted, partition = _fitted(source, path, partition_cols)
    with _held(fitted) as rows:
        profile = checked_unique(rows, keys)
        slim = near_keys(read_table(spark, path), profile).select(
            *[quoted(c) for c in dict.fromkeys([*keys, *partition])], F.col("_metadata.file_path").alias(_FILE)
        )
        complete = reduce(and_, [quoted(k).isNotNull() for k in keys])
        incoming = distinct_keys(rows, keys)
        matched = rows_by_keyset(
            slim.filter(complete), incoming, keys, True, limits, profile.fits(limits)
        )
        # Files, not rows, come to the driver, which lists the table's files anyway.
        places = matched.select(_FILE, *[quoted(p) for p in partition]).distinct().collect()
        uris = sorted({r[0] for r in places})
        stored = _of_files(spark, path, uris).drop(_FILE, _AT)
        kept = unmatched_target(stored, rows, keys, profile, limits)
        result = kept.unionByName(rows)
        exchange(spark, path, lambda folder: _put(result, folder, partition, "append"), uris, batch)
        return list({tuple(r)[1:] for r in places}) if partition else []


def replace_partitions(df: DataFrame, path: str, column: str, values: Iterable[object]) -> None:
    """Put rows in the place of all that is stored of some partitions; others stay as they are."""
    spark, values = df.sparkSession, list(values)
    _settle(spark, path)
    if not table_exists(spark, path):
        write_table(df, path, "append", column)
        return
    fitted, partition = _fitted(df, path, column)
    held = read_table(spark, path).filter(quoted(column).isin(values))
    uris = [r[0] for r in held.select(F.col("_metadata.file_path")).distinct().collect()]
    exchange(spark, path, lambda folder: _put(fitted, folder, partition, "append"), uris)


def save_upsert_where(
    source: DataFrame,
    path: str,
    condition: str | Column,
    partition_cols: str | Sequence[str] | None = None,
    limits: MergeLimits = MergeLimits(),
) -> None:
    """``save_upsert`` for a condition over the aliases ``source`` and ``target``.

    A stored row that a source row matches is replaced by it, so a source row may replace
    several; unmatched source rows are added. A stored row that several source rows match
    is ambiguous, and raises before anything is changed. The condition must hold at least
    one equality between the sides.
    """
    spark = source.sparkSession
    _settle(spark, path)
    if not table_exists(spark, path):
        write_table(source, path, "append", partition_cols)
        return
    fitted, partition = _fitted(source, path, partition_cols)
    columns = [quoted(c) for c in fitted.columns]
    with _held(fitted) as rows:
        numbered = _with_places(rows).withColumn(_FROM, F.struct(_FILE, _AT)).drop(_FILE, _AT)
        stored = _with_places(read_table(spark, path))
        with _held(matching_pairs(stored, numbered, condition, (_FILE, _AT), _FROM)) as pairs:
            if not pairs.groupBy(_FILE, _AT).count().filter("count > 1").isEmpty():
                raise ValueError("several rows of the upsert's source match one stored row")
            uris = [r[0] for r in pairs.select(_FILE).distinct().collect()]
            kept = _of_files(spark, path, uris).join(pairs, [_FILE, _AT], "left_anti").select(*columns)
            replaced = numbered.join(pairs, _FROM).select(*columns)
            added = numbered.join(pairs, _FROM, "left_anti").select(*columns)
            result = kept.unionByName(replaced).unionByName(added)
            exchange(spark, path, lambda folder: _put(result, folder, partition, "append"), uris)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header, commas, missing values as empty fields; replaced on each run.

    One file means one task, so ``single_file`` is for exports known to be small.
    """
    out = df.coalesce(1) if single_file else df
    (
        out.write.mode("overwrite")
        .option("header", True)
        .option("emptyValue", "")
        .option("escape", '"')
        .csv(path)
    )


def export_parquet(df: DataFrame, path: str, single_file: bool = False) -> None:
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").parquet(path)

"""One run of the whole flow; call it from any scheduler."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from matchlake.plans import bronze
from matchlake.plans.gold import Gold, gold_fixtures, refresh_counts
from matchlake.plans.silver import silver_fixtures, silver_leagues
from matchlake.schemas import ENTITIES, Entity
from matchlake.session import configure
from matchlake.sources import (
    export_csv,
    export_parquet,
    read_days,
    read_table,
    split_documents,
    table_path,
    write_table,
)
from matchlake.sources import files
from matchlake.sources.landing import parse_documents, parsed_once, read_documents, store_rejects


#: The Gold table of counted combinations.
COUNTS = "fixtures_counts"


@dataclass(frozen=True)
class Lake:
    """Where a run reads and writes, and how it merges.

    Landed documents are below ``<landing>/<entity>``; those of matches in one folder per
    day below that, named by ``day_folder``.
    """

    root: str
    landing: str
    source: str = "feed"
    layout: str = "document"
    day_folder: str = "{day}"
    merge_mode: str = "insert"
    dedup_source: bool = False
    # Offer Gold all of Silver instead of the days handed over: a repair, after which an
    # insert-only Gold holds the same as without it, unless a table was changed by hand.
    gold_rereads_all: bool = False
    # Keep the counts of every day that ``plans.gold.stored_metrics`` makes all metrics from.
    count: bool = False
    export: bool = True
    export_single_file: bool = False

    def table(self, layer: str, entity: str) -> str:
        return table_path(self.root, layer, self.source, entity)

    def landed(self, entity: str, day: dt.date) -> str:
        return f"{self.landing}/{entity}/{self.day_folder.format(day=day)}"


def _as_date(value: str | dt.date) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def _landed_paths(
    spark: SparkSession, lake: Lake, entity: Entity, first: dt.date, last: dt.date
) -> list[str]:
    """The folders to read; days on which nothing landed have none."""
    if not entity.partition:
        return [f"{lake.landing}/{entity.name}"]
    days = (first + dt.timedelta(days=n) for n in range((last - first).days + 1))
    paths = (lake.landed(entity.name, day) for day in days)
    return [p for p in paths if files.exists(spark, p)]


class _Handover:
    """Days a layer has taken in and the next one has not: a small file beside its table.

    It is written before the layer changes and cleared when the next one has followed, so
    days of a run that broke off are offered again by the run after it.
    """

    def __init__(self, spark: SparkSession, lake: Lake, to: str, entity: str):
        self.spark, self.path = spark, f"{lake.table(to, entity)}__pending"

    def days(self) -> set[str]:
        return set(json.loads(files.read_whole(self.spark, self.path) or "[]"))

    def add(self, days: Iterable[str]) -> None:
        self._put(self.days() | set(days))

    def clear(self, days: Iterable[str]) -> None:
        self._put(self.days() - set(days))

    def _put(self, days: set[str]) -> None:
        if days != self.days():
            files.make_parents(self.spark, self.path)
            files.write_whole(self.spark, self.path, json.dumps(sorted(days)))


def _days(first: dt.date, last: dt.date) -> list[str]:
    return [str(first + dt.timedelta(days=n)) for n in range((last - first).days + 1)]


def ingest(spark: SparkSession, lake: Lake, entity: Entity, first: dt.date, last: dt.date) -> None:
    """Landed documents to Bronze; what is unreadable in them, if anything, to the rejects table.

    A static entity is replaced as a whole, so an unreadable document of it stops the run
    after it was set aside, and the stored table stays; a record of it that does not fit is
    only set aside.

    For matches the days that Silver has to take over are noted: the run's own, or for
    upserts those the batch has matches on (days, not matches, come to the driver).
    """
    handover = _Handover(spark, lake, "silver", entity.name) if entity.keys else None
    if entity.keys and lake.merge_mode == "insert":
        handover.add(_days(first, last))
    paths = _landed_paths(spark, lake, entity, first, last)
    if not paths:
        return
    raw = read_documents(spark, paths, lake.layout, recursive=True)
    parsed = parse_documents(raw, entity.record, entity.data_field, entity.required)
    with parsed_once(parsed) as documents:
        records, rejects = split_documents(documents, ordered=bool(entity.keys), undeclared=True)
        target = lake.table("bronze", entity.name)
        store_rejects(rejects, lake.table("rejects", entity.name))
        if entity.keys:
            batch = bronze.delivered_fixtures(records, lake.merge_mode, dedup_source=lake.dedup_source)
            if lake.merge_mode == "upsert":
                found = batch.select("event_date").distinct().collect()
                handover.add(str(r["event_date"]) for r in found if r["event_date"] is not None)
            bronze.store(batch, target, lake.merge_mode)
            return
        unreadable = rejects.filter(F.col("reason").isin("invalid document", "no data field")).count()
        if unreadable:
            raise ValueError(f"{unreadable} unreadable documents of {entity.name}: its table is left as it was")
        bronze.load_static(records, target)


def refine_fixtures(spark: SparkSession, lake: Lake) -> Gold:
    """Bronze days to Silver, Silver to Gold and exports.

    Each layer reads the partitions of the days handed over to it, those of an earlier run
    that broke off included. ``Lake.gold_rereads_all`` offers Gold all of Silver instead.
    """
    to_silver, to_gold = (_Handover(spark, lake, layer, "fixtures") for layer in ("silver", "gold"))
    to_counts = _Handover(spark, lake, "gold", COUNTS)
    source, target = lake.table("bronze", "fixtures"), lake.table("silver", "fixtures")
    days = to_silver.days()
    to_gold.add(days)
    to_counts.add(days)
    moved = bronze.store(silver_fixtures(read_days(spark, source, days)), target, lake.merge_mode)
    to_counts.add(moved)
    to_silver.clear(days)

    stored = lake.table("gold", "fixtures")
    gold = gold_fixtures(read_table(spark, target))
    days = to_gold.days()
    everything = lake.gold_rereads_all and lake.merge_mode == "insert"
    offered = gold if everything else gold_fixtures(read_days(spark, target, days))
    bronze.store(offered.curated, stored, lake.merge_mode)
    to_gold.clear(days)
    if lake.count:
        days = to_counts.days()
        full = gold_fixtures(read_days(spark, target, days)).full.withColumn("event_date", F.to_date("event_date"))
        refresh_counts(full, lake.table("gold", COUNTS), [dt.date.fromisoformat(d) for d in days])
        to_counts.clear(days)
    if lake.export:
        stem = lake.table("exports", "fixtures_gold")
        curated = read_table(spark, stored)
        export_csv(curated, f"{stem}.csv", lake.export_single_file)
        export_parquet(curated, f"{stem}.parquet", lake.export_single_file)
    return gold


def run(
    spark: SparkSession,
    lake: Lake,
    as_of: str | dt.date,
    entities: Iterable[str] = ("fixtures",),
    since: str | dt.date | None = None,
) -> Gold | None:
    """Process the day before ``as_of``, or all days from ``since`` up to it.

    Returns the Gold frames when matches were among the entities.
    """
    configure(spark)
    as_of = _as_date(as_of)
    since = None if since is None else _as_date(since)
    yesterday = as_of - dt.timedelta(days=1)
    gold = None
    for name in entities:
        entity = ENTITIES[name]
        ingest(spark, lake, entity, since or yesterday, yesterday)
        if name == "leagues":
            silver = silver_leagues(read_table(spark, lake.table("bronze", name)))
            write_table(silver, lake.table("silver", name), "overwrite")
        elif name == "fixtures":
            gold = refine_fixtures(spark, lake)
    return gold



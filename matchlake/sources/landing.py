"""Landed JSON documents: an envelope object whose field holds a list of records.

A document is parsed in two steps: its envelope into the texts of its records, and each
record by itself. A record that does not fit its declared schema is set aside alone, and so
is a document that is no envelope; whatever else was delivered with them is kept. Keys that
the schema does not declare are kept as text beside the declared fields.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from matchlake.functions import quoted, ticked
from matchlake.schemas import CORRUPT, DELIVERED, SOURCE_FILE, UNDECLARED
from matchlake.session import scratch_dir
from matchlake.sources import files
from matchlake.sources.sinks import write_table
from matchlake.sources.tables import read_table, table_exists

LAYOUTS = ("document", "lines")
_PARSING = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
_KEYS_AND_TEXTS = "map<string,string>"
_ENTRIES = "array<struct<key:string,value:string>>"


class Landing(NamedTuple):
    """Records, and what could not be turned into records (kept, never dropped)."""

    records: DataFrame
    rejects: DataFrame


def text_options(layout: str) -> dict[str, str]:
    """``document``: a file is one document. ``lines``: a line is one, and files split."""
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}")
    return {"wholetext": str(layout == "document").lower()}


def with_source_file(raw: DataFrame) -> DataFrame:
    """Name each document's file and place in the order of delivery as plain columns,
    which also survive caching."""
    landed = F.unix_millis("_metadata.file_modification_time").cast("string")
    delivered = F.concat(F.lpad(landed, 16, "0"), F.lit(" "), F.col("_metadata.file_path"))
    return raw.select(
        "value", F.col("_metadata.file_path").alias(SOURCE_FILE), delivered.alias(DELIVERED)
    )


def read_documents(
    spark: SparkSession, path: str | list[str], layout: str = "document", recursive: bool = False
) -> DataFrame:
    """The texts of landed documents (UTF-8), with file and order of delivery."""
    options = text_options(layout) | {"recursiveFileLookup": str(recursive).lower()}
    return with_source_file(spark.read.format("text").options(**options).load(path))


def _listed(text: Column) -> Column:
    """(d, corrupt) of a text that is a JSON list: the texts of its elements."""
    wrapped = F.concat(F.lit('{"d":'), text, F.lit("}"))
    return F.from_json(wrapped, f"d array<string>, {CORRUPT} string", _PARSING)


def _documents(raw: DataFrame) -> DataFrame:
    """(file, delivered, text, reason): documents, those of a top-level list one by one."""
    text = F.expr("trim(LEADING '\\uFEFF \\t\\r\\n' FROM value)")
    raw = raw.select(SOURCE_FILE, DELIVERED, text.alias("text")).filter("text <> ''")
    raw = raw.withColumn("list", F.when(F.col("text").startswith("["), _listed(F.col("text"))))
    broken = F.col("list").isNotNull() & F.col("list.d").isNull()
    parts = F.when(F.col("list.d").isNotNull(), F.col("list.d")).otherwise(F.array("text"))
    return raw.select(
        SOURCE_FILE,
        DELIVERED,
        F.explode(parts).alias("text"),
        F.when(broken, "invalid document").alias("reason"),
    )


def _envelopes_opened(
    documents: DataFrame, record: T.StructType, data_field: str | None, whole: bool
) -> DataFrame:
    """(file, delivered, direct, text, reason): texts of records, and documents that hold none.

    With ``whole`` a document all of whose records fit is parsed at once: its records are
    ``direct``, without a text.
    """
    if not data_field:
        return documents.withColumn("direct", F.lit(None).cast(record))

    def envelope(element: T.DataType) -> Column:
        fields = [T.StructField(data_field, T.ArrayType(element)), T.StructField(CORRUPT, T.StringType())]
        return F.from_json("text", T.StructType(fields), _PARSING)

    def held(name: str) -> Column:
        return F.col(f"{name}.{ticked(data_field)}")

    opened, fits = documents, F.lit(False)
    if whole:
        opened = opened.withColumn("typed", F.when(F.col("reason").isNull(), envelope(record)))
        fits = F.col(f"typed.{CORRUPT}").isNull() & held("typed").isNotNull()
    opened = opened.withColumn("fits", F.coalesce(fits, F.lit(False)))
    opened = opened.withColumn("envelope", F.when(~F.col("fits"), envelope(T.StringType())))
    reason = F.when(
        ~F.col("fits"),
        F.when(F.col("text").isNull() | F.col(f"envelope.{CORRUPT}").isNotNull(), "invalid document").when(
            held("envelope").isNull(), "no data field"
        ),
    )
    opened = opened.withColumn("reason", F.coalesce("reason", reason))
    texts = F.when(F.col("reason").isNull(), held("envelope")).otherwise(F.array("text"))
    # One of the two lists is empty, and its column then null.
    no_texts, no_records = F.array().cast("array<string>"), F.array().cast(T.ArrayType(record))
    direct = F.when(F.col("fits"), held("typed")).otherwise(no_records) if whole else no_records
    texts = F.when(F.col("fits"), no_texts).otherwise(texts)
    rows = F.arrays_zip(direct.alias("direct"), texts.alias("text"))
    return opened.select(SOURCE_FILE, DELIVERED, "reason", F.inline(rows).alias("direct", "text"))


def _nodes(record: T.StructType, path: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], T.StructType]]:
    """A record's struct fields with their paths, outer ones first."""
    yield path, record
    for f in record.fields:
        if isinstance(f.dataType, T.StructType):
            yield from _nodes(f.dataType, (*path, f.name))


def _undeclared(parsed: DataFrame, record: T.StructType) -> DataFrame:
    """Add the keys of ``text`` that the schema does not declare, as the text of an object.

    Their names are paths with dots, their values texts as delivered. A list whose elements
    have such keys is there as a whole. Every object is parsed on its own, level by level.
    """
    empty = F.array().cast(_ENTRIES)
    column = lambda path: "__" + ".".join(("node", *path))
    nodes = sorted(_nodes(record), key=lambda n: len(n[0]))
    entries = []
    for path, struct in nodes:
        source = F.col("text") if not path else quoted(column(path[:-1]))[path[-1]]
        parsed = parsed.withColumn(column(path), F.from_json(source, _KEYS_AND_TEXTS))
        held = quoted(column(path))
        prefix = "".join(f"{p}." for p in path)
        unlike = F.filter(F.map_entries(held), lambda e: ~e["key"].isin(struct.names))
        named = F.transform(unlike, lambda e: F.struct(F.concat(F.lit(prefix), e["key"]).alias("key"), e["value"].alias("value")))
        entries.append(F.coalesce(named, empty))
        for f in struct.fields:
            if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
                names = F.array(*[F.lit(n) for n in f.dataType.elementType.names])
                each = F.from_json(held[f.name], f"array<{_KEYS_AND_TEXTS}>")
                more = F.exists(each, lambda e: F.size(F.array_except(F.map_keys(e), names)) > 0)
                whole = F.array(F.struct(F.lit(prefix + f.name).alias("key"), held[f.name].alias("value")))
                entries.append(F.when(F.coalesce(more, F.lit(False)), whole).otherwise(empty))
    parsed = parsed.withColumn("__rest", F.array_sort(F.concat(*entries)))
    # Of a key that an object repeats, the last value in order counts.
    last = F.filter("__rest", lambda e, i: F.coalesce(F.get("__rest", i + 1)["key"] != e["key"], F.lit(True)))
    text = F.when(F.size("__rest") > 0, F.to_json(F.map_from_entries(last)))
    return parsed.withColumn(UNDECLARED, text).drop("__rest", *[column(p) for p, _ in nodes])


def parse_documents(
    raw: DataFrame,
    record: T.StructType,
    data_field: str | None = "response",
    required: Sequence[str] = (),
    undeclared: bool = True,
) -> DataFrame:
    """One row for each record, and for each document or record that is set aside.

    (file, delivered, record, undeclared, reason, document): ``reason`` is null for records.
    A record without a value of a ``required`` field (a path with dots) is set aside too.
    Where ``undeclared`` keys are not wanted, documents without a fault are parsed only once.
    """
    found = _envelopes_opened(_documents(raw), record, data_field, whole=not undeclared)
    schema = T.StructType([*record.fields, T.StructField(CORRUPT, T.StringType())])
    is_record = F.col("reason").isNull()
    by_text = is_record & F.col("text").isNotNull()
    found = found.withColumn("parsed", F.when(by_text, F.from_json("text", schema, _PARSING)))
    found = _undeclared(found, record) if undeclared else found.withColumn(UNDECLARED, F.lit(None).cast("string"))
    is_object = F.coalesce(F.ltrim("text").startswith("{"), F.lit(False))
    unfit = F.col("direct").isNull() & (F.col("parsed").isNull() | F.col(f"parsed.{CORRUPT}").isNotNull())
    # Without a data field the document is the record, so it may be broken as a whole.
    readable = F.from_json("text", _KEYS_AND_TEXTS).isNotNull()
    reason = F.when(~is_record, F.col("reason")).when(
        unfit,
        F.when(readable, "invalid value").otherwise(
            "invalid document" if not data_field else F.when(is_object, "invalid value").otherwise("invalid record")
        ),
    )
    one = F.struct(*[F.col(f"parsed.{ticked(n)}") for n in record.names]).cast(record)
    found = found.withColumn("why", reason).withColumn("one", F.coalesce("direct", one))
    reason = F.col("why")
    for path in required:
        reason = F.coalesce(reason, F.when(F.col(f"one.{path}").isNull(), f"no {path}"))
    found = found.withColumn("why", reason)
    set_aside = F.col("why").isNotNull()
    return found.select(
        SOURCE_FILE,
        DELIVERED,
        F.when(~set_aside, F.col("one")).alias("record"),
        F.when(~set_aside, F.col(UNDECLARED)).alias(UNDECLARED),
        F.col("why").alias("reason"),
        F.when(
            set_aside & (F.col("why") != "no data field"), F.coalesce("text", F.to_json("direct"))
        ).alias("document"),
    )


def split_documents(parsed: DataFrame, ordered: bool = False, undeclared: bool = False) -> Landing:
    """Records, and what was set aside with file, reason and text.

    With ``ordered`` each record names its document's place in the order of delivery, with
    ``undeclared`` it brings the keys its schema does not declare.
    """
    fields = [F.col(f"record.{ticked(n)}") for n in parsed.schema["record"].dataType.names]
    fields += [quoted(DELIVERED)] * ordered + [quoted(UNDECLARED)] * undeclared
    set_aside = F.col("reason").isNotNull()

    def where(condition: Column, *columns: Column) -> DataFrame:
        # No filter: it would be pushed below the parsing and parse every record again.
        return parsed.select(F.inline(F.when(condition, F.array(F.struct(*columns)))))

    return Landing(
        where(~set_aside, *fields),
        where(set_aside, quoted(SOURCE_FILE).alias("source_file"), F.col("reason"), F.col("document")),
    )


@contextmanager
def parsed_once(parsed: DataFrame) -> Iterator[DataFrame]:
    """Parsed documents in columns, for steps that read them several times: a table in the
    shared scratch folder, which outlives executors and goes in the end."""
    spark = parsed.sparkSession
    path = scratch_dir(spark, "landed")
    try:
        parsed.write.parquet(path)
        yield spark.read.schema(parsed.schema).parquet(path)
    finally:
        files.delete(spark, path)


def json_envelope(
    spark: SparkSession,
    path: str | list[str],
    record: T.StructType,
    data_field: str | None = "response",
    layout: str = "document",
    recursive: bool = False,
    undeclared: bool = False,
) -> Landing:
    """Read landed documents with a declared record schema.

    Without ``data_field`` the document itself (or each element of a top-level list)
    is the record.
    """
    raw = read_documents(spark, path, layout, recursive)
    parsed = parse_documents(raw, record, data_field, undeclared=undeclared)
    return split_documents(parsed, undeclared=undeclared)


def undeclared_value(name: str, column: str = UNDECLARED) -> Column:
    """The text of an undeclared key, by its path with dots; null where there is none."""
    return F.from_json(quoted(column), _KEYS_AND_TEXTS)[name]


def store_rejects(rejects: DataFrame, path: str) -> int:
    """Add the rejects that are not stored yet, so that a rerun adds none; returns how many
    were delivered. What one file repeats is stored once."""
    found = rejects.count()
    if not found:
        return 0
    rejects = rejects.dropDuplicates()
    spark = rejects.sparkSession
    if table_exists(spark, path):
        # Stored texts are compared by a hash, and only the hash is shuffled.
        names = ["source_file", "reason", "hash"]
        with_hash = lambda df: df.withColumn("hash", F.xxhash64("document"))
        stored = with_hash(read_table(spark, path)).select(*[F.col(c).alias(f"stored_{c}") for c in names])
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"stored_{c}")) for c in names])
        rejects = with_hash(rejects).join(stored, same, "left_anti").drop("hash")
    write_table(rejects, path, "append")
    return found

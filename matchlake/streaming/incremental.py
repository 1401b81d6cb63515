"""Landed match documents to Bronze as they arrive."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from matchlake.plans import bronze
from matchlake.schemas import ENTITIES
from matchlake.session import configure
from matchlake.sources import files, split_documents
from matchlake.sources.landing import (
    parse_documents,
    parsed_once,
    store_rejects,
    text_options,
    with_source_file,
)


def incremental_stream(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    layout: str = "document",
    merge_mode: str = "insert",
    rejects: str | None = None,
    files_per_batch: int = 1000,
    dedup_source: bool = False,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it ends once the folder is read.

    The checkpoint remembers the files that were read, and the table the last batch of the
    stream it holds, so a batch that is replayed after a failure adds nothing, matches
    without a key included. What is stored does not depend on ``files_per_batch``: of a match
    in several documents of a batch the first one counts, or the latest for upserts.
    """
    configure(spark)
    entity = ENTITIES["fixtures"]
    documents = with_source_file(
        spark.readStream.format("text")
        .options(
            **text_options(layout),
            maxFilesPerTrigger=files_per_batch,
            recursiveFileLookup="true",
        )
        .load(landing)
    )

    def merge(batch: DataFrame, number: int) -> None:
        # A stream keeps its id as long as its checkpoint, which numbers its batches.
        stream = json.loads(files.read_text(spark, f"{checkpoint}/metadata"))["id"]
        parsed = parse_documents(batch, entity.record, entity.data_field, entity.required)
        with parsed_once(parsed) as held:
            parts = split_documents(held, ordered=True, undeclared=True)
            bronze.load_fixtures(
                parts.records, table, merge_mode, dedup_source=dedup_source, batch=(stream, number)
            )
            if rejects:
                store_rejects(parts.rejects, rejects)

    writer = documents.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()

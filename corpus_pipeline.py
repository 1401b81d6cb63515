"""A training corpus from raw documents: filter, clean, deduplicate, mix, pack.

Each stage works on all rows its predecessor kept, written as Parquet between stages.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from matchlake.llm import line_dedup, mixing, near_dedup, packing, quality_rules
from matchlake.llm.common import BATCH_ROWS, Scratch, small_batches, table


#: What has to be left of a document that loses lines: as many words as the quality rules ask
#: for, and the share of words by which near copies are told.
LEAST_WORDS, LEAST_SHARE = 10, 0.2

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line repeats. One of which a fifth of its words
    or less than ten are left is a copy but for those, and goes."""
    return line_dedup.dedup_lines(docs, least_words=LEAST_WORDS, least_share=LEAST_SHARE)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.drop_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in training sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def _in_small_batches(stage: Stage) -> Stage:
    """A stage that moves few texts at once, whoever read the documents it is given."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        # What a task reads of a file at once stands in its memory as one array.
        spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality rules", _in_small_batches(quality)),
    ("line dedup", _in_small_batches(lines)),
    ("near duplicates", _in_small_batches(near_copies)),
    ("mixing", _in_small_batches(mixture)),
    ("packing", _in_small_batches(sequences)),
]

#: Rules on whole texts, word shingles and tokenizers are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "corpus")
    for at, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{at}")
    return docs

"""What several operators share: tables, scratch storage, words, connected components."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from matchlake.session import scratch_dir
from matchlake.sources import files

#: A word is a run of characters other than these six white-space characters.
SPACES = r"[\x20\x09-\x0D]+"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Rows of a batch sent to a Python worker: texts differ much in length.
BATCH_ROWS = 1000
#: Ids that are broadcast at most; beyond it they are joined by shuffle.
BROADCAST_IDS = 300_000


def small_batches(spark: SparkSession) -> None:
    """Fewer rows at once go to Python workers of this session from now on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables written below the shared folder, so that they outlive executors.

    They are removed when their user says so, or else when the application ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_dir(spark, name)
        files.make_parents(spark, f"{self.root}/x")
        files.delete_on_exit(spark, self.root)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            files.delete(self.spark, f"{self.root}/{name}")


def packed(docs: DataFrame, **columns: str) -> DataFrame:
    """Rows as one column ``row``, and some of its columns by names of our own beside it,
    so that no name of theirs can clash with one of ours."""
    quoted = lambda name: F.col(f"`{name}`")
    row = F.struct(*[quoted(c) for c in docs.columns]).alias("row")
    return docs.select(row, *[quoted(c).alias(name) for name, c in columns.items()])


def unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col("row")[c].alias(c) for c in columns])


def row_key(rows: DataFrame) -> tuple[Column, bool]:
    """What tells rows (id, text) apart, and whether that is more than the id.

    Where rows share an id or several lack one, it is the id with a hash of the text.
    """
    if rows.groupBy("id").count().filter("count > 1").isEmpty():
        return F.col("id"), False
    return F.struct(F.col("id").alias("id"), F.xxhash64("text").alias("mark")), True


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    plain = F.trim(F.regexp_replace(text, SPACES, " "))
    count = F.length(plain) - F.length(F.replace(plain, F.lit(" "), F.lit(""))) + 1
    return F.coalesce(F.when(plain == "", 0).otherwise(count), F.lit(0)).cast("long")


def few(df: DataFrame, rows: int) -> DataFrame:
    """For joins: a table of so many rows is sent to all executors if they are few."""
    return F.broadcast(df) if rows <= BROADCAST_IDS else df


def _star_check(e: DataFrame) -> tuple[int, int]:
    """Number of nodes, and of those that keep edges (a, b) from being one star for each component:
    an ``a`` with several ``b``, or one that is itself the ``b`` of others."""
    ends = e.select(F.col("a").alias("id"), F.col("b").alias("to")).union(e.select("b", F.lit(None)))
    nodes = ends.groupBy("id").agg(
        F.min("to").alias("least"), F.max("to").alias("most"), F.max(F.col("to").isNull()).alias("centre")
    )
    wrong = F.col("least").isNotNull() & (F.col("centre") | (F.col("least") < F.col("most")))
    return nodes.agg(F.count("*"), F.count_if(wrong)).first()


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(id, component): the smallest id reachable over edges (a, b), for ids that reach one
    smaller than themselves.

    Alternates large-star and small-star steps, each a minimum per node joined back, so
    a hub with very many neighbours is aggregated before it is shuffled, until the edges
    are stars. Steps are written tables.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = scratch.keep(e.filter("a <> b").distinct(), f"{name}-0")
    step = 0
    while True:
        nodes, wrong = _star_check(e)
        if not wrong:
            return e.select(F.col("a").alias("id"), F.col("b").alias("component"))
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Large star: every larger neighbour of a node points to the node's least neighbour.
        large = both.filter("b > a").join(few(least, nodes), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: a node and its smaller neighbours point to the least of them.
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(few(floor, nodes), "a").filter("b <> m").select(F.col("b").alias("a"), "m")
        small = small.union(floor.select("a", "m")).distinct().withColumnRenamed("m", "b")
        step += 1
        e = scratch.keep(small, f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")

"""Token ids in a compressed file format: byte or bit planes of fixed-size blocks.

The ids of all documents follow one another in ascending order of document id. Documents
are dealt to shards by ranges of their id; the flow of ids of a shard is cut into blocks of
a fixed number of ids. A block is stored as its planes: byte k (or bit k) of every id one
after the other, each plane compressed with zstandard. A chunk is a row of a Parquet table
(Spark then handles commits, retries and any file system):

    shard, chunk   place of the block
    n_ids          ids in the block
    planes         compressed planes, lowest byte (or bit) first
    docs           the chunk index: documents with ids here, each with its number in the
                   shard, its id, the place of its first id in the shard, its number of
                   ids, and where its ids start and how many there are in this chunk

The index can be read without the planes, and any chunk can be decoded by itself.

Defined cases: a null or empty text has only the end token; documents without an id come
first; rows that repeat an id follow one another; a document may be longer than a block or
a shard and then spans many chunks; an empty table gives an empty table; further columns of
any name are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.window import Window

from matchlake.llm.tokens import encoder

BLOCK = 1 << 14
LEVEL = 3
#: Bytes of text a shard has, more or less.
SHARD_BYTES = 32 << 20


def split_planes(ids: np.ndarray, unit: str = "byte") -> list[bytes]:
    """The byte or bit planes of unsigned 32-bit ids, compressed."""
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if unit == "byte":
        planes = octets.T
    else:
        planes = np.packbits(np.unpackbits(octets, axis=1, bitorder="little").T, axis=1)
    packer = zstandard.ZstdCompressor(level=LEVEL)
    return [packer.compress(plane.tobytes()) for plane in planes]


def join_planes(planes: list[bytes], n: int) -> np.ndarray:
    opener = zstandard.ZstdDecompressor()
    raw = [np.frombuffer(opener.decompress(p), np.uint8) for p in planes]
    if len(planes) == 4:
        octets = np.stack(raw, axis=1)
    else:
        bits = np.stack([np.unpackbits(r)[:n] for r in raw], axis=1)
        octets = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(octets).view("<u4").ravel()


def _chunk_type(id_type: T.DataType) -> T.StructType:
    doc = T.StructType(
        [
            T.StructField("seq", T.LongType()),
            T.StructField("id", id_type),
            T.StructField("place", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("at", T.IntegerType()),
            T.StructField("take", T.IntegerType()),
        ]
    )
    return T.StructType(
        [
            T.StructField("shard", T.IntegerType()),
            T.StructField("chunk", T.IntegerType()),
            T.StructField("n_ids", T.IntegerType()),
            T.StructField("planes", T.ArrayType(T.BinaryType())),
            T.StructField("docs", T.ArrayType(doc)),
        ]
    )


class _Shard:
    """The flow of ids of one shard, given out in blocks."""

    def __init__(self, unit: str):
        self.unit, self.chunk, self.place, self.seq = unit, 0, 0, 0
        self.ids, self.docs, self.size = [], [], 0

    def add(self, key, ids: np.ndarray) -> Iterator[dict]:
        n, at = len(ids), 0
        while at < n:
            take = min(n - at, BLOCK - self.size)
            doc = {"seq": self.seq, "id": key, "place": self.place, "n": n, "at": self.size, "take": take}
            self.docs.append(doc)
            self.ids.append(ids[at : at + take])
            self.size += take
            at += take
            if self.size == BLOCK:
                yield self.block()
        self.place += n
        self.seq += 1

    def block(self) -> dict:
        planes = split_planes(np.concatenate(self.ids), self.unit)
        row = {"chunk": self.chunk, "n_ids": self.size, "planes": planes, "docs": self.docs}
        self.chunk += 1
        self.ids, self.docs, self.size = [], [], 0
        return row


def write_tokens(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end: int = 2,
    unit: str = "byte",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode whole texts, each with the end id, and write them below ``path``.

    Texts, not ids, are sorted: they are smaller, and each is encoded once.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    volume = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tied = slim.withColumn("tie", F.xxhash64("text"))
    parts = tied.repartitionByRange(max(1, -(-volume // SHARD_BYTES)), "id", "tie")
    ordered = parts.sortWithinPartitions("id", "tie").select(F.spark_partition_id().alias("shard"), "id", "text")
    schema = _chunk_type(slim.schema["id"].dataType)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, encode, last = to_arrow_schema(schema), encoder(vocabulary).encode_all, np.array([end], "<u4").tobytes()
        flow, number = _Shard(unit), 0

        def out(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([row | {"shard": number} for row in rows], arrow)

        for batch in batches:
            number = batch.column(0)[0].as_py() if len(batch) else number
            texts = (text or "" for text in batch.column(2).to_pylist())
            for key, ids in zip(batch.column(1).to_pylist(), encode(texts)):
                if rows := list(flow.add(key, np.frombuffer(ids + last, "<u4"))):
                    yield out(rows)
        if flow.size:
            yield out([flow.block()])

    ordered.mapInArrow(chunks, schema).write.parquet(path)


def _pieces(spark: SparkSession, path: str, name: str, kind: str, convert: Callable[[bytes], object]) -> DataFrame:
    """(shard, seq, id, place, n, chunk, take) of each document in each chunk, and what
    ``convert`` makes of its ids there."""
    table = spark.read.parquet(path).select("shard", "chunk", "n_ids", "planes", "docs")
    id_type = table.schema["docs"].dataType.elementType["id"].dataType.simpleString()

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = {c: batch.column(c)[at].as_py() for c in batch.schema.names}
                ids = join_planes(row["planes"], row["n_ids"])
                docs = row["docs"]
                pick = lambda field: pa.array([d[field] for d in docs])
                made = [convert(ids[d["at"] : d["at"] + d["take"]].tobytes()) for d in docs]
                where = [pa.array([row[k]] * len(docs), pa.int32()) for k in ("shard", "chunk")]
                id_kind = batch.schema.field("docs").type.value_type.field("id").type
                yield pa.RecordBatch.from_arrays(
                    [
                        *where,
                        pick("seq"),
                        pa.array([d["id"] for d in docs], id_kind),
                        pick("place"),
                        pick("n"),
                        pa.array([d["take"] for d in docs], pa.int32()),
                        pa.array(made),
                    ],
                    ["shard", "chunk", "seq", "id", "place", "n", "take", name],
                )

    kinds = f"shard int, chunk int, seq long, id {id_type}, place long, n long, take int, {name} {kind}"
    return table.mapInArrow(unfold, kinds)


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Each document's ids in each chunk, as little-endian unsigned 32-bit numbers."""
    return _pieces(spark, path, "ids", "binary", bytes)


def joined_crc(first: int, second: int, length: int) -> int:
    """Checksum of two parts, of their checksums and the byte length of the second."""
    zeros = bytes(length)
    return zlib.crc32(zeros, first) ^ zlib.crc32(zeros) ^ second


def digest(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from the files."""
    parts = _pieces(spark, path, "crc", "long", zlib.crc32)
    id_type = parts.schema["id"].dataType.simpleString()
    # A document lies in as many pieces as it has chunks; only their checksums are gathered.
    each = parts.groupBy("shard", "seq", "id", "place", "n").agg(
        F.sort_array(F.collect_list(F.struct("chunk", "take", "crc"))).alias("parts")
    )
    totals = spark.read.parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    located = each.join(F.broadcast(starts), "shard").select(
        "id", (F.col("base") + F.col("place")).alias("start"), "n", "parts"
    )

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = []
            for parts in batch.column("parts").to_pylist():
                crc = parts[0]["crc"]
                for part in parts[1:]:
                    crc = joined_crc(crc, part["crc"], 4 * part["take"])
                sums.append(crc)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sums, pa.int64())], ["id", "start", "n_tokens", "ids_crc32"]
            )

    found = located.mapInArrow(combine, f"id {id_type}, start long, n_tokens long, ids_crc32 long")
    return found.withColumnRenamed("id", id_col)

"""Approximate nearest neighbours by multiprobe p-stable hashing, for inner products.

A further coordinate makes the largest inner product the least distance: vectors are
lengthened to the greatest norm, queries brought to it. Each hash table cuts space along a
few random Gaussian (2-stable) directions into slots of equal width; the slots of all
directions name a bucket. A query looks into its own bucket and into those that differ in
slots whose border it is close to, in the order of their estimated success. What the
buckets of all tables hold is ranked by the exact inner product in double precision.

Equal vectors are gathered first and searched as one, with their smallest ids. Queries are
taken in blocks of bounded size, those of one bucket together, and a block meets the vectors
of the buckets its queries name: in a sorted partition its queries come first, then the
vectors pass by in batches, of which the best of each query so far are kept. Neither
candidates nor partial results leave a block, only the best of its queries, and its memory
is that of the queries and one batch.

Defined cases: vectors that are null, zero or hold null or non-finite components, and rows
without an id, take no part; only vectors of equal dimension are compared; rows that repeat
an id and vector count once; ties go to the smaller id; an empty table gives an empty
result; further columns of any name are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from matchlake.llm.common import Scratch

TABLES = 6
DIRECTIONS = 8
#: Width of a slot, in units of the greatest norm.
WIDTH = 2.15
PROBES = 200
#: Queries of a block, on average.
BLOCK = 4000
#: Part of the product of two norms by which sums over blocks may differ from exact ones.
ROUNDING = 1e-9


def perturbations(directions: int, number: int) -> list[tuple[int, ...]]:
    """Sets of borders to cross, by the order their distances have: most promising first.

    Border ranks 0 to 2m-1 stand for the sorted distances of a query to the lower and upper
    borders of its m slots; a set is scored by the expected squares of its distances.
    """
    m = directions
    j = np.arange(1, 2 * m + 1)
    low = j * (j + 1) / (4 * (m + 1) * (m + 2))
    k = 2 * m + 1 - j
    high = 1 - k / (m + 1) + k * (k + 1) / (4 * (m + 1) * (m + 2))
    square = np.where(j <= m, low, high)
    heap, out = [(square[0], (0,))], [()]
    while heap and len(out) < number:
        score, ranks = heapq.heappop(heap)
        # The borders of one slot stand at mirrored ranks; both cannot be crossed.
        if not any(2 * m - 1 - r in ranks for r in ranks):
            out.append(ranks)
        last = ranks[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (score - square[last] + square[last + 1], (*ranks[:-1], last + 1)))
            heapq.heappush(heap, (score + square[last + 1], (*ranks, last + 1)))
    return out


def _tables(dim: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.Generator(np.random.PCG64([5, dim]))
    return random.standard_normal((TABLES, DIRECTIONS, dim + 1)), random.random((TABLES, DIRECTIONS))


def _bucket(slots: np.ndarray) -> np.ndarray:
    """One 64-bit name for the slots in the last axis."""
    name = np.full(slots.shape[:-1], slots.shape[-1], np.uint64)
    for i in range(slots.shape[-1]):
        name = (name ^ slots[..., i].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        name ^= name >> np.uint64(29)
    return name.view(np.int64)


def _places(vectors: np.ndarray, norm: float, query: bool) -> np.ndarray:
    """Positions along all directions of all tables, in slots."""
    directions, shift = _tables(vectors.shape[1])
    own = np.linalg.norm(vectors, axis=1, keepdims=True)
    if query:
        long = np.hstack([vectors * (norm / own), np.zeros_like(own)])
    else:
        long = np.hstack([vectors, np.sqrt(np.maximum(norm**2 - own**2, 0))])
    return np.einsum("nd,tmd->ntm", long, directions) / (WIDTH * norm) + shift


def vector_buckets(vectors: np.ndarray, norm: float) -> np.ndarray:
    return _bucket(np.floor(_places(vectors, norm, False)))


def probe_buckets(vectors: np.ndarray, norm: float) -> np.ndarray:
    """(query, table, probe): the buckets a query looks into."""
    places = _places(vectors, norm, True)
    slots = np.floor(places)
    inside = places - slots
    distance = np.concatenate([inside, 1 - inside], axis=-1)
    order = np.argsort(distance, axis=-1, kind="stable")
    buckets = []
    for ranks in perturbations(DIRECTIONS, PROBES):
        moved = slots.copy()
        for r in ranks:
            border = order[..., r : r + 1]
            step = np.where(border < DIRECTIONS, -1.0, 1.0)
            at = border % DIRECTIONS
            np.put_along_axis(moved, at, np.take_along_axis(moved, at, -1) + step, -1)
        buckets.append(_bucket(moved))
    return np.stack(buckets, axis=-1)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < math.inf, F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _hashed(rows: DataFrame, query: bool) -> DataFrame:
    """(id, vector, dim, table, buckets) of (id, vector, dim, norm)."""
    kind = rows.schema["id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            for (dim, norm), part in frame.groupby(["dim", "norm"]):
                vectors = np.stack(part["vector"].to_numpy()).astype(np.float64)
                found = probe_buckets(vectors, norm) if query else vector_buckets(vectors, norm)[..., None]
                for t in range(TABLES):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(part["id"]),
                            pa.array(list(part["vector"]), batch.schema.field("vector").type),
                            pa.array([dim] * len(part), pa.int32()),
                            pa.array([t] * len(part), pa.int32()),
                            pa.array(list(found[:, t]), pa.list_(pa.int64())),
                        ],
                        ["id", "vector", "dim", "table", "buckets"],
                    )

    vector = rows.schema["vector"].dataType.simpleString()
    return rows.select("id", "vector", "dim", "norm").mapInArrow(
        hashed, f"id {kind}, vector {vector}, dim int, table int, buckets array<long>"
    )


class _Block:
    """The queries of a block, and the best vectors of each so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, buckets: list[np.ndarray], k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.norms = np.linalg.norm(vectors, axis=1)
        named = np.concatenate(buckets)
        asking = np.repeat(np.arange(len(ids)), [len(b) for b in buckets])
        order = np.argsort(named, kind="stable")
        self.named, self.asking = named[order], asking[order]
        self.least = np.full(len(ids), -np.inf)
        self.of = np.zeros(0, np.int64)
        self.found = np.zeros(0, ids.dtype)
        self.scores = np.zeros(0)

    def meet(self, ids: np.ndarray, vectors: np.ndarray, buckets: np.ndarray) -> None:
        order = np.argsort(buckets, kind="stable")
        ids, vectors, buckets = ids[order], vectors[order], buckets[order]
        names, starts = np.unique(buckets, return_index=True)
        ends = np.append(starts[1:], len(ids))
        low, high = np.searchsorted(self.named, names, "left"), np.searchsorted(self.named, names, "right")
        scores = np.full((len(self.ids), len(ids)), -np.inf)
        for i in np.flatnonzero(high > low):
            rows = np.unique(self.asking[low[i] : high[i]])
            scores[rows, starts[i] : ends[i]] = self.vectors[rows] @ vectors[starts[i] : ends[i]].T
        # What is not below the last of the best, but for rounding, is summed exactly.
        margin = ROUNDING * self.norms * np.linalg.norm(vectors, axis=1).max(initial=0)
        query, at = np.nonzero((scores > -np.inf) & (scores >= (self.least - margin)[:, None]))
        if not len(query):
            return
        # The sum over one pair's products is the same in whatever batch it is met.
        step = max(1, (1 << 22) // self.vectors.shape[1])
        exact = [
            (self.vectors[query[i : i + step]] * vectors[at[i : i + step]]).sum(axis=1)
            for i in range(0, len(query), step)
        ]
        of = np.concatenate([self.of, query])
        found = np.concatenate([self.found, ids[at]])
        scores = np.concatenate([self.scores, *exact])
        # Equal scores go by id; ids of any kind are ordered by their places among all.
        order = np.lexsort([np.unique(found, return_inverse=True)[1], -scores, of])
        of, found, scores = of[order], found[order], scores[order]
        rank = np.arange(len(of)) - np.searchsorted(of, of)
        best = rank < self.k
        self.of, self.found, self.scores = of[best], found[best], scores[best]
        last = rank[best] == self.k - 1
        self.least[self.of[last]] = self.scores[last]

    def best(self, kinds: tuple[pa.DataType, pa.DataType]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[self.of], kinds[0]), pa.array(self.found, kinds[1]), pa.array(self.scores, pa.float64())],
            ["query", "id", "score"],
        )


def _searched(k: int):
    """Best vectors of each query, from rows (table, block, bucket, id, vector, buckets) sorted
    such that a block's queries, without a bucket, come before the vectors it meets."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block, asking = None, None, []
        for batch in batches:
            kind = batch.schema.field("id").type
            frame = batch.to_pandas()
            for own, rows in frame.groupby(["dim", "table", "block"], sort=False):
                if own != key:
                    if block is not None:
                        yield block.best((kind, kind))
                    key, block, asking = own, None, []
                queries = rows[rows["bucket"].isna()]
                if len(queries):
                    asking.append(queries)
                met = rows[rows["bucket"].notna()]
                if len(met):
                    if block is None and asking:
                        all_ = pd.concat(asking)
                        vectors = np.stack(all_["vector"].to_numpy()).astype(np.float64)
                        block = _Block(all_["id"].to_numpy(), vectors, list(all_["buckets"]), k)
                    if block is not None:
                        vectors = np.stack(met["vector"].to_numpy()).astype(np.float64)
                        block.meet(met["id"].to_numpy(), vectors, met["name"].to_numpy())
        if block is not None:
            yield block.best((kind, kind))

    return searched


def search(
    rows: DataFrame, wanted: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest other rows of each row that is wanted."""
    scratch = Scratch(rows.sparkSession, "neighbours")
    kind = rows.schema[id_col].dataType.simpleString()
    slim = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), wanted.alias("wanted"))
    slim = slim.filter(F.col("id").isNotNull() & _usable(F.col("vector"))).distinct()
    # A vector's k+1 smallest ids are all that its copies can contribute.
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    firsts = slim.select("id", "vector", rank.alias("r")).filter(F.col("r") <= k + 1)
    alike = firsts.groupBy("vector").agg(F.min("id").alias("id"), F.sort_array(F.collect_set("id")).alias("ids"))
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    alike = alike.select("*", F.size("vector").alias("dim"), length.alias("length"))
    alike = scratch.keep(alike, "vectors")
    norms = alike.groupBy("dim").agg(F.max("length").alias("norm"))
    index = _hashed(alike.join(F.broadcast(norms), "dim"), False).withColumn("bucket", F.get("buckets", F.lit(0)))
    index = scratch.keep(index.select("dim", "table", "bucket", "id", "vector"), "index")
    asking = slim.filter("wanted").select("id", "vector", F.size("vector").alias("dim"))
    # The first bucket named is the query's own.
    probes = _hashed(asking.join(F.broadcast(norms), "dim"), True).withColumn("own", F.get("buckets", F.lit(0)))
    probes = scratch.keep(probes, "probes")
    blocks = max(1, math.ceil(probes.count() / TABLES / BLOCK))
    # Queries of one bucket share a block; a bucket with too many of them for one is cut.
    at = ["dim", "table", "own"]
    large = probes.groupBy(*at).count().filter(F.col("count") > BLOCK)
    large = large.select(*at, F.ceil(F.col("count") / BLOCK).alias("parts"))
    part = F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1)))
    block = F.pmod(F.xxhash64("own", part), F.lit(blocks)).alias("block")
    probes = probes.join(large, at, "left").select("dim", "table", block, "id", "vector", "buckets")

    by = ["dim", "table", "block"]
    named = probes.select(*by, F.explode("buckets").alias("bucket")).distinct()
    met = index.join(named, ["dim", "table", "bucket"])
    rows = probes.select(*by, F.lit(None).cast("long").alias("bucket"), "id", "vector", "buckets").unionByName(
        met.select(*by, "bucket", "id", "vector", F.lit(None).cast("array<long>").alias("buckets"))
    )
    # Nulls sort first. A copy of the name survives pandas, which turns numbers with nulls into floats.
    rows = rows.withColumn("name", F.coalesce("bucket", F.lit(0)))
    rows = rows.repartition(*by).sortWithinPartitions(*by, F.col("bucket").asc_nulls_first())
    rows = rows.select(*by, "bucket", "name", "id", "vector", "buckets")
    found = rows.mapInArrow(_searched(k + 1), f"query {kind}, id {kind}, score double")
    best = found.groupBy("query", "id").agg(F.max("score").alias("score"))
    # A vector after the first k+1 has as many ids before its own.
    first = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    best = best.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k + 1)
    best = best.join(alike.select("id", "ids"), "id").select("query", "score", F.explode("ids").alias("vec_id"))
    best = best.filter(F.col("query") != F.col("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = best.select("query", F.row_number().over(order).alias("rank"), "vec_id", "score")
    return ranked.filter(F.col("rank") <= k).select(F.col("query").alias("query_id"), "rank", "vec_id", "score")

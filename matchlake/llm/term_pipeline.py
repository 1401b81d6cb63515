"""Ranked lexical search by pipelined term partitioning.

Terms are runs of ASCII letters and digits and of characters beyond ASCII, only A-Z
lower-cased. A document's score for an item is the sum of integer contributions of the
item's terms, each once (``contributions``).

The vocabulary of the items is dealt to a row of owners, ``STAGES`` of them, the rarest
terms first and postings in equal parts. Documents are taken in blocks, in the order of the
table. For every item and block a bundle with a sparse accumulator of documents passes from
owner to owner: each stage is a cogroup of the bundles of a block with the owner's postings
of that block, which adds the contributions of the item's terms it owns. What leaves the
last stage are the best documents of each bundle, from which the best of all blocks are
selected. A posting is shuffled once, to its owner's stage.

An accumulator may lose a document before the end only where that cannot change the result:
k documents of the block have scores that it cannot reach even with the greatest
contributions the block holds for all of the item's terms still to come.

Bounds: items come in parts of about ``SLOTS`` pairs of item and term, whose vocabulary is
broadcast and searched for in one scan of the documents; blocks hold at most ``BLOCK_DOCS``
documents, or ``BLOCK_POSTINGS`` postings and one document; a group is the bundles of at
most ``GROUP`` items for one block.

Defined cases: null and empty texts have no terms and count for nothing; items that share an
id are searched as one with the terms of all; items without an id, or without a term that a
document holds, give no rows; documents without an id count in all statistics but are not
returned; documents that share an id, or repeat, are documents of their own, of equal
scores in the order of their ids; with an empty table the result is empty; further columns of
any name are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from matchlake.llm.common import Scratch

K = 10
STAGES = 3
SLOTS = 1_000_000
BLOCK_DOCS = 8192
BLOCK_POSTINGS = 2_000_000
GROUP = 500

#: Bytes of terms stay, A-Z in lower case; all others become spaces.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def contributions(weights: np.ndarray, tf: np.ndarray, sizes: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What a term adds to documents with ``sizes`` terms that hold it ``tf`` times."""
    m = 100 - 90 + (90 * sizes * documents) // length
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def _lists(flat: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, flat)])
    values = np.concatenate(flat) if flat else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def _cells(column: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    """The rows of a list column as arrays."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends, values = whole.offsets.to_numpy(), whole.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _slim(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def _item_terms(items: DataFrame) -> DataFrame:
    """(id, term) of the items with an id, each pair once."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [sorted(set(terms_of(t.as_py()))) for t in batch.column(1).cast(pa.binary())]
            at = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            words = pa.array([w for s in sets for w in s], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), words], ["id", "term"])

    kind = items.schema["id"].dataType.simpleString()
    return items.filter("id is not null").mapInArrow(found, f"id {kind}, term binary").distinct()


def _blocks(docs: DataFrame, codes: dict[bytes, int]) -> DataFrame:
    """Blocks of documents with their postings of the wanted terms.

    (block, ids, sizes, n_docs, n_terms, terms, ends, docs, tf): of each document its id and
    number of terms; of each wanted term by code where its postings end; postings are the
    places of documents in the block and frequencies.
    """
    wanted = docs.sparkSession.sparkContext.broadcast(codes)
    kind = docs.schema["id"].dataType.simpleString()

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = wanted.value
        names, part, number = known.keys(), TaskContext.get().partitionId(), 0
        ids: list[pa.Array] = []
        sizes: list[int] = []
        found: list[tuple[int, int, int]] = []

        def made() -> pa.RecordBatch:
            table = np.array(found, np.int64).reshape(-1, 3)
            table = table[np.lexsort([table[:, 1], table[:, 0]])]
            terms, starts = np.unique(table[:, 0], return_index=True)
            ends = np.append(starts[1:], len(table)) if len(terms) else starts
            named = pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), pa.concat_arrays(ids))
            one = lambda values, type_: _lists([np.asarray(values, np.int64)], type_)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) + number], pa.int64()),
                    named,
                    one(sizes, pa.int64()),
                    pa.array([sum(n > 0 for n in sizes)], pa.int64()),
                    pa.array([sum(sizes)], pa.int64()),
                    one(terms, pa.int32()),
                    one(ends, pa.int32()),
                    one(table[:, 1], pa.int32()),
                    one(table[:, 2], pa.int32()),
                ],
                ["block", "ids", "sizes", "n_docs", "n_terms", "terms", "ends", "docs", "tf"],
            )

        for batch in batches:
            at, texts = 0, batch.column(1).cast(pa.binary())
            for i in range(len(texts)):
                words = terms_of(texts[i].as_py())
                if words:
                    counts, doc = Counter(words), len(sizes)
                    found.extend([(known[w], doc, counts[w]) for w in counts.keys() & names])
                sizes.append(len(words))
                if len(sizes) >= BLOCK_DOCS or len(found) >= BLOCK_POSTINGS:
                    ids.append(batch.column(0).slice(at, i + 1 - at))
                    yield made()
                    ids, sizes, found, at, number = [], [], [], i + 1, number + 1
            ids.append(batch.column(0).slice(at))
        if sizes:
            yield made()

    return docs.mapInArrow(
        scanned,
        f"block long, ids array<{kind}>, sizes array<long>, n_docs long, n_terms long, "
        "terms array<int>, ends array<int>, docs array<int>, tf array<int>",
    )


def _index(blocks: DataFrame, owner: np.ndarray, weights: np.ndarray, documents: int, length: int) -> DataFrame:
    """A row for each block and owner: the contributions of its terms, and the greatest ones
    of all terms of later owners.

    (block, n, ids, terms, ends, docs, adds, later, most, stage); the last owner's row holds the ids.
    """
    shared = blocks.sparkSession.sparkContext.broadcast((owner, weights))
    ids_kind = blocks.schema["ids"].dataType.simpleString()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners, heavy = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                sizes, terms, ends, docs, tf = (
                    _cells(row.column(c))[0].astype(np.int64) for c in ("sizes", "terms", "ends", "docs", "tf")
                )
                of = np.repeat(np.arange(len(terms)), np.diff(ends, prepend=0))
                adds = contributions(heavy[terms][of], tf, sizes[docs], documents, max(length, 1))
                ids = row.column("ids")
                # Documents without an id are counted, and end here.
                named = ids.values.slice(ids.offsets[0].as_py(), len(sizes)).is_valid().to_numpy(zero_copy_only=False)
                fit = named[docs] & (adds > 0)
                of, docs, adds = of[fit], docs[fit], adds[fit]
                most = np.zeros(len(terms), np.int64)
                np.maximum.at(most, of, adds)
                stage = owners[terms]
                for s in range(STAGES):
                    own, later = np.flatnonzero(stage == s), np.flatnonzero((stage > s) & (most > 0))
                    mine = stage[of] == s
                    held = np.searchsorted(of[mine], own, side="right")
                    one = lambda values, kind: _lists([values], kind)
                    yield pa.RecordBatch.from_arrays(
                        [
                            row.column("block"),
                            pa.array([len(sizes)], pa.int32()),
                            ids if s == STAGES - 1 else pa.array([[]], ids.type),
                            one(terms[own], pa.int32()),
                            one(held, pa.int32()),
                            one(docs[mine], pa.int32()),
                            one(adds[mine], pa.int64()),
                            one(terms[later], pa.int32()),
                            one(most[later], pa.int64()),
                            pa.array([s], pa.int32()),
                        ],
                        ["block", "n", "ids", "terms", "ends", "docs", "adds", "later", "most", "stage"],
                    )

    return blocks.select("block", "ids", "sizes", "terms", "ends", "docs", "tf").mapInArrow(
        made,
        f"block long, n int, ids {ids_kind}, terms array<int>, ends array<int>, docs array<int>, adds array<long>, "
        "later array<int>, most array<long>, stage int",
    )


def _issued(blocks: DataFrame, items: dict, kind: str) -> DataFrame:
    """An empty bundle (block, group, item, codes, closed, docs, scores) for each item and block."""
    shared = blocks.sparkSession.sparkContext.broadcast(items)

    def issued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, codes = list(shared.value), list(shared.value.values())
        for batch in batches:
            for block in batch.column(0).to_pylist():
                for at in range(0, len(names), GROUP):
                    n = len(names[at : at + GROUP])
                    none = [np.zeros(0, np.int64)] * n
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([block] * n, pa.int64()),
                            pa.array([at // GROUP] * n, pa.int32()),
                            pa.array(names[at : at + GROUP], batch.schema.field(1).type),
                            _lists(codes[at : at + GROUP], pa.int32()),
                            pa.array([False] * n),
                            _lists(none, pa.int32()),
                            _lists(none, pa.int64()),
                        ],
                        ["block", "group", "item", "codes", "closed", "docs", "scores"],
                    )

    return blocks.select("block", F.lit(None).cast(kind).alias("item")).mapInArrow(issued, _BUNDLE.format(kind=kind))


_BUNDLE = "block long, group int, item {kind}, codes array<int>, closed boolean, docs array<int>, scores array<long>"


def _visit(bundles: pa.Table, postings: pa.Table, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """(bundle, docs, scores, closed) after an owner has added its contributions."""
    if not bundles.num_rows or not postings.num_rows:
        return
    terms, ends, docs, adds, later, most = (
        _cells(postings.column(c))[0] for c in ("terms", "ends", "docs", "adds", "later", "most")
    )
    dense = np.zeros(postings.column("n")[0].as_py(), np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    columns = [_cells(bundles.column(c)) for c in ("codes", "docs", "scores")]
    for i, (codes, held, scores, closed) in enumerate(zip(*columns, bundles.column("closed").to_pylist())):
        dense[:] = 0
        dense[held] = scores
        for t in np.flatnonzero(np.isin(terms, codes)):
            part = slice(starts[t], ends[t])
            dense[docs[part]] += adds[part]
        rest = int(most[np.isin(later, codes)].sum())
        # Once a document not held cannot be among the best, only those held are kept up.
        held = held if closed else np.flatnonzero(dense)
        scores = dense[held]
        if len(held) >= k:
            least = np.partition(scores, len(scores) - k)[-k]
            keep = scores + rest >= least
            held, scores, closed = held[keep], scores[keep], closed or rest < least
        yield i, held, scores, closed


def _passed_on(k: int):
    def step(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        seen = list(_visit(bundles, postings, k))
        kept = bundles.select(["block", "group", "item", "codes"]).take(pa.array([s[0] for s in seen], pa.int64()))
        kept = kept.append_column("closed", pa.array([bool(s[3]) for s in seen], pa.bool_()))
        kept = kept.append_column("docs", _lists([s[1] for s in seen], pa.int32()))
        return kept.append_column("scores", _lists([s[2] for s in seen], pa.int64()))

    return step


def _best(k: int):
    def step(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        ids = postings.column("ids").combine_chunks()
        item, docs, scores = [], [], []
        for i, held, found, _ in _visit(bundles, postings, k):
            names = ids.values.take(pa.array(held + ids.offsets[0].as_py(), pa.int64())).to_pylist()
            for score, name in sorted(zip((-found).tolist(), names))[:k]:
                if score < 0:
                    item.append(i)
                    docs.append(name)
                    scores.append(-score)
        return pa.table(
            {
                "item": bundles.column("item").take(pa.array(item, pa.int64())),
                "doc": pa.array(docs, ids.type.value_type),
                "score": pa.array(scores, pa.int64()),
            }
        )

    return step


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(item, rank, doc, score): the k documents of greatest score above 0 of each item."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "terms")
    docs, items = _slim(docs, id_col, text_col), _slim(items, item_col, item_text_col)
    item_kind, doc_kind = (x.schema["id"].dataType.simpleString() for x in (items, docs))
    asked = scratch.keep(_item_terms(items), "asked")
    parts = max(1, math.ceil(asked.count() / SLOTS))
    best = None
    for p in range(parts):
        pairs = asked.filter(F.pmod(F.xxhash64("id"), F.lit(parts)) == p).collect()
        codes = {term: i for i, term in enumerate(sorted({bytes(r["term"]) for r in pairs}))}
        found = _search_part(docs, pairs, codes, scratch, f"{p}", k, item_kind, doc_kind)
        best = found if best is None else best.union(found)
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item", "rank", "doc", "score")


def _search_part(
    docs: DataFrame, pairs: list, codes: dict[bytes, int], scratch: Scratch, name: str, k: int, item_kind: str, doc_kind: str
) -> DataFrame:
    spark = docs.sparkSession
    blocks = scratch.keep(_blocks(docs, codes), f"blocks-{name}")
    totals = blocks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    documents, length = int(totals[0]), int(totals[1])
    # Where the postings of a term end, and so how many documents of a block hold it.
    held = blocks.select(F.posexplode("terms").alias("at", "term"), "ends")
    held = held.select("term", (F.col("ends")[F.col("at")] - F.when(F.col("at") > 0, F.col("ends")[F.col("at") - 1]).otherwise(0)).alias("n"))
    holding = np.zeros(len(codes), np.int64)
    for term, n in held.groupBy("term").agg(F.sum("n")).collect():
        holding[term] = n
    weights = np.array([weight(documents, int(n)) if n else 0 for n in holding], np.int64)
    # Owners in the order of falling weight, with equal parts of the postings.
    order = np.lexsort([np.arange(len(codes)), holding])
    before = np.cumsum(holding[order]) - holding[order]
    owner = np.zeros(len(codes), np.int64)
    owner[order] = np.minimum(before * STAGES // max(int(holding.sum()), 1), STAGES - 1)

    index_path = f"{scratch.root}/index-{name}"
    index = _index(blocks, owner, weights, documents, max(length, 1))
    index.write.partitionBy("stage").parquet(index_path)
    index = spark.read.schema(index.schema).parquet(index_path)
    by_item: dict = {}
    for item, term in pairs:
        if holding[codes[bytes(term)]]:
            by_item.setdefault(item, []).append(codes[bytes(term)])
    by_item = {item: np.array(sorted(found), np.int64) for item, found in by_item.items()}
    groups = max(1, math.ceil(len(by_item) / GROUP))

    bundles = _issued(blocks.select("block"), by_item, item_kind)
    for s in range(STAGES):
        owned = index.filter(F.col("stage") == s).drop("stage")
        owned = owned.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        met = bundles.groupBy("block", "group").cogroup(owned.groupBy("block", "group"))
        if s < STAGES - 1:
            bundles = met.applyInArrow(_passed_on(k), _BUNDLE.format(kind=item_kind))
    return met.applyInArrow(_best(k), f"item {item_kind}, doc {doc_kind}, score long")

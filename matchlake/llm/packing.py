"""Packing of documents into sequences of bounded length by linear grouping.

All that decides how many sequences are needed is how many pieces there are of each
length, at most as many numbers as a sequence has places. So lengths are counted on the
cluster, the plan is made of the counts, and pieces are matched to the plan by their rank
within their length. Large lengths are rounded up within groups of equal cardinality; the
few sizes that remain are combined by a linear programme over all ways to fill a sequence
with them; actual pieces are substituted for the rounded ones; small pieces then go,
largest first, where they fit best.

Defined cases: a null or empty text has only the end token; a document of several times
the capacity is cut into full pieces and a rest; documents with a null id or a repeated id
are packed each for itself; an empty table gives an empty result; further columns of any
name are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations_with_replacement
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from matchlake.llm.common import Scratch
from matchlake.llm.ranking import ranked
from matchlake.llm.tokens import encoder

CAPACITY = 4096
#: Ways to plan, of which the one with the fewest sequences is taken: pieces longer than this
#: part of a sequence count as large, and go into so many groups.
GROUPINGS = ((1 / 5, 24), (1 / 3, 64))


class Bins(NamedTuple):
    """So many sequences alike: their first number, how many, places left and taken."""

    first: int
    count: int
    free: int
    used: int


class Slot(NamedTuple):
    """Pieces of one length: the next ``count`` of them, ``each`` in a sequence from ``first`` on."""

    length: int
    rank: int
    count: int
    first: int
    each: int
    offset: int


def grouped(large: list[tuple[int, int]], groups: int) -> list[list[tuple[int, int]]]:
    """(length, count) runs, longest first, cut into groups of equal cardinality."""
    total = sum(n for _, n in large)
    size = -(-total // groups)
    out: list[list[tuple[int, int]]] = [[]]
    room = size
    for length, n in large:
        while n:
            if not room:
                out.append([])
                room = size
            take = min(n, room)
            out[-1].append((length, take))
            n, room = n - take, room - take
    return out


def fillings(sizes: list[int], capacity: int) -> np.ndarray:
    """All ways to put some of the sizes into a sequence, a row with the number of each."""
    rows = []
    for k in range(1, capacity // min(sizes) + 1):
        for chosen in combinations_with_replacement(range(len(sizes)), k):
            if sum(sizes[i] for i in chosen) <= capacity:
                rows.append(np.bincount(chosen, minlength=len(sizes)))
    return np.array(rows)


def cheapest(ways: np.ndarray, demand: np.ndarray, alone: list[int]) -> list[tuple[np.ndarray, float]]:
    """Ways and their numbers that meet the demand with the fewest sequences, fractions allowed.

    Revised simplex over the listed ways. It starts with sequences of one size each, that
    many of it as ``alone`` says.
    """
    k = len(demand)
    basis = np.diag(np.array(alone, float))
    for _ in range(50 * k):
        inverse = np.linalg.inv(basis)
        amounts = inverse @ demand
        prices = np.ones(k) @ inverse
        best = int(np.argmax(ways @ prices))
        if ways[best] @ prices <= 1 + 1e-9:
            break
        change = inverse @ ways[best]
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(change > 1e-12, np.maximum(amounts, 0) / change, np.inf)
        basis[:, int(np.argmin(ratio))] = ways[best]
    amounts = np.linalg.inv(basis) @ demand
    return [(basis[:, i].round().astype(int), float(amounts[i])) for i in range(k)]


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> list[Slot]:
    """Where the pieces of each length go."""
    plans = [plan_with(counts, capacity, share, groups) for share, groups in GROUPINGS]
    return min(plans, key=lambda plan: plan[1])[0]


def plan_with(
    counts: dict[int, int], capacity: int, share: float, groups: int
) -> tuple[list[Slot], int]:
    """The places of all pieces, and how many sequences they take."""
    slots: list[Slot] = []
    free: dict[int, list[Bins]] = {}
    rank = dict.fromkeys(counts, 0)
    sequences = 0

    def put(bins: Bins, length: int, number: int, each: int) -> Bins:
        slots.append(Slot(length, rank[length], number, bins.first, each, bins.used))
        rank[length] += number
        return Bins(bins.first, bins.count, bins.free - each * length, bins.used + each * length)

    def leave(bins: Bins) -> None:
        if bins.count and bins.free:
            free.setdefault(bins.free, []).append(bins)

    large = sorted(((n, c) for n, c in counts.items() if n > capacity * share and c), reverse=True)
    rest: list[tuple[int, int]] = []
    if large:
        runs = grouped(large, groups)
        sizes = [run[0][0] for run in runs]
        demand = np.array([sum(n for _, n in run) for run in runs], float)
        for way, amount in cheapest(fillings(sizes, capacity), demand, [capacity // n for n in sizes]):
            wanted = [(g, int(m)) for g, m in enumerate(way) if m]
            number = int(amount + 1e-9)
            if wanted:
                number = min([number, *(sum(n for _, n in runs[g]) // m for g, m in wanted)])
            while number and wanted:
                # Sequences that the next pieces of each group fill alike, or else a single one.
                alike = min([number, *(runs[g][0][1] // m for g, m in wanted)]) or 1
                bins = Bins(sequences, alike, capacity, 0)
                sequences += alike
                for g, m in wanted:
                    while m:
                        length, n = runs[g][0]
                        each = min(m, n // alike)
                        bins = put(bins, length, alike * each, each)
                        m -= each
                        if n > alike * each:
                            runs[g][0] = (length, n - alike * each)
                        else:
                            runs[g].pop(0)
                leave(bins)
                number -= alike
        rest = [r for run in runs for r in run]
    small = [(n, c) for n, c in counts.items() if n <= capacity * share and c]
    todo: dict[int, int] = {}
    for n, c in [*rest, *small]:
        todo[n] = todo.get(n, 0) + c
    for length in sorted(todo, reverse=True):
        number = todo[length]
        while number:
            fitting = [f for f in free if f >= length]
            if not fitting:
                each = capacity // length
                full, part = divmod(number, each)
                for count, per in ((full, each), (1 if part else 0, part)):
                    if count:
                        leave(put(Bins(sequences, count, capacity, 0), length, count * per, per))
                        sequences += count
                break
            best = min(fitting)
            bins = free[best].pop()
            if not free[best]:
                del free[best]
            each = best // length
            full = min(bins.count, number // each)
            if full:
                leave(put(bins._replace(count=full), length, full * each, each))
                number -= full * each
            at = full
            if number and at < bins.count and number < each:
                leave(put(Bins(bins.first + at, 1, best, bins.used), length, number, number))
                number, at = 0, at + 1
            leave(Bins(bins.first + at, bins.count - at, best, bins.used))
    return slots, sequences


def pieces(docs: DataFrame, vocabulary: str, end: int, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every document's tokens."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = encoder(vocabulary), np.array([end], "<u4").tobytes()
        for batch in batches:
            source, rows = [], []
            for at, ids in enumerate(encode.encode_all(text or "" for text in batch.column(1).to_pylist())):
                ids += last
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[start : start + 4 * capacity]
                    source.append(at)
                    rows.append((piece, start // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [()] * 4
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(source, pa.int64())), *map(pa.array, columns, kinds)],
                ["id", "piece", "start", "length", "ids_crc32"],
            )
        # The worker lives on, beside what other stages need, and would keep all this.
        encode.forget()
        pa.default_memory_pool().release_unused()

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(cut, f"id {kind}, piece int, start long, length long, ids_crc32 long")


def assign(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``found`` (with id, piece, length) with sequence_id and offset added."""
    spark = found.sparkSession
    counts = {r["length"]: r["count"] for r in found.groupBy("length").count().collect()}
    slots = plan_packing(counts, capacity)
    by_length: dict[int, list[Slot]] = {}
    for slot in slots:
        by_length.setdefault(slot.length, []).append(slot)
    ranks = {n: np.array([s.rank for s in own]) for n, own in by_length.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = [], []
            for length, rank in zip(batch.column("length").to_pylist(), batch.column("rank").to_pylist()):
                slot = by_length[length][int(np.searchsorted(ranks[length], rank, "right")) - 1]
                which, within = divmod(rank - slot.rank, slot.each)
                sequence.append(slot.first + which)
                offset.append(slot.offset + within * length)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                [*batch.schema.names[:-1], "sequence_id", "offset"],
            )

    rows = ranked(found, ["length"], ["id", "piece", "start", "ids_crc32"])
    names = [c for c in rows.columns if c != "rank"] + ["rank"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema.fields)
    return rows.select(*names).mapInArrow(place, f"{fields}, sequence_id long, offset long")


def pack(
    docs: DataFrame,
    vocabulary: str,
    end: int = 1,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece with its sequence and its place there."""
    scratch = Scratch(docs.sparkSession, "packing")
    found = scratch.keep(pieces(docs, vocabulary, end, capacity, id_col, text_col), "pieces")
    return assign(found, capacity).withColumnRenamed("id", id_col)

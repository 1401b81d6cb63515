"""Near-duplicate documents: banded MinHash, odd sketches, exact confirmation.

A document is the set of its distinct word shingles; two are linked when their Jaccard
similarity reaches a percentage. Copies of one word sequence are gathered first and
represented by one document. MinHash values are banded into keys; documents that share a
key are candidates. Each document also carries an odd sketch: its bottom-k MinHash sample
folded into a parity bitmap. The XOR of two bitmaps has at most as many bits as the
samples differ in, so a population count rules out nearly all candidates below the
threshold before any set is read; for sets no larger than the sample it never rules out
a link. The rest is confirmed on full sets, and links are closed to components.

Pairs are not enumerated within a key. First each document meets one hub, the smallest
document of its keys; components are formed, and a key is only looked at again for what
lies outside its largest component. Two documents that share a key therefore end either
in one component or with their pair ruled out by sketch or sets.

Defined cases: a null or empty text, or one without words, has no shingles and is linked
with nothing, not even its copies; fewer words than a shingle has make one shingle of all
of them; rows with a null id stay alone, with a null component, and are kept; rows that
share an id but not the text are documents of their own, of which the one with the smaller
hash of the text comes first; an empty table gives an empty
result; further columns of any name are ignored, or kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import md5
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from matchlake.llm.common import WORD, Scratch, components, few, packed, row_key, unpacked

#: Probability with which two documents just at the threshold share no key, at most, and
#: with which their sketches rule them out.
MISS = 1e-6
SAMPLE = 512
BITS = 1024
LANES = BITS // 64
#: Members of one key that one task compares with the others of the key.
BLOCK = 1000
#: Rounds of hubs after the first go on while this share of the documents outside finds a link.
GAIN = 0.05
WORD_MEMORY = 200_000

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_ODD = [f"odd{i}" for i in range(LANES)]


class Banding(NamedTuple):
    rows: int
    bands: int


def banding(percent: int) -> Banding:
    rows = 5 if percent >= 85 else 4
    bands = math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** rows))
    return Banding(rows, bands)


class _WordHashes(dict):
    """64-bit hashes of words met so far; forgotten when there are too many."""

    def __missing__(self, word: str) -> int:
        if len(self) >= WORD_MEMORY:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: list[str], width: int, known: _WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    mixed = np.full(n, len(words) if len(words) < width else width, np.uint64)
    for i in range(min(width, len(words))):
        mixed = _mixed(mixed * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    return np.unique(mixed)


def band_keys(shingles: np.ndarray, plan: Banding, factors: np.ndarray) -> np.ndarray:
    least = np.full(len(factors), np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), 8192):
        least = np.minimum(least, (factors[:, None] * shingles[None, at : at + 8192]).min(axis=1))
    keys = np.arange(plan.bands, dtype=np.uint64)
    for column in least.reshape(plan.bands, plan.rows).T:
        keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys.view(np.int64)


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity bitmap of the smallest hashes, as signed 64-bit lanes."""
    bits = (_mixed(shingles[:SAMPLE]) & np.uint64(BITS - 1)).astype(np.int64)
    parity = (np.bincount(bits, minlength=BITS) & 1).astype(np.uint8)
    return np.packbits(parity, bitorder="little").view(np.int64)


def _factors(plan: Banding) -> np.ndarray:
    random = np.random.Generator(np.random.PCG64(9))
    return random.integers(0, 2**63, plan.rows * plan.bands, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketches(docs: DataFrame, width: int, plan: Banding) -> DataFrame:
    """One row per document: digest of its words, set size, band keys, odd sketch."""
    factors = _factors(plan)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in batches:
            digests, sizes, keys, odd = [], [], [], []
            for text in batch.column(1).to_pylist():
                words = WORD.findall((text or "").translate(_LOWER))
                shingles = shingle_hashes(words, width, known)
                sizes.append(len(shingles))
                digests.append(md5(" ".join(words).encode("utf-8", "surrogatepass")).digest() if words else None)
                keys.append(band_keys(shingles, plan, factors) if words else None)
                odd.append(odd_sketch(shingles))
            lanes = np.array(odd).reshape(-1, LANES).T if odd else [()] * LANES
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(digests, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                    *[pa.array(lane, pa.int64()) for lane in lanes],
                ],
                ["id", "digest", "n", "keys", *_ODD],
            )
        # The worker lives on, and would keep what Arrow needed for the texts.
        pa.default_memory_pool().release_unused()

    lanes = ", ".join(f"{c} long" for c in _ODD)
    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(sketch, f"id {kind}, digest binary, n long, keys array<long>, {lanes}")


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in batches:
            texts = [(t or "").translate(_LOWER) for t in batch.column(1).to_pylist()]
            sets = [shingle_hashes(WORD.findall(t), width, known).view(np.int64) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["id", "shingles"]
            )
        pa.default_memory_pool().release_unused()

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(hashed, f"id {kind}, shingles array<long>")


def _possible(a: str, b: str, percent: int) -> Column:
    """False only where sizes or sketches tell that the similarity is below the threshold.

    Sets of n and m elements with similarity t have at least i = (n+m)t/(1+t) in common.
    Samples share what the smaller of two counts says: how many of the common elements are
    in the sample of the one set, and in that of the other. Each is hypergeometric with
    mean ki/n, from which Bernstein's inequality bounds it, whatever the two sizes; a set
    that is its own sample has them all. The bitmaps of samples that differ in d elements
    differ in at most d bits.
    """
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    bits = sum((F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in _ODD), F.lit(0))
    t = percent / 100
    shared = (n + m) * (t / (1 + t))
    sure = math.log(2 / MISS)

    def least_sampled(size: Column) -> Column:
        taken = F.least(size, F.lit(SAMPLE))
        share = shared / size
        # What is in the sample and what is left out deviate by the same number.
        variance = F.least(taken, size - taken) * share * (1 - share)
        away = sure / 3 + F.sqrt(F.greatest(variance, F.lit(0.0)) * (2 * sure) + sure**2 / 9)
        return taken * share - F.when(size > SAMPLE, away).otherwise(0.0)

    common = F.least(least_sampled(n), least_sampled(m))
    most = F.least(n, F.lit(SAMPLE)) + F.least(m, F.lit(SAMPLE)) - 2 * common
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (bits <= most + 1e-6)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y")).cast("long")
    union = F.size("x").cast("long") + F.size("y") - common
    both = pairs.join(left, "a").join(right, "b")
    return both.filter(100 * common >= percent * union).select("a", "b")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row; kept where id and component agree,
    and also the text where rows share an id."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    key, marked = row_key(rows)
    found = _grouped(_keyed(rows, key), width, percent)
    plain = lambda c: F.col(c)["id"] if marked else F.col(c)
    kept = F.coalesce(F.col("id") == F.col("component"), F.lit(True))
    return found.select(
        plain("id").alias(id_col), F.col("n").alias("n_shingles"), plain("component").alias("component_id"), kept.alias("kept")
    )


def _keyed(rows: DataFrame, key: Column) -> DataFrame:
    return rows.withColumn("id", F.when(F.col("id").isNotNull(), key))


def _grouped(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(id, n, component) of every row of (id, text)."""
    scratch = Scratch(docs.sparkSession, "near")
    plan = banding(percent)
    drawn = scratch.keep(sketches(docs, width, plan), "sketches")

    # One document stands for all with the same words.
    usable = drawn.filter("digest is not null and id is not null")
    stand = F.min_by(F.struct("n", "keys", *_ODD), "id").alias("s")
    reps = usable.groupBy("digest").agg(F.min("id").alias("id"), stand).select("id", "digest", "s.*")
    reps = scratch.keep(reps, "reps")
    all_docs = scratch.keep(drawn.select("id", "digest", "n"), "docs")
    scratch.drop("sketches")

    keyed = reps.select(F.explode("keys").alias("key"), "id")
    shared = keyed.groupBy("key").count().filter("count > 1").select("key")
    met = scratch.keep(keyed.join(shared, "key"), "met")
    members = scratch.keep(met.select("id").distinct(), "members")
    members = few(members, members.count())
    facts = scratch.keep(reps.join(members, "id", "left_semi").drop("digest", "keys"), "facts")
    sets = shingle_sets(docs.join(members, "id", "left_semi"), width)
    if not all_docs.filter("id is not null").groupBy("id").count().filter("count > 1").isEmpty():
        sets = sets.distinct()
    sets = scratch.keep(sets, "sets")

    # Each document meets the smallest document of its keys that its sketch does not rule out.
    hubs = met.join(met.groupBy("key").agg(F.min("id").alias("hub")), "key").filter("id > hub")
    links = _round(hubs.select("id", "hub").distinct(), facts, sets, percent)
    links = scratch.keep(links, "links-0")

    closed, step, gained = components(links, scratch, "cc0"), 0, True
    while gained:
        rows = scratch.keep(_with_component(met, closed), f"rows-{step}")
        rest = scratch.keep(_outside(rows), f"rest-{step}")
        scratch.drop(f"rows-{step}")
        # A key within one component stays there: it need not be looked at again.
        met = rest.select("key", "id")
        outside = F.approx_count_distinct(F.when(F.col("outside"), F.col("id")))
        work, largest, outside = rest.agg(F.sum("outside_rows"), F.count("*"), outside).first()
        if not largest:
            break
        # What is closed is stars already; only new links are to be closed with them.
        links, gained = closed.select(F.col("id").alias("a"), F.col("component").alias("b")), False
        step += 1
        # Many documents outside: let them meet hubs of their own before all pairs count, and
        # go on so while that helps: else another round is as much work for as little.
        if step <= 3 and (work or 0) > 4 * largest:
            out = rest.filter("outside")
            hub = out.groupBy("key").agg(F.min("id").alias("hub"))
            pairs = out.join(hub, "key").filter("id > hub").select("id", "hub").distinct()
            more = scratch.keep(_round(pairs, facts, sets, percent), f"links-{step}")
            links, gained = links.union(more), more.count() >= GAIN * outside
        if not gained:
            pairs = scratch.keep(_across(rest, facts, percent), f"pairs-{step}")
            links = links.union(scratch.keep(_confirmed(pairs, sets, percent), f"across-{step}"))
        closed = components(links, scratch, f"cc{step}")

    found = reps.select("digest", "id").join(closed, "id", "left")
    found = found.select("digest", F.coalesce("component", "id").alias("component"))
    named = all_docs.select("id", "digest", "n").join(found, "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return named.select("id", "n", component.alias("component"))


def _round(pairs: DataFrame, facts: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links between each document and the smallest hub its sketch leaves."""
    a = facts.withColumnRenamed("id", "a_id").alias("a")
    b = facts.withColumnRenamed("id", "b_id").alias("b")
    near = pairs.join(a, F.col("id") == F.col("a_id")).join(b, F.col("hub") == F.col("b_id"))
    near = near.filter(_possible("a", "b", percent)).groupBy("id").agg(F.min("hub").alias("b"))
    return _confirmed(near.select(F.col("id").alias("a"), "b"), sets, percent)


def _with_component(met: DataFrame, closed: DataFrame) -> DataFrame:
    found = met.join(few(closed, closed.count()), "id", "left")
    return found.select("key", "id", F.coalesce("component", "id").alias("component"))


def _outside(rows: DataFrame) -> DataFrame:
    """Rows of keys that hold several components, marked if outside the largest one."""
    groups = rows.groupBy("key", "component").agg(F.count("*").alias("n"))
    top = groups.groupBy("key").agg(
        F.max_by("component", F.struct("n", "component")).alias("top"),
        F.sum("n").alias("rows"),
        F.max("n").alias("most"),
    )
    top = top.filter("most < rows")
    out = F.col("component") != F.col("top")
    left = F.col("rows") - F.col("most")
    return rows.join(top, "key").select(
        "key", "id", "component", out.alias("outside"), F.col("rows").alias("key_rows"),
        F.when(out, F.col("rows")).alias("outside_rows"), left.alias("n_outside"),
    )


def _across(rest: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a key and pass the sketches.

    What is outside a key's largest component meets all members of the key, in blocks.
    """
    blocks = F.ceil(F.col("n_outside") / BLOCK).cast("int")
    rows = rest.join(facts, "id")
    left = rows.filter("outside").withColumn("block", F.pmod(F.hash("id"), blocks)).alias("a")
    right = rows.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).alias("b")
    same = (F.col("a.key") == F.col("b.key")) & (F.col("a.block") == F.col("b.block"))
    once = (F.col("a.component") != F.col("b.component")) & (
        ~F.col("b.outside") | (F.col("a.id") < F.col("b.id"))
    )
    pairs = left.join(right, same & once & _possible("a", "b", percent))
    return pairs.select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """One row for each group of near copies, the smallest id, with all columns of it."""
    rows = packed(docs, id=id_col, text=text_col)
    key, marked = row_key(rows)
    rows = _keyed(rows, key)
    found = _grouped(rows.select("id", "text"), width, percent)
    gone = found.filter("id <> component").select(F.col("id").alias("gone")).distinct()
    left = rows.join(gone, F.col("id") == F.col("gone"), "left_anti")
    # Of rows alike in id and text one stays; without an id all stay.
    if marked:
        own = F.when(F.col("id").isNull(), F.xxhash64("row"))
        first = Window.partitionBy("id", own).orderBy("text", F.xxhash64("row"))
        left = left.withColumn("rank", F.row_number().over(first)).filter("rank = 1 or id is null")
    return unpacked(left, docs.columns)

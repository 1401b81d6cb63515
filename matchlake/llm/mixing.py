"""Mixing of sources to target weights by entropy balancing.

Every document gets a rate of copies as close to one as the targets allow: of all rates
between 0 and a cap that meet each source's token target, those with the least Kullback-
Leibler divergence from one copy each. They are exponentially tilted, min(cap, exp(tilt *
size)), with a tilt per source that maximises the convex dual. Newton steps find it: each
is one distributed aggregation of gradient and curvature over the counts of documents per
source and size, which hold all that the rates depend on. Rates are rounded into whole
copies from the largest size down, what one size leaves over being carried to the next.

Defined cases: a null or empty text has size 0 and is taken with size 0; documents without
a source form a source of their own, the last; rows that repeat an id are mixed each for
itself; sources without words have target 0; an empty table gives an empty result; further
columns of any name are ignored, or kept by ``mixed``.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from matchlake.llm.common import Scratch, n_words, packed, unpacked
from matchlake.llm.ranking import ranked

WEIGHTS = (1.0, 2.0, 3.0)
CAP = 3
STEPS = 60
TOLERANCE = 1e-9
#: Sources whose tilts the driver holds at most: a number and a name each.
MAX_SOURCES = 200_000


def targets(sizes: list[float], weights: list[float], cap: float = CAP) -> list[float]:
    """The whole amount shared by weight, no share above ``cap`` times its source's size."""
    out, open_, left = [0.0] * len(sizes), list(range(len(sizes))), float(sum(sizes))
    while open_:
        weight = sum(weights[i] for i in open_)
        above = [i for i in open_ if left * weights[i] / weight > cap * sizes[i]]
        if not above:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in above:
            out[i] = float(cap * sizes[i])
        left -= sum(out[i] for i in above)
        open_ = [i for i in open_ if i not in set(above)]
    return out


def _code_points(name: str | None):
    return (name is None, name or "")


def source_targets(counts: DataFrame, weights=WEIGHTS, cap: float = CAP) -> list[dict]:
    """Sources in order with their size and target."""
    rows = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    found = rows.limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found = sorted(found, key=lambda r: _code_points(r["source"]))
    own = [weights[i % len(weights)] for i in range(len(found))]
    amounts = targets([r["source_size"] for r in found], own, cap)
    return [
        {"at": i, "source": r["source"], "source_size": r["source_size"], "target": t}
        for i, (r, t) in enumerate(zip(found, amounts))
    ]


def tilts(counts: DataFrame, sources: list[dict], cap: float = CAP) -> dict[int, float]:
    """Tilt of each source, infinite where the target takes ``cap`` copies of everything.

    ``counts`` has (at, size, n). Newton steps on the dual are kept inside a bracket that
    shrinks with the sign of the gradient; a step that leaves it becomes a bisection.
    """
    spark = counts.sparkSession
    tilt, low, high = {}, {}, {}
    for s in sources:
        full = cap * s["source_size"]
        if s["source_size"] == 0 or s["target"] >= full * (1 - TOLERANCE):
            tilt[s["at"]] = math.inf
        elif s["target"] <= 0:
            tilt[s["at"]] = -math.inf
        else:
            tilt[s["at"]], low[s["at"]], high[s["at"]] = 0.0, -math.inf, math.inf
    target = {s["at"]: s["target"] for s in sources}
    running = set(low)
    for _ in range(STEPS):
        if not running:
            break
        now = spark.createDataFrame([(k, tilt[k]) for k in sorted(running)], "at int, tilt double")
        rate = F.exp(F.least(F.col("tilt") * F.col("size"), F.lit(math.log(cap))))
        inner = F.col("tilt") * F.col("size") < math.log(cap)
        mass = F.col("n") * F.col("size")
        state = counts.join(F.broadcast(now), "at").groupBy("at").agg(
            F.sum(mass * rate).alias("taken"),
            F.sum(F.when(inner, mass * F.col("size") * rate).otherwise(0.0)).alias("curvature"),
        )
        for row in state.collect():
            k, gap = row["at"], row["taken"] - target[row["at"]]
            if abs(gap) <= TOLERANCE * max(1.0, target[k]):
                running.discard(k)
                continue
            if gap > 0:
                high[k] = tilt[k]
            else:
                low[k] = tilt[k]
            step = tilt[k] - gap / row["curvature"] if row["curvature"] > 0 else math.nan
            if not low[k] < step < high[k]:
                if math.isinf(low[k]):
                    step = 2 * high[k] if high[k] < 0 else -1e-6
                elif math.isinf(high[k]):
                    step = 2 * low[k] if low[k] > 0 else 1e-6
                else:
                    step = (low[k] + high[k]) / 2
            if step == tilt[k]:
                running.discard(k)
            tilt[k] = step
    return tilt


def rounded(sizes: pd.DataFrame, cap: int = CAP) -> pd.DataFrame:
    """Whole copies for the documents of each size of one source, (size, n, rate) given.

    From the largest size down, the sum taken follows the sum of the rates; what is left
    over is below half of the smallest size with room.
    """
    sizes = sizes.sort_values("size", ascending=False)
    copies, carry = [], 0.0
    for size, n, rate in zip(sizes["size"], sizes["n"], sizes["rate"]):
        wanted = n * size * rate + carry
        whole = int(min(cap * n, max(0, math.floor(wanted / size + 0.5)))) if size else int(n)
        carry = wanted - whole * size
        copies.append(whole)
    return sizes.assign(copies=copies)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    cap: int = CAP,
) -> DataFrame:
    """(id, size, source_size, target, copies, taken) of every row."""
    rows = docs.select(
        F.col(id_col).alias("key"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size")
    )
    found = _with_copies(rows, weights, cap)
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return found.select(F.col("key").alias(id_col), "size", "source_size", "target", "copies", taken)


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    cap: int = CAP,
) -> DataFrame:
    """The rows of the mix: every row as often as it is taken, with all its columns."""
    key = F.struct(F.col("id").alias("id"), F.xxhash64("row").alias("hash")).alias("key")
    marked = packed(docs, id=id_col, text=text_col, source=source_col)
    marked = marked.select("row", key, "source", n_words(F.col("text")).alias("size"))
    # Rows alike in all columns share their copies; one of them then stands for all.
    total = _with_copies(marked.select("key", "source", "size"), weights, cap).groupBy("key").agg(
        F.sum("copies").alias("copies"), F.count("*").alias("alike")
    )
    total = Scratch(docs.sparkSession, "mixed").keep(total, "copies")
    if not total.filter("alike > 1").isEmpty():
        marked = marked.dropDuplicates(["key"])
    # Field by field, as a missing id equals a missing one here.
    same = F.col("m.key.id").eqNullSafe(F.col("t.key.id")) & (F.col("m.key.hash") == F.col("t.key.hash"))
    taken = marked.alias("m").join(total.filter("copies > 0").alias("t"), same)
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return unpacked(taken.select("row", times.alias("time")), docs.columns)


def _with_copies(rows: DataFrame, weights, cap: int) -> DataFrame:
    """(key, source, size) with source_size, target and copies added."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "mixing")
    rows = scratch.keep(rows, "sizes")
    per_size = scratch.keep(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "per-size")
    sources = source_targets(per_size, weights, cap)
    schema = T.StructType(
        [
            T.StructField("at", T.IntegerType()),
            T.StructField("name", rows.schema["source"].dataType),
            T.StructField("source_size", T.LongType()),
            T.StructField("target", T.DoubleType()),
        ]
    )
    listed = spark.createDataFrame(
        [(s["at"], s["source"], s["source_size"], s["target"]) for s in sources], schema
    )
    listed = F.broadcast(scratch.keep(listed, "sources"))
    counts = per_size.join(listed, F.col("source").eqNullSafe(F.col("name"))).select("at", "size", "n")
    counts = scratch.keep(counts, "counts")
    tilt = tilts(counts, sources, cap)
    rates = F.broadcast(spark.createDataFrame(list(tilt.items()), "at int, tilt double"))
    rate = (
        F.when(F.col("tilt") == math.inf, float(cap))
        .when(F.col("tilt") == -math.inf, 0.0)
        .otherwise(F.exp(F.least(F.col("tilt") * F.col("size"), F.lit(math.log(cap)))))
    )
    rated = counts.join(rates, "at").select("at", "size", "n", rate.alias("rate"))
    whole = rated.groupBy("at").applyInPandas(
        lambda sizes: rounded(sizes, cap)[["at", "size", "n", "copies"]], "at int, size long, n long, copies long"
    )
    whole = scratch.keep(whole, "copies")
    base = F.expr("copies div n")
    shares = whole.select("at", "size", base.alias("base"), (F.col("copies") - base * F.col("n")).alias("more"))
    shares = shares.join(listed, "at")
    # Which documents of a size get one copy more is settled by rank within the size.
    placed = ranked(rows.withColumn("mark", F.xxhash64("key")), ["source", "size"], ["mark", "key"])
    same = F.col("p.source").eqNullSafe(F.col("s.name")) & (F.col("p.size") == F.col("s.size"))
    copies = F.col("base") + F.when(F.col("rank") < F.col("more"), 1).otherwise(0)
    return placed.alias("p").join(shares.alias("s"), same).select(
        "p.key", "p.source", "p.size", "source_size", "target", copies.alias("copies")
    )

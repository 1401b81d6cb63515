"""Line deduplication over a corpus by a deletion-neighbourhood join.

Lines are compared as word sequences; for edits each character of a script written without
spaces (Chinese, Japanese, Thai, Lao, Khmer, Burmese, Tibetan) is a word of its own. A line goes if an earlier line, by document id and
place, has the same words, or if its words can be turned into those of an earlier line by
one insertion, deletion or substitution of a word and both lines are long enough for that
to be noise. Of all lines that are near one another the earliest stays.

The neighbourhood of a line is itself and what remains when one word is left out, each as a
hashed key. Lines that lack the same word of the same place differ by a substitution, and
a line that equals another without a word differs by an insertion. Within a key of the
first kind all lines are near one another, so each needs to look at the earliest only; in
one of the second kind the one whole line and the earliest shortened one do. No pairs are
made. Links are verified on the words. Two lines within one edit share their first or their
last half, so only lines whose half another line has too have their neighbourhood emitted.

Everything is DataFrame functions. Defined cases: null and empty texts are returned as they
are; lines of fewer words than ``min_words`` stay, unless they have ``min_chars`` characters
or, counting characters of unspaced scripts as words, ``min_words_near`` words; rows alike in id and text count as
one document, so lines at the same place of each do not remove one another; rows that share
an id but not the text, or lack an id, are documents of their own, in the order of a hash of
the text; rows without an id come first in order; a document that loses all of its lines that took part, and had no
others with words, is dropped (``drop_empty``); an empty table gives an empty result;
further columns of any name are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from matchlake.llm.common import Scratch, n_words, row_key

MIN_WORDS = 3
MIN_WORDS_NEAR = 10
#: Characters from which a line takes part however few its words.
MIN_CHARS = 30
#: Candidate lines that are broadcast at most, to fetch their words.
BROADCAST_LINES = 300_000
#: Places of lines that go are broadcast up to this size in memory.
BROADCAST_BYTES = 64 << 20


#: A run of white space other than a single space.
_UNEVEN = r"\x20?[\x09-\x0D][\x20\x09-\x0D]*|\x20{2,}[\x20\x09-\x0D]*"


def _normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(line, _UNEVEN, " "))


def _n_words(normal: Column) -> Column:
    spaces = F.length(normal) - F.length(F.replace(normal, F.lit(" "), F.lit("")))
    return F.when(normal == "", 0).otherwise(spaces + 1).cast("int")


_UNSPACED = "".join(
    rf"\p{{Is{name}}}" for name in ("Han", "Hiragana", "Katakana", "Bopomofo", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan")
)
#: Between such a character with its marks and what is next to it on either side.
_SEAM = rf"(?<=[{_UNSPACED}]\p{{M}}{{0,8}})(?=[^\x20\p{{M}}])|(?<=[^\x20])(?=[{_UNSPACED}&&\P{{M}}])"


#: All characters of these scripts come after this one, as few others do.
_FAR = r"[\x{E00}-\x{10FFFF}]"


def _units(normal: Column) -> Column:
    """The line with a space on either side of each character of an unspaced script."""
    spaced = F.octet_length(normal) == F.length(normal)
    for some in (_FAR, f"[{_UNSPACED}]"):
        spaced = spaced | ~normal.rlike(some)
    return F.when(spaced, normal).otherwise(F.regexp_replace(normal, _SEAM, " "))


def _halves(normal: Column, n: Column) -> Column:
    """Keys of the first and of the last words of a line, as many as half of the shorter line
    of a pair; see ``_half`` for their places in the array."""
    part = lambda count: F.call_function("substring_index", normal, F.lit(" "), count)

    def pair(whole: Column) -> list[Column]:
        half = F.floor(whole / 2).cast("int")
        return [F.xxhash64(F.lit(last), half, part(count)) for last, count in ((False, half), (True, -half))]

    # Half of n and half of n - 1 are the same number for an odd n.
    return F.when(n % 2 == 1, F.array(*pair(n))).otherwise(F.array(*pair(n), *pair(n - 1)))


def _half(n: Column, place: Column) -> tuple[Column, Column]:
    """(last, half) of the key at a place in the array of a line of n words."""
    return place % 2 == 1, F.floor((n - F.floor(place / 2)) / 2).cast("int")


def _facts(docs: DataFrame, min_words: int, min_words_near: int, min_chars: int) -> DataFrame:
    """(doc, at, x, y, n, halves, takes_part) of the lines of (doc, text): two hashes of the
    words, and of lines long enough for edits the number of units and the keys of halves.

    No filter stands here: it would be pushed below the projections and evaluate them anew.
    """
    lines = docs.select("doc", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    lines = lines.select("doc", "at", _normal(F.col("line")).alias("normal"))
    lines = lines.select("*", _units(F.col("normal")).alias("units"), _n_words(F.col("normal")).alias("n_words"))
    same = F.length("units") == F.length("normal")
    lines = lines.select("*", F.when(same, F.col("n_words")).otherwise(_n_words(F.col("units"))).alias("n"))
    long = F.col("n") >= min_words_near
    return lines.select(
        "doc", "at", F.xxhash64("normal").alias("x"), F.xxhash64(F.lit("line"), "normal").alias("y"),
        F.when(long, F.col("n")).alias("n"), F.when(long, _halves(F.col("units"), F.col("n"))).alias("halves"),
        ((F.col("n_words") >= min_words) | (F.length("normal") >= min_chars) | long).alias("takes_part"),
    )


def _words(docs: DataFrame, near: DataFrame) -> DataFrame:
    """(doc, at, after, before, words) of the lines (doc, at, after, before) that are wanted."""
    wanted = near.groupBy(F.col("doc").alias("d")).agg(F.collect_list(F.struct("at", "after", "before")).alias("wanted"))
    few = near.limit(BROADCAST_LINES + 1).count() <= BROADCAST_LINES
    texts = docs.join(F.broadcast(wanted) if few else wanted, F.col("doc").eqNullSafe(F.col("d")))
    lines = texts.select("doc", F.split("text", "\n").alias("lines"), F.explode("wanted").alias("w"))
    line = _units(F.col("line"))
    lines = lines.select("doc", "w.*", _normal(F.get("lines", F.col("w.at"))).alias("line"))
    # Rows alike in id and text are one document.
    return lines.select("doc", "at", "after", "before", F.split(line, " ").alias("words")).dropDuplicates(["doc", "at"])


_SAME, _SHORTENED, _WHOLE = 0, 1, 2


def _neighbourhood(lines: DataFrame) -> DataFrame:
    """(doc, at, kind, key) of lines (doc, at, words, after, before).

    The edit is sought from the place ``after`` on, and before the last ``before`` words,
    where another line has the same first or last words; null where none has.
    A remainder's key is the exclusive or of hashes of its words with their places. It is
    kept up along the line: what stands before the missing word keeps its place, what
    stands after it moves up by one if the remainder is compared with a whole line.
    """
    n = F.size("words")
    sought = (F.col("pos") >= F.col("after")) | (F.col("pos") < n - F.col("before"))
    each = lines.select("doc", "at", "after", "before", "words", F.posexplode("words").alias("pos", "word"))
    each = each.select(
        "doc", "at", n.alias("n"), "pos", F.coalesce(sought, F.lit(False)).alias("sought"),
        F.xxhash64("word", "pos").alias("here"), F.xxhash64("word", F.col("pos") - 1).alias("up"),
    )
    line = Window.partitionBy("doc", "at")
    so_far = line.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.select(
        "*",
        F.bit_xor("here").over(line).alias("all_here"),
        F.bit_xor("up").over(line).alias("all_up"),
        F.bit_xor("here").over(so_far).alias("so_here"),
        F.bit_xor("up").over(so_far).alias("so_up"),
    )
    without = F.col("all_here").bitwiseXOR(F.col("here"))
    closed = F.col("so_here").bitwiseXOR(F.col("here")).bitwiseXOR(F.col("all_up")).bitwiseXOR(F.col("so_up"))

    def variant(kind: int, *key) -> Column:
        return F.struct(F.lit(kind).cast("byte").alias("kind"), F.xxhash64(*key).alias("key"))

    variants = F.array(
        F.when(F.col("sought"), variant(_SAME, F.lit("s"), "n", "pos", without)),
        F.when(F.col("sought"), variant(_SHORTENED, F.lit("d"), F.col("n") - 1, closed)),
        F.when(F.col("pos") == 0, variant(_WHOLE, F.lit("d"), "n", "all_here")),
    )
    made = each.select("doc", "at", F.explode(variants).alias("v")).filter("v is not null")
    return made.select("doc", "at", "v.kind", "v.key")


def _one_edit(x: Column, y: Column) -> Column:
    """Whether word arrays differ by at most one inserted, deleted or substituted word."""
    n, m = F.size(x), F.size(y)
    differ = F.zip_with(F.slice(x, 1, F.least(n, m)), F.slice(y, 1, F.least(n, m)), lambda a, b: a != b)
    at = F.array_position(differ, True).cast("int")
    at = F.when(at == 0, F.least(n, m) + 1).otherwise(at)
    tail = lambda words, start: F.slice(words, start, F.greatest(F.size(words) - start + 1, F.lit(0)))
    return (
        F.when(n == m, tail(x, at + 1) == tail(y, at + 1))
        .when(n == m + 1, tail(x, at + 1) == tail(y, at))
        .when(m == n + 1, tail(x, at) == tail(y, at + 1))
        .otherwise(False)
    )


def duplicate_lines(
    docs: DataFrame, min_words: int = MIN_WORDS, min_words_near: int = MIN_WORDS_NEAR, min_chars: int = MIN_CHARS
) -> DataFrame:
    """(doc, drop) of (doc, text): sorted places of the lines that go, with their kind."""
    scratch = Scratch(docs.sparkSession, "lines")
    facts = scratch.keep(_facts(docs, min_words, min_words_near, min_chars), "facts").filter("takes_part")
    first = F.min(F.struct("doc", "at")).alias("first")
    distinct = facts.groupBy("x", "y").agg(
        first, F.count("*").alias("copies"), F.first("n").alias("n"), F.first("halves").alias("halves")
    )
    distinct = scratch.keep(distinct.select("x", "y", "first.*", "copies", "n", "halves"), "distinct")

    halves = distinct.select("doc", "at", "n", F.posexplode("halves").alias("place", "key"))
    shared = halves.groupBy("key").count().filter("count > 1").select("key")
    last, half = _half(F.col("n"), F.col("place"))
    near = halves.join(shared, "key").groupBy("doc", "at").agg(
        F.min(F.when(~last, half)).alias("after"), F.min(F.when(last, half)).alias("before")
    )
    near = scratch.keep(near, "near")
    words = scratch.keep(_words(docs, near), "words")

    made = scratch.keep(_neighbourhood(words), "made")
    place = F.struct("doc", "at")
    least = lambda kind: F.min(F.when(F.col("kind") == kind, place))
    groups = made.groupBy("key").agg(
        F.count("*").alias("n"), least(_SAME).alias("same"), least(_SHORTENED).alias("shortened"), least(_WHOLE).alias("whole")
    )
    groups = groups.filter("n > 1")
    partner = F.when(F.col("kind") == _SAME, F.col("same")).when(F.col("kind") == _SHORTENED, F.col("whole"))
    links = made.join(groups, "key").select(place.alias("first"), partner.otherwise(F.col("shortened")).alias("earlier"))
    links = links.filter("earlier < first").distinct()
    known = words.select(place.alias("place"), "words")
    own = known.select(F.col("place").alias("first"), "words")
    other = known.select(F.col("place").alias("earlier"), F.col("words").alias("earlier_words"))
    verified = links.join(own, "first").join(other, "earlier").filter(_one_edit(F.col("words"), F.col("earlier_words")))
    verified = scratch.keep(verified.select("first").distinct(), "verified")

    named = distinct.select("x", "y", "copies", place.alias("first")).join(
        verified.withColumn("near", F.lit(True)), "first", "left"
    )
    verdict = named.filter("copies > 1 or near").select(
        "x", "y", F.col("first").alias("kept"), F.coalesce("near", F.lit(False)).alias("near")
    )
    gone = facts.select("doc", "at", "x", "y").join(verdict, ["x", "y"])
    gone = gone.filter(F.col("near") | ~F.struct("doc", "at").eqNullSafe(F.col("kept")))
    drop = gone.select("doc", F.struct("at", "near").alias("d")).groupBy("doc").agg(
        F.sort_array(F.collect_set("d")).alias("drop")
    )
    drop = scratch.keep(drop, "drop")
    scratch.drop("facts", "distinct", "near", "words", "made", "verified")
    return drop


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    min_words_near: int = MIN_WORDS_NEAR,
    drop_empty: bool = True,
    min_chars: int = MIN_CHARS,
    least_words: int = 0,
    least_share: float = 0.0,
) -> DataFrame:
    """The documents without the lines that go, with all their columns.

    A document that lost lines goes itself if fewer than ``least_words`` words are left of it,
    or less than ``least_share`` of its words: what is left of a copy is no document.
    """
    found = _cleaned(docs, id_col, text_col, min_words, min_words_near, min_chars)
    goes = F.lit(False)
    if drop_empty:
        goes = goes | F.coalesce(_normal(F.col("left")) == "", F.lit(True))
    if least_words or least_share:
        before, after = n_words(F.col("text")), n_words(F.col("left"))
        goes = goes | (after < least_words) | (after < F.lit(least_share) * before)
    # No filter stands here: it would be pushed below the projections, where it makes the text
    # that is left anew at each mention, and splits the document anew for each line of it.
    stays = F.when(F.col("drop").isNull() | ~goes, F.array("left"))
    found = found.select("row", F.explode(stays).alias("left"))
    return found.select(*[F.col("left" if c == text_col else f"`row`.`{c}`").alias(c) for c in docs.columns])


def _cleaned(
    docs: DataFrame, id_col: str, text_col: str, min_words: int, min_words_near: int, min_chars: int
) -> DataFrame:
    """(row, id, text, drop, left): other columns, what goes (null if nothing) and the text left."""
    # The text stands beside the other columns, so that it is shuffled once.
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row")
    rows = docs.select(others, F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    key, _ = row_key(rows)
    drop = duplicate_lines(rows.select(key.alias("doc"), "text"), min_words, min_words_near, min_chars)
    # Texts are shuffled only where what goes is too much to broadcast.
    size = drop.agg(F.coalesce(F.sum(64 + 32 * F.size("drop")), F.lit(0))).first()[0]
    drop = F.broadcast(drop) if size <= BROADCAST_BYTES else drop
    both = rows.withColumn("key", key).join(drop, F.col("key").eqNullSafe(F.col("doc")), "left")
    both = both.withColumn("lines", F.when(F.col("drop").isNotNull(), F.split("text", "\n")))
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    left = F.array_except(places, F.col("drop")["at"])
    text = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    return both.withColumn("left", F.when(F.col("drop").isNull(), F.col("text")).otherwise(text))


def line_report(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    min_words_near: int = MIN_WORDS_NEAR,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """(id, n_lines, n_copies, n_near, text): what goes from each document, and what stays."""
    found = _cleaned(docs, id_col, text_col, min_words, min_words_near, min_chars)
    of_kind = lambda near: F.coalesce(
        F.size(F.filter("drop", lambda d: d["near"] == F.lit(near))).cast("long"), F.lit(0)
    )
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    n_lines = F.coalesce((breaks + 1).cast("long"), F.lit(0))
    return found.select(
        F.col("id").alias(id_col),
        n_lines.alias("n_lines"),
        of_kind(False).alias("n_copies"),
        of_kind(True).alias("n_near"),
        F.col("left").alias("text"),
    )

"""Secret scans by a trigram inverted index.

Each rule is a regular expression. From it a Boolean query over trigrams is derived that
every text with a match fulfils: alternatives of sets of trigrams, of which one set has to
occur whole (``trigram_query``). Trigrams are of lower-cased text. The index lists for each
trigram the rows that hold it, in shards of bounded size; a rule's candidates are the union,
over its alternatives, of the intersections of their lists. Only candidates are matched
against the expression. A rule whose expression has an alternative without any trigram
matches every row.

The index holds the trigrams that some rule asks for: others could not take part in an answer.

Lists name rows by a hash of id and text. Where hashes of different rows should agree, each
is a candidate for the rules of both, which the expressions then decide.

Everything on the way from rows to spans is DataFrame functions. Expressions are written in
what Java, RE2 and Python read alike: no look-around, no shorthand classes.

Defined cases: null and empty texts have no spans; matches of a rule are leftmost and do not
overlap, those whose group is shorter than the rule's least length count as consumed and are
left out; spans are places of code points, the end exclusive; repeated rows and ids each get
the spans of their own text; an empty table gives an empty result; further columns of any
name are ignored.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import product
from re import _constants as op, _parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from matchlake.llm.common import Scratch

#: Rows of a shard of the index, on average.
SHARD = 8192
#: Candidate rows that are broadcast at most, to find their texts.
BROADCAST_ROWS = 500_000
#: Matches whose places are summed up in one go.
CHUNK = 256
#: Strings followed at once, and alternatives of a query.
STRINGS = 64


class Rule(NamedTuple):
    kind: str
    pattern: str
    #: The group that has to have ``least`` characters.
    group: int = 0
    least: int = 1


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join([*map(_either_case, ("password", "passwd", "secret", "token")), "[Aa][Pp][Ii]_?[Kk][Ee][Yy]"])

BASE = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    # The least length stands in the expression where a shorter match could not hide another.
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)
# Published forms of tokens and keys.
FORMS = (
    Rule("github", "gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", "[rs]k_(live|test)_[A-Za-z0-9]{16,}"),
    Rule("npm", "npm_[A-Za-z0-9]{36}"),
    Rule("private_key", "-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("bearer", r"[Bb]earer\x20+[A-Za-z0-9._~+/-]{16,}"),
    Rule("url_password", r"[a-z]{2,12}://[A-Za-z0-9._~%-]+:[A-Za-z0-9._~%!$&*+=-]+@[A-Za-z0-9.-]+"),
)
RULES = BASE + FORMS

Query = frozenset[frozenset[str]]
_ANY: Query = frozenset([frozenset()])


def _least_sets(sets) -> Query:
    """Without alternatives that hold another whole."""
    sets = set(sets)
    return frozenset(s for s in sets if not any(t < s for t in sets))


def _both(a: Query, b: Query) -> Query:
    if len(a) * len(b) > STRINGS:
        # Either alone is a condition that has to hold; the one with longer sets tells more.
        return max(a, b, key=lambda q: min(map(len, q)))
    return _least_sets(x | y for x, y in product(a, b))


def _of_strings(strings: set[str]) -> Query:
    return _least_sets(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _strings(item: tuple) -> set[str] | None:
    """All lower-cased strings an item of a parsed expression matches, if they are few."""
    kind, value = item
    if kind is op.LITERAL:
        return {chr(value).lower()}
    if kind is op.IN:
        found = set()
        for k, v in value:
            if k is op.LITERAL:
                found.add(chr(v).lower())
            elif k is op.RANGE and v[1] - v[0] < STRINGS:
                found |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return None
        return found if len(found) <= 8 else None
    if kind is op.SUBPATTERN:
        return _sequence_strings(value[-1])
    if kind is op.BRANCH:
        each = [_sequence_strings(s) for s in value[1]]
        return set().union(*each) if all(s is not None for s in each) else None
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        low, high, inner = value
        once = _sequence_strings(inner)
        if once is None or high is op.MAXREPEAT or high > 4:
            return None
        found = set()
        for n in range(low, high + 1):
            if len(once) ** n > STRINGS:
                return None
            found |= {"".join(p) for p in product(once, repeat=n)}
        return found
    return None


def _sequence_strings(items) -> set[str] | None:
    found = {""}
    for item in items:
        one = _strings(item)
        if one is None or len(found) * len(one) > STRINGS:
            return None
        found = {a + b for a in found for b in one}
    return found


def _sequence_query(items) -> Query:
    query, run = _ANY, {""}
    for item in items:
        one = _strings(item)
        if one is not None and len(run) * len(one) <= STRINGS:
            run = {a + b for a in run for b in one}
            continue
        # Repetitions begin and end with what they repeat.
        edge = _edge(item)
        if edge is not None and len(run) * len(edge) <= STRINGS:
            run = {a + b for a in run for b in edge}
        query = _both(query, _of_strings(run))
        run = one or edge or {""}
        if one is None:
            query = _both(query, _item_query(item))
    return _both(query, _of_strings(run))


def _edge(item: tuple) -> set[str] | None:
    """What an item that is there once at least repeats, if that is few strings."""
    kind, value = item
    return _sequence_strings(value[2]) if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] > 0 else None


def _item_query(item: tuple) -> Query:
    kind, value = item
    if kind is op.SUBPATTERN:
        return _sequence_query(value[-1])
    if kind is op.BRANCH:
        each = _least_sets(s for alternative in value[1] for s in _sequence_query(alternative))
        return each if len(each) <= STRINGS else _ANY
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] > 0:
        return _sequence_query(value[2])
    return _ANY


def trigram_query(pattern: str) -> list[list[str]]:
    """Sets of trigrams, one of which every match holds; none if a match may hold no trigram."""
    query = _sequence_query(_parser.parse(pattern))
    return [] if frozenset() in query else sorted(sorted(s) for s in query)


def _row(rows: DataFrame) -> DataFrame:
    return rows.select("id", "text", F.xxhash64("id", "text").alias("row"))


def trigram_index(rows: DataFrame, trigrams: list[str], shards: int) -> DataFrame:
    """(shard, trigram, rows): sorted lists of the rows (row, text) whose text holds a trigram."""
    low = rows.select("row", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains(F.col("low"), F.lit(t)), F.lit(t)) for t in trigrams]))
    each = low.select("row", F.explode(held).alias("trigram"))
    shard = F.pmod(F.col("row"), F.lit(shards)).cast("int").alias("shard")
    return each.groupBy(shard, "trigram").agg(F.sort_array(F.collect_set("row")).alias("rows"))


def candidates(index: DataFrame, queries: dict[int, list[list[str]]]) -> DataFrame:
    """(row, rules) from the index: the rules, by number, whose query a row fulfils."""
    lists = index.groupBy("shard").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "rows"))).alias("lists"))
    none = F.array().cast("array<bigint>")

    def held(trigrams: list[str]) -> Column:
        each = [F.coalesce(F.col("lists")[t], none) for t in trigrams]
        return reduce(F.array_intersect, each)

    found = [
        F.struct(F.lit(rule).alias("rule"), reduce(F.array_union, map(held, query)).alias("rows"))
        for rule, query in queries.items()
    ]
    pairs = lists.select(F.inline(F.array(*found))).select("rule", F.explode("rows").alias("row"))
    return pairs.groupBy("row").agg(F.collect_set("rule").alias("rules"))


def _matches(rows: DataFrame, rules: tuple[Rule, ...], whole: set[int]) -> DataFrame:
    """Rows (id, text, rules) as (id, spans)."""
    asked = lambda i: F.lit(True) if i in whole else F.array_contains("rules", i)
    found = rows.select(
        "*", *[F.when(asked(i), F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0))).alias(f"m{i}") for i, r in enumerate(rules)]
    )
    parts = []
    for i, r in enumerate(rules):
        some = F.size(f"m{i}") > 0
        # What stands before the matches, and the groups to be measured.
        parts.append(F.when(some, F.split("text", r.pattern, -1)).alias(f"p{i}"))
        parts.append(F.when(some & F.lit(r.group > 0), F.regexp_extract_all("text", F.lit(r.pattern), F.lit(r.group))).alias(f"g{i}"))
    found = found.select("id", *[f"m{i}" for i in range(len(rules))], *parts)

    def sizes(i: int, rule: Rule) -> Column:
        def size(match: Column, at: Column) -> Column:
            held = F.get(f"g{i}", at) if rule.group else match
            gap = F.length(F.get(f"p{i}", at))
            return F.struct(gap.alias("gap"), F.length(match).alias("size"), (F.length(held) >= rule.least).alias("good"))

        return F.transform(f"m{i}", size).alias(f"s{i}")

    found = found.select("id", *[sizes(i, r) for i, r in enumerate(rules)])
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    spans = F.flatten(F.array(*[F.coalesce(_spans(F.col(f"s{i}"), i), none) for i in range(len(rules))]))
    return found.select("id", F.sort_array(spans).alias("spans"))


def _spans(sizes: Column, kind: int) -> Column:
    """(start, kind, end) of matches (gap, size, good) that follow one another.

    Sums run over chunks first, then over the matches of each, as a list grows by copying.
    """
    length = lambda s: s["gap"] + s["size"]
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / CHUNK).cast("int")),
        lambda c: F.slice(sizes, c * CHUNK + 1, F.lit(CHUNK)),
    )
    span = F.struct(F.lit(0).cast("long").alias("start"), F.lit(kind).alias("kind"), F.lit(0).cast("long").alias("end"))
    empty = F.filter(F.array(span), lambda x: F.lit(False))

    def follow(at: Column, chunk: Column) -> Column:
        def step(state: Column, s: Column) -> Column:
            start = state["at"] + s["gap"]
            end = start + s["size"]
            new = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
            return F.struct(
                end.alias("at"), F.when(s["good"], F.array_append(state["spans"], new)).otherwise(state["spans"]).alias("spans")
            )

        return F.aggregate(chunk, F.struct(at.alias("at"), empty.alias("spans")), step)["spans"]

    zero = F.lit(0).cast("long")
    starts = F.aggregate(
        F.transform(chunks, lambda c: F.aggregate(c, zero, lambda a, s: a + length(s))),
        F.array(zero),
        lambda a, n: F.array_append(a, F.element_at(a, -1) + n),
    )
    spans = F.flatten(F.zip_with(F.slice(starts, 1, F.size(chunks)), chunks, follow))
    return F.when(F.size(sizes) > 0, spans)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) of each row: places (start, kind, end) by start and then the rules' order,
    kind being the number of the rule."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "secrets")
    rows = _row(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")))
    queries = {i: trigram_query(r.pattern) for i, r in enumerate(rules)}
    whole = {i for i, q in queries.items() if not q}
    queries = {i: q for i, q in queries.items() if q}
    trigrams = sorted({t for q in queries.values() for s in q for t in s})
    if not trigrams:
        return _matches(rows.withColumn("rules", F.array().cast("array<int>")), rules, whole)
    shards = max(1, math.ceil(rows.count() / SHARD))
    index = scratch.keep(trigram_index(rows, trigrams, shards), "index")
    found = scratch.keep(candidates(index, queries), "candidates")
    few = found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    joined = rows.join(F.broadcast(found) if few else found, "row", "left")
    return _matches(joined.select("id", "text", "rules"), rules, whole)


def listed(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")

"""Quality rules as a short-circuit cascade.

The rules of a document stand in a chain that ends at the first rejection. A sample tells
what each rule costs and which rules reject the same documents; the chain is then put
together from its front, each time by the rule with most rejections per second among what
the rules before it leave, so most bad documents leave after the cheapest test that catches
them. The order changes the time a run takes and never a verdict: a document is kept if no
rule rejects it. The report counts what the base rule needs for every document, so there it
stands outside the chain; where only verdicts are wanted its two conditions are rules like
the others.

Defined cases: a null or empty text has no words and fails the base rule; a null id is
carried through; repeated rows are judged alike, each for itself; an empty table gives an
empty result; further columns of any name are ignored, or kept by ``keep_good``.
"""

from __future__ import annotations

import operator
import re
import time
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from matchlake.llm.common import WORD

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Rows a sample has on average; costs and selectivities come from it, verdicts do not.
SAMPLE_ROWS = 2000

_SHOUTED = re.compile(r"[!?]{2,}$")
_LETTER = re.compile(r"[^\W\d_]")


def symbols(text: str) -> int:
    return sum(map(text.count, SYMBOLS))


def lines_with_words(text: str) -> list[str]:
    return [line for line in text.split("\n") if WORD.search(line)]


def duplicate_lines(text: str) -> int:
    lines = lines_with_words(text)
    return len(lines) - len(set(lines))


def repeated_words(words: list[str]) -> int:
    """Words inside windows that occur more than once, each word counted once."""
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    if len(set(windows)) == len(windows):
        return 0
    times, covered, total = Counter(windows), 0, 0
    for start, window in enumerate(windows):
        if times[window] > 1:
            total += start + WINDOW - max(covered, start)
            covered = start + WINDOW
    return total


def base_failed(words: list[str], n_repeat: int) -> bool:
    return len(words) < 10 or 100 * n_repeat > 20 * len(words)


def too_many_symbols(text: str, words: list[str]) -> bool:
    """More than 20 symbols on 100 words."""
    return 100 * symbols(text) > 20 * len(words)


def too_many_duplicate_lines(text: str, words: list[str]) -> bool:
    """At least three lines equal an earlier one, and more than 30 of 100 do."""
    duplicates = duplicate_lines(text)
    return duplicates >= 3 and 100 * duplicates > 30 * len(lines_with_words(text))


def shouting(text: str, words: list[str]) -> bool:
    """More than 60 of 100 cased letters are capitals."""
    capitals = sum(map(str.isupper, text))
    return 100 * capitals > 60 * (capitals + sum(map(str.islower, text)))


def exclaiming(text: str, words: list[str]) -> bool:
    """More than 20 of 100 words end in several exclamation or question marks."""
    return 100 * sum(1 for w in words if _SHOUTED.search(w)) > 20 * len(words)


def stuttering(text: str, words: list[str]) -> bool:
    """More than 30 of 100 words equal the word before."""
    return 100 * sum(map(operator.eq, words, words[1:])) > 30 * len(words)


def few_letters(text: str, words: list[str]) -> bool:
    """More than 40 of 100 words hold no letter."""
    return 100 * sum(1 for w in words if not _LETTER.search(w)) > 40 * len(words)


def endless_words(text: str, words: list[str]) -> bool:
    """Words of more than 100 characters on average."""
    return sum(map(len, words)) > 100 * len(words)


RULES: dict[str, Callable[[str, list[str]], bool]] = {
    "too_many_symbols": too_many_symbols,
    "too_many_duplicate_lines": too_many_duplicate_lines,
    "shouting": shouting,
    "exclaiming": exclaiming,
    "stuttering": stuttering,
    "few_letters": few_letters,
    "endless_words": endless_words,
}


def too_few_words(text: str, words: list[str]) -> bool:
    return len(words) < 10


def repeating(text: str, words: list[str]) -> bool:
    """More than 20 of 100 words lie in windows that occur more than once."""
    return 100 * repeated_words(words) > 20 * len(words)


#: The rules of a whole verdict: the base rule's conditions and the others.
ALL_RULES = {"too_few_words": too_few_words, "repeating": repeating} | RULES


def passes(text: str, words: list[str], order: list[str]) -> bool:
    return not any(ALL_RULES[name](text, words) for name in order)


def rule_profile(docs: DataFrame, names: list[str], text_col: str = "text") -> DataFrame:
    """(rejecting, rule, rows, seconds): documents by the set of rules that reject them, a bit
    for each name, and beside them the time every rule took."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "", WORD.findall(t or "")) for t in batch.column(0).to_pylist()]
            masks, took = [0] * len(texts), []
            for bit, name in enumerate(names):
                rule, start = ALL_RULES[name], time.perf_counter()
                verdicts = [rule(t, w) for t, w in texts]
                took.append((None, name, len(texts), time.perf_counter() - start))
                masks = [m | v << bit for m, v in zip(masks, verdicts)]
            found = [(mask, None, n, 0.0) for mask, n in Counter(masks).items()] + took
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*found), kinds)], ["rejecting", "rule", "rows", "seconds"]
            )

    each = docs.select(F.col(text_col).alias("text")).mapInArrow(
        measure, "rejecting long, rule string, rows long, seconds double"
    )
    return each.groupBy("rejecting", "rule").agg(F.sum("rows").alias("rows"), F.sum("seconds").alias("seconds"))


def chained(names: list[str], masks: dict[int, int], seconds: dict[str, float]) -> list[str]:
    """Rules by rejections per second among the documents that those before them leave."""
    order, left = [], dict(masks)
    while len(order) < len(names):

        def worth(name: str) -> float:
            caught = sum(n for mask, n in left.items() if mask >> names.index(name) & 1)
            return (caught + 0.01) / (seconds.get(name, 0.0) + 1e-9)

        order.append(max((n for n in names if n not in order), key=worth))
        left = {mask: n for mask, n in left.items() if not mask >> names.index(order[-1]) & 1}
    return order


def cascade(
    docs: DataFrame, names: list[str], text_col: str = "text", sample_rows: int = SAMPLE_ROWS
) -> list[str]:
    """Rules in the order in which the chain asks them."""
    total = docs.count()
    share = min(1.0, sample_rows / max(total, 1))
    picked = F.pmod(F.xxhash64(text_col), F.lit(1_000_000)) < int(share * 1_000_000 + 1)
    profile = rule_profile(docs.filter(picked), names, text_col).collect()
    masks = {r["rejecting"]: r["rows"] for r in profile if r["rule"] is None}
    return chained(names, masks, {r["rule"]: r["seconds"] for r in profile if r["rule"]})


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and verdicts of every document, over whole texts."""
    order = cascade(docs, list(RULES), text_col)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                text = text or ""
                words = WORD.findall(text)
                repeat = repeated_words(words)
                failed = base_failed(words, repeat)
                kept = not failed and passes(text, words, order)
                rows.append(
                    (len(words), sum(map(len, words)), symbols(text), duplicate_lines(text), repeat, failed, kept)
                )
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
            )

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    id_type = slim.schema["id"].dataType.simpleString()
    report = slim.mapInArrow(judge, f"id {id_type}, {counts}, base_failed boolean, kept boolean")
    return report.withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of all documents that no rule rejects, with all their columns."""
    order, at = cascade(docs, list(ALL_RULES), text_col), docs.columns.index(text_col)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for text in batch.column(at).to_pylist():
                words = WORD.findall(text or "")
                good.append(passes(text or "", words, order))
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(choose, docs.schema)

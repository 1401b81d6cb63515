"""Language identification by cross-parsing entropy.

Each language is known by a bounded sample of its labelled text, in the form of the suffix
automaton of that sample. A text is parsed against an automaton from left to right into the
longest phrases that occur in the sample; a text needs few, long phrases with its own
language. Phrases times the logarithm of the sample's length, over the text's length,
estimates its cross entropy in bits per character; the language with the least wins. The
score is how much less that is than the second best, from 0 to 1.

Texts are lower-cased and runs of other than letters count as one space. Letters above the
first plane are told apart by their code's remainder, so those of one script differ. Texts are parsed
in segments of ``SEGMENT`` characters, all of them: transitions are in a table, so many
segments take a step at once. The table holds the more frequent characters of every
language, as many as its size allows for; transitions by all others, of which scripts with
thousands of characters have many, are found in a sorted list. Both count alike.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, as is every
text if no language was learned; a null id is not held out and not learned from; of equal
costs the smaller name wins; one learned language scores 1; an empty table gives an empty
result; further columns of any name are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Characters of text a language is learned from, at most, and those of one document.
SAMPLE = 32_768
SAMPLE_OF_DOCUMENT = SAMPLE // 16
#: Characters of all samples together, at most, with no fewer than LEAST_SAMPLE for each.
SAMPLES = 1 << 26
LEAST_SAMPLE = 1024
#: Entries of the transition table of all languages, four bytes each. Transitions by
#: characters too rare for it are looked up in a sorted list, some 24 bytes a character.
CELLS = 1 << 24
SEGMENT = 1024
FOLDS = 5

_PLANE = 1 << 16
#: Surrogates and private use, where no letter is: letters above the first plane go there.
_SPARE, _SPARES = 0xD800, 0xF900 - 0xD800


def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(_PLANE)])


_LETTER = _letters()


def normal_codes(text: str) -> np.ndarray:
    """Code points of a text, lower-cased, with one space for each run of non-letters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    low = codes < _PLANE
    letter = _LETTER[np.where(low, codes, 0)]
    if not low.all():
        high, place = np.unique(codes[~low], return_inverse=True)
        letter[~low] = np.array([chr(c).isalpha() for c in high.tolist()])[place]
        codes = np.where(low, codes, _SPARE + codes % _SPARES)
    codes = np.where(letter, codes, 32).astype(np.uint16)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    return codes[keep]


def suffix_automaton(symbols: np.ndarray) -> list[dict[int, int]]:
    """Transitions of every state of the automaton of all substrings; state 0 is the root."""
    follow: list[dict[int, int]] = [{}]
    length, link, last = [0], [-1], 0
    for symbol in symbols.tolist():
        now = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and symbol not in follow[p]:
            follow[p][symbol] = now
            p = link[p]
        if p >= 0:
            q = follow[p][symbol]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                copy = len(follow)
                follow.append(dict(follow[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[now] = copy
                while p >= 0 and follow[p].get(symbol) == q:
                    follow[p][symbol] = copy
                    p = link[p]
        last = now
    return follow


class Parser:
    """Counts the phrases of texts against all languages at once.

    An entry of the table is the next state's row, shifted left by two, plus the phrases
    that end with the step: where the automaton cannot go on, the phrase ends and the next
    begins with the same character, which is a phrase of its own if it is unknown.
    """

    def __init__(self, samples: dict[str, str], cells: int | None = None):
        self.names = sorted(samples)
        self.classes, self.bits, self.roots, automata = [], [], [], []
        for name in self.names:
            codes = normal_codes(samples[name])
            known = [c for c, _ in Counter(codes.tolist()).most_common()]
            classes = np.zeros(_PLANE, np.uint16)
            classes[known] = np.arange(1, len(known) + 1)
            automata.append((suffix_automaton(classes[codes]), len(known)))
            self.classes.append(classes)
            self.bits.append(math.log2(max(2, len(codes))))
        states = sum(len(follow) for follow, _ in automata)
        most = max((n for _, n in automata), default=0)
        #: Classes of a language with a column in the table; the others are rare.
        self.columns = max(0, min(most, (CELLS if cells is None else cells) // max(1, states) - 1))
        width, tables, keys, nexts, base = self.columns + 1, [], [], [], 0
        if states * width >= 1 << 29:
            raise ValueError(f"{states} states of {len(self.names)} languages are too many for a table")
        for follow, _ in automata:
            table = np.full((len(follow), width), -1, np.int64)
            for state, go in enumerate(follow):
                for symbol, to in go.items():
                    if symbol < width:
                        table[state, symbol] = to
                    else:
                        keys.append((base + state * width) * _PLANE + symbol)
                        nexts.append(base + to * width)
            table[:, 0] = -1
            root = np.where(table[0] < 0, (base << 2) | 1, (base + table[0] * width) << 2)
            entry = np.where(table < 0, root[None, :] + 1, (base + table * width) << 2)
            entry[0] = root
            tables.append(entry.astype(np.int32).ravel())
            self.roots.append(base)
            base += table.size
        self.table = np.concatenate(tables) if tables else np.empty(0, np.int32)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys, self.nexts = np.array(keys, np.int64)[order], np.array(nexts, np.int64)[order]

    def _rare_steps(self, row: np.ndarray, symbol: np.ndarray, root: np.ndarray) -> np.ndarray:
        """Entries of steps by rare characters; from its root every one of them goes on."""

        def find(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            wanted = rows * _PLANE + symbol
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            return self.keys[at] == wanted, self.nexts[at]

        there, to = find(row)
        return (np.where(there, to, find(root)[1]) << 2) | ~there

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Numbers of phrases, a row for each language and a column for each text."""
        owner, parts = [], []
        for i, codes in enumerate(texts):
            for at in range(0, len(codes), SEGMENT):
                owner.append(i)
                parts.append(codes[at : at + SEGMENT])
        out = np.zeros((len(self.names), len(texts)), np.int64)
        if not parts:
            return out
        lengths = np.array([len(p) for p in parts])
        order = np.argsort(-lengths, kind="stable")
        lengths = lengths[order]
        grid = np.zeros((len(parts), int(lengths[0])), np.uint16)
        for row, k in enumerate(order):
            grid[row, : lengths[row]] = parts[k]
        steps = np.stack([c[grid.T] for c in self.classes], axis=1)
        active = np.searchsorted(-lengths, -np.arange(len(steps)), "left")
        roots = np.array(self.roots)[:, None]
        row = np.repeat(roots, len(parts), axis=1)
        count = np.zeros(row.shape, np.int64)
        for t, n in enumerate(active):
            step = steps[t][:, :n]
            rare = step > self.columns
            if not len(self.keys) or not rare.any():
                entry = self.table[row[:, :n] + step]
            else:
                entry = self.table[row[:, :n] + np.where(rare, 0, step)].astype(np.int64)
                starts = np.broadcast_to(roots, rare.shape)
                entry[rare] = self._rare_steps(row[:, :n][rare], step[rare].astype(np.int64), starts[rare])
            row[:, :n] = entry >> 2
            count[:, :n] += entry & 3
        count += row != roots
        for k in range(len(self.names)):
            out[k] = np.bincount(np.array(owner)[order], count[k], len(texts)).astype(np.int64)
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        codes = [normal_codes(t or "") for t in texts]
        usable = [len(c) > 0 and bool(self.names) for c in codes]
        chosen = [c for c, u in zip(codes, usable) if u]
        lengths = np.array([len(c) for c in chosen])
        found = iter(())
        if chosen:
            cost = self.phrases(chosen) * np.array(self.bits)[:, None] / lengths
            best = np.argmin(cost, axis=0)
            low = cost.min(axis=0)
            second = np.partition(cost, 1, axis=0)[1] if len(self.names) > 1 else np.full(len(low), np.inf)
            found = zip(best, 1 - low / second)
        out = []
        for u in usable:
            name, score = next(found) if u else (None, 0.0)
            out.append((self.names[name], float(score)) if u else ("und", 0.0))
        return out


_parsers: dict[int, Parser] = {}


def parser(samples: dict[str, str]) -> Parser:
    """The parser of this worker process."""
    key = hash(tuple(sorted(samples.items())))
    if key not in _parsers:
        _parsers.clear()
        _parsers[key] = Parser(samples)
    return _parsers[key]


def held_out(doc_id) -> F.Column:
    fold = F.crc32(F.col(doc_id).cast("string")) % FOLDS
    return F.coalesce(fold == 0, F.lit(False))


def samples(docs: DataFrame) -> dict[str, str]:
    """Text of each language from (id, lang, text), at most SAMPLE characters, or an equal part
    of SAMPLES where that is less.

    Documents are chosen by a hash of their id, as many as give the sample a few times over.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("id").isNotNull() & ~held_out("id"))
    given = F.least(F.length("text"), F.lit(SAMPLE_OF_DOCUMENT))
    sizes = labelled.groupBy("lang").agg(F.coalesce(F.sum(given), F.lit(0)).alias("size")).collect()
    if not sizes:
        return {}
    size = max(LEAST_SAMPLE, min(SAMPLE, SAMPLES // len(sizes)))
    mark = F.pmod(F.xxhash64("id"), F.lit(1_000_000_000))
    below = [(r["lang"], int(min(1.0, 3 * size / max(r["size"], 1)) * 1_000_000_000)) for r in sizes]
    kind = docs.schema["lang"].dataType.simpleString()
    below = F.broadcast(docs.sparkSession.createDataFrame(below, f"lang {kind}, below long"))
    part = F.substring("text", 1, SAMPLE_OF_DOCUMENT)
    chosen = labelled.join(below, "lang").filter(mark < F.col("below"))
    rows = chosen.select("lang", mark.alias("mark"), part.alias("part")).collect()
    texts: dict[str, str] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["mark"], r["part"] or "")):
        had = texts.get(row["lang"], "")
        if len(had) < size and row["part"]:
            texts[row["lang"]] = (had + " " + row["part"])[:size]
    return {name: text for name, text in texts.items() if len(normal_codes(text))}


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score) of every row; learned from rows not held out."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    learned = slim.sparkSession.sparkContext.broadcast(samples(slim))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = parser(learned.value)
        for batch in batches:
            found = known.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array([name for name, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                ["id", "held_out", "lang_pred", "score"],
            )

    rows = slim.select("id", held_out("id").alias("held_out"), "text")
    kind = slim.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(predict, f"id {kind}, held_out boolean, lang_pred string, score double")
    return found.withColumnRenamed("id", id_col)

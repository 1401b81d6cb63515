"""Periodic runs of words, found by block convolution.

A run is a stretch of consecutive words with a smallest period q (words q apart are equal)
that no neighbouring word extends, of at least ``least`` words and ``times`` periods.

Scales are powers of two. At scale B a text is cut into blocks at multiples of B, and each
block is sought in the window that follows it, at distances from B up to 2B. The sum of
squared differences between a block and every place of its window is the sum of both
squares less twice a correlation, which a number-theoretic transform gives exactly modulo a
prime; it is zero where the block occurs again. A run of period B <= q < 2B and three
periods holds a whole block together with its occurrence q words on, so none is missed.
Occurrences are seeds: their distance is followed to both sides on the words themselves,
which also settles sums that are zero only modulo the prime.

Scales go up, so shorter periods are known first. An occurrence inside a known run whose
period fits into the block is passed over: by the theorem of Fine and Wilf it could only
show a multiple of that period.

Texts are independent of one another, so nothing is shuffled. The blocks of all texts of a
batch are transformed together, in parts of bounded size; blocks are at most ``CAP`` words,
larger scales look for the first ``CAP`` words of each block in tiles of its window.

Defined cases: null and empty texts have no words, no run and an empty collapsed text; rows
are treated one by one, so repeated rows and ids give repeated results; a very long text
takes memory in proportion to its length; an empty table gives an empty result; further
columns of any name are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

LEAST = 24
TIMES = 3
#: 7 * 2**20 + 1, with primitive root 3: products stay exact in double precision.
PRIME = 7340033
ROOT = 3
#: Words of a block at most; transforms have twice this length.
CAP = 4096
#: Numbers transformed at once, and words of the texts taken together.
CELLS = 1 << 16
WORDS_AT_ONCE = 1 << 18


def _reduced(x: np.ndarray) -> np.ndarray:
    """Modulo the prime, in place; from 0 to the prime itself."""
    x -= np.floor(x * (1.0 / PRIME)) * PRIME
    return x


@lru_cache(maxsize=64)
def _powers(half: int, inverse: bool) -> np.ndarray:
    root = pow(ROOT, (PRIME - 1) // (2 * half), PRIME)
    root = pow(root, PRIME - 2, PRIME) if inverse else root
    out = np.ones(half)
    for i in range(1, half):
        out[i] = int(out[i - 1]) * root % PRIME
    return out[:, None]


def transform(a: np.ndarray) -> np.ndarray:
    """The transform of each column, in bit-reversed order."""
    size, columns = a.shape
    half = size // 2
    while half:
        a = a.reshape(-1, 2, half, columns)
        low, high = a[:, 0], a[:, 1]
        out = np.empty_like(a)
        _reduced(np.add(low, high, out=out[:, 0]))
        difference = np.subtract(low, high, out=out[:, 1])
        if half > 1:
            difference *= _powers(half, False)
        _reduced(difference)
        a, half = out, half // 2
    return a.reshape(size, columns)


def back(a: np.ndarray) -> np.ndarray:
    """From bit-reversed order to what was transformed."""
    size, columns = a.shape
    half = 1
    while half < size:
        a = a.reshape(-1, 2, half, columns)
        low, high = a[:, 0], a[:, 1]
        if half > 1:
            high = _reduced(high * _powers(half, True))
        out = np.empty_like(a)
        _reduced(np.add(low, high, out=out[:, 0]))
        _reduced(np.subtract(low, high, out=out[:, 1]))
        a, half = out, half * 2
    return _reduced(a.reshape(size, columns) * pow(size, PRIME - 2, PRIME))


def correlations(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """(place, column): sums of products of a block (b, columns) with the b words from each
    of the first b places of its window (2b, columns), modulo the prime."""
    b = len(blocks)
    reversed_ = np.concatenate([blocks[::-1], np.zeros_like(blocks)])
    product = _reduced(transform(reversed_) * transform(windows))
    return back(product)[b - 1 : 2 * b - 1]


class _Texts:
    """Texts laid end to end as numbers of words, and the runs found so far."""

    def __init__(self, texts: list[list[bytes]], least: int, times: int):
        self.least, self.times = least, times
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64)
        self.ends = self.starts + self.sizes
        total = int(self.sizes.sum())
        codes: defaultdict[bytes, int] = defaultdict()
        codes.default_factory = codes.__len__
        self.words = np.fromiter(map(codes.__getitem__, chain.from_iterable(texts)), np.int64, total)
        self.values = np.concatenate([self.words % PRIME, np.zeros(1, np.int64)]).astype(np.float64)
        squares = (self.values.astype(np.int64) ** 2) % PRIME
        self.squares = np.concatenate([[0], np.cumsum(squares)])
        self.runs: list[dict[tuple[int, int], int]] = [{} for _ in texts]
        #: The last end of a known run around a word, of periods that fit into a block.
        self.reach = np.zeros(total, np.int64)

    def find(self) -> None:
        scale = 1
        while True:
            chosen = np.flatnonzero(self.sizes >= max(self.least, self.times * scale))
            if not len(chosen):
                return
            self._scale(scale, chosen)
            scale *= 2

    def _scale(self, scale: int, chosen: np.ndarray) -> None:
        b = min(scale, CAP)
        # Blocks with room for an occurrence at the least distance.
        counts = np.maximum((self.sizes[chosen] - scale - b) // scale + 1, 0)
        text = np.repeat(chosen, counts)
        number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = self.starts[text] + number * scale
        seeds = []
        step = max(1, CELLS // (2 * b))
        for at in range(0, len(text), step):
            part = slice(at, at + step)
            for tile in range(0, scale, b):
                seeds.append(self._seeds(text[part], number[part], start[part], scale + tile, b, scale))
        if not seeds:
            return
        text, start, apart = map(np.concatenate, zip(*seeds))
        order = np.lexsort([start, apart, text])
        found, past = [], (-1, -1, -1)
        for seed in zip(text[order].tolist(), start[order].tolist(), apart[order].tolist()):
            # A seed in the stretch followed last shows nothing new.
            if seed[::2] != past[::2] or seed[1] >= past[1]:
                first, end = self._followed(*seed, b)
                past = (seed[0], end, seed[2])
                if end - first + seed[2] >= max(self.least, self.times * seed[2]):
                    found.append((seed[0], first, end + seed[2], seed[2]))
        for run in found:
            self._add(*run)

    def _seeds(
        self, text: np.ndarray, number: np.ndarray, start: np.ndarray, nearest: int, b: int, scale: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, start, distance) of blocks that occur again at a distance of nearest to nearest + b - 1."""
        last = len(self.values) - 1
        blocks = self.values[start + np.arange(b)[:, None]]
        windows = self.values[np.minimum(start + nearest + np.arange(2 * b)[:, None], last)]
        products = correlations(blocks, windows)
        place = np.minimum(start + nearest + np.arange(b)[:, None], last - b)
        own = self.squares[start + b] - self.squares[start]
        other = self.squares[place + b] - self.squares[place]
        difference = (own + other - 2 * products.astype(np.int64)) % PRIME
        distance = nearest + np.arange(b)[:, None]
        again = (difference == 0) & (start + distance + b <= self.ends[text])
        at, column = np.nonzero(again & (self.reach[start] < start + distance + b))
        begin, apart = start[column], nearest + at
        # Where the block before does not occur at the same distance, a stretch begins after
        # that block's start, so a long enough one still holds at known places.
        known = (number[column] == 0) | ((column > 0) & ~again[at, column - 1])
        length = np.maximum(self.least, self.times * apart) - apart
        good = np.ones(len(begin), bool)
        for share in (1.0, 0.5, 0.75, 0.25):
            probe = begin + ((length - scale) * share).astype(np.int64)
            inside = (probe >= begin) & (probe + apart < self.ends[text[column]])
            probe = np.where(inside, probe, begin)
            fits = self.words[probe] == self.words[np.minimum(probe + apart, len(self.words) - 1)]
            short = (length > scale) & (begin + length - scale + apart > self.ends[text[column]])
            good &= ~known | (fits & ~short)
        return text[column][good], begin[good], apart[good]

    def _followed(self, text: int, start: int, apart: int, b: int) -> tuple[int, int]:
        """The stretch of words around a seed that equal those at its distance; empty if the
        seed's own words do not."""
        words, low, high = self.words, int(self.starts[text]), int(self.ends[text])
        if not np.array_equal(words[start : start + b], words[start + apart : start + apart + b]):
            return start, start - apart
        end, step = start + b, 64
        while end + apart < high:
            stop = min(end + step, high - apart)
            unlike = np.flatnonzero(words[end:stop] != words[end + apart : stop + apart])
            if len(unlike):
                end += int(unlike[0])
                break
            end, step = stop, step * 2
        first, step = start, 64
        while first > low:
            stop = max(first - step, low)
            unlike = np.flatnonzero(words[stop:first] != words[stop + apart : first + apart])
            if len(unlike):
                first = stop + int(unlike[-1]) + 1
                break
            first, step = stop, step * 2
        return first, end

    def _add(self, text: int, first: int, end: int, period: int) -> None:
        # A stretch that is known already has a shorter period, of which this is a multiple.
        if self.runs[text].setdefault((first, end), period) == period and period <= CAP:
            np.maximum(self.reach[first:end], end, out=self.reach[first:end])

    def result(self, text: int) -> list[tuple[int, int, int]]:
        """(start, length, period) by start, then period."""
        low = int(self.starts[text])
        found = [(first - low, end - first, period) for (first, end), period in self.runs[text].items()]
        return sorted(found, key=lambda r: (r[0], r[2]))


def runs_of(texts: list[list[bytes]], least: int = LEAST, times: int = TIMES) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, a list of words."""
    if times < 3:
        raise ValueError("runs of fewer than three periods may hold no whole block and its occurrence")
    found = _Texts(texts, least, times)
    found.find()
    return [found.result(i) for i in range(len(texts))]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside runs and in the first period of those that hold no word of another
    run's later periods, joined by spaces."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join([w for w, k in zip(words, keep) if k])


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES
) -> DataFrame:
    """(id, n_words, runs, collapsed) of each row: its runs by start and period, and the text
    without the words of a run after its first period."""
    kind = docs.schema[id_col].dataType.simpleString()
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t.as_py() or b"").split() for t in batch.column(1).cast(pa.binary())]
            runs: list[list[tuple[int, int, int]]] = []
            at = 0
            while at < len(texts):
                end, words = at, 0
                while end < len(texts) and (end == at or words + len(texts[end]) <= WORDS_AT_ONCE):
                    words += len(texts[end])
                    end += 1
                runs += runs_of(texts[at:end], least, times)
                at = end
            rows = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
            left = pa.array([collapsed(t, r) for t, r in zip(texts, runs)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(rows, pa.list_(run)), left],
                ["id", "n_words", "runs", "collapsed"],
            )

    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return slim.mapInArrow(
        found,
        f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string",
    )

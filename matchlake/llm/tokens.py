"""Token ids of whole texts, by a published vocabulary that is a parameter."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

#: Entries of one generation of the memory; a worker holds two generations.
MEMORY = 250_000
#: Characters of the texts whose chunks are looked up together.
BLOCK_CHARS = 4 << 20
#: Parts chunks: texts with control characters are not cut into chunks.
_MARK = "\0"

# Texts with other white space or control characters, or with what could be a special
# token, are encoded in one piece.
_ODD = re.compile(
    r"[^\S \n]|[\x00-\x09\x0b-\x1f\x7f-\xa0 ᠎ -‏ -  -⁯　﻿]|<\|"
)
_ID = attrgetter("id")
_SPACED = re.compile(r" ?[^ \n]+|[ \n]+(?![^ \n])|[ \n]+")


def _is_odd(text: str) -> bool:
    # No printable character but the plain space is white space; asked first, as it is quick.
    plain = "<|" not in text and text.replace("\n", "").isprintable()
    return not plain and _ODD.search(text) is not None


class Memory(dict):
    """Results for keys met lately: a full generation ages, and goes when the next is full."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= MEMORY:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


# Fixed value: how the byte-level pre-tokenizer splits a text by default.
_BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[int, int]:
    """The printable characters that byte-level vocabularies write for bytes."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


class Encoder:
    """The ids ``tokenizer.encode(text, add_special_tokens=False)`` gives.

    A byte-level tokenizer splits a text before single spaces and at other white space,
    and one that drops white space splits there, before it merges anything. So the ids of
    a text are those of its chunks, the ids of a chunk those of its pre-tokens, and what
    was met before need not be merged again.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        state = json.loads(self.tokenizer.pre_tokenizer.__getstate__())
        own = [p["pattern"]["Regex"] for p in state.get("pretokenizers", []) if p["type"] == "Split"]
        self.split = regex.compile(own[0] if own else _BYTE_LEVEL_SPLIT).findall
        self.normalizer = self.tokenizer.normalizer
        self.letters = _byte_letters()
        self.space = chr(self.letters[ord(" ")])
        self.merge = self.tokenizer.model.tokenize
        self.chunks = Memory(self._chunk)
        self.keeps_spaces = self._whole("a b") != self._whole("a\n\nb")

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            letters = piece.replace(" ", self.space)
        else:
            letters = piece.encode("utf-8").decode("latin-1").translate(self.letters)
        return array("I", map(_ID, self.merge(letters))).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if self.normalizer is not None:
            chunk = chunk.lower() if chunk.isascii() else self.normalizer.normalize_str(chunk)
        # Most chunks are a word of letters, or one with a mark after it.
        word = chunk[1:] if chunk[:1] == " " else chunk
        if word.isalpha():
            return self._piece(chunk)
        if word[:-1].isalpha() and word[-1] in ",.;:!?":
            return self.chunks[chunk[:-1]] + self.chunks[word[-1]]
        return b"".join(map(self._piece, self.split(chunk)))

    def _marked(self, text: str) -> str:
        """The chunks of a text, parted by a character that no text of chunks holds."""
        plain = not any(w in text for w in ("  ", " \n", "\n ", "\n\n")) and text == text.strip(" \n")
        if not self.keeps_spaces:
            return text.replace("\n", _MARK).replace(" ", _MARK) if plain else _MARK.join(text.split())
        # White space that just stands alone between words.
        if plain:
            return text.replace("\n", f"{_MARK}\n{_MARK}").replace(" ", f"{_MARK} ")
        return _MARK.join(_SPACED.findall(text))

    def _block(self, texts: list[str]) -> list[bytes]:
        """A chunk that the block repeats is looked up once."""
        odd = {at: self._whole(t) for at, t in enumerate(texts) if _is_odd(t)}
        marked = ["" if at in odd else self._marked(t) for at, t in enumerate(texts)]
        parts = pc.split_pattern(pa.array(marked, pa.large_string()), _MARK)
        chunks = parts.values.dictionary_encode()
        known = list(map(self.chunks.__getitem__, chunks.dictionary.to_numpy(zero_copy_only=False)))
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        firsts, ids = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(known), "<u4")
        which = chunks.indices.to_numpy()
        taken = sizes[which]
        ends = np.concatenate([[0], np.cumsum(taken)])
        from_to = np.arange(ends[-1]) + np.repeat(firsts[which] - ends[:-1], taken)
        out, bounds = ids[from_to].tobytes(), (4 * ends[parts.offsets.to_numpy()]).tolist()
        return [odd[at] if at in odd else out[bounds[at] : bounds[at + 1]] for at in range(len(texts))]

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text, in blocks of bounded size."""
        block, size = [], 0
        for text in texts:
            if block and size + len(text) > BLOCK_CHARS:
                yield from self._block(block)
                block, size = [], 0
            block.append(text)
            size += len(text)
        if block:
            yield from self._block(block)

    def encode(self, text: str) -> bytes:
        return self._block([text])[0]

    def forget(self) -> None:
        """Without what was remembered of texts; it is found anew."""
        self.chunks.clear()
        self.chunks.old = {}


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]

"""Token ids of whole texts with a public BPE vocabulary, memoised per chunk of a text.

The vocabulary drops white space and never merges across it, so a text's ids are the ids of its
white-space-free chunks one after another. Each task remembers the ids of the chunks it has met; a
chunk it has not met is encoded by the ``tokenizers`` library. The memo is bounded and only saves time:
when it is full it becomes the older half, and chunks met again are taken over from there.
"""

from __future__ import annotations

import re
from functools import lru_cache
from struct import pack

import numpy as np
from tokenizers import Tokenizer

MEMO_ENTRIES = 600_000
CONTROL = re.compile("[\x1c-\x1f]").search  # white space for str.split, not for the vocabulary
# A run of Latin letters, then a run of ASCII marks: every such chunk is its letters in lower case as
# one word and its marks as another, whatever stands around it.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-;=?@\[-`{-~]*)").fullmatch


def byte_alphabet() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Chunks(dict):
    """Chunk of a text -> its ids as little-endian 16-bit integers. A word is a chunk as well and kept once."""

    def __init__(self, path: str, plain_special: bool):
        super().__init__()
        self.older: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_special
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("the vocabulary needs ids below 65,536")
        self.model = self.tokenizer.model
        self.alphabet = {i: c for i, c in enumerate(byte_alphabet())}

    def word(self, text: str) -> bytes:
        """Ids of one word of the vocabulary's own splitting, letters in lower case or marks."""
        shown = text if text.isascii() else text.encode().decode("latin-1").translate(self.alphabet)
        ids = [t.id for t in self.model.tokenize(shown)]
        return pack(f"<{len(ids)}H", *ids)

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self.made(chunk)
        if len(self) >= MEMO_ENTRIES:
            self.older = dict(self)
            self.clear()
        if len(chunk) <= 64:
            self[chunk] = ids
        return ids

    def made(self, chunk: str) -> bytes:
        """Ids of a chunk that is not remembered."""
        if chunk.isascii() and chunk.isalpha():
            return self.word(chunk) if chunk.islower() else self[chunk.lower()]
        if match := PLAIN(chunk):
            letters, marks = match.groups()
            lower = letters.lower()
            return self[lower] + self[marks] if marks else self.word(lower) if lower == chunk else self[lower]
        return self.whole(chunk)

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian 16-bit integers; none for null."""
        if not text:
            return b""
        if CONTROL(text):
            return self.whole(text)
        return b"".join(map(self.__getitem__, text.split()))

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()


@lru_cache(maxsize=2)
def chunks(path: str, plain_special: bool = False) -> Chunks:
    """The encoder of this process for a vocabulary file."""
    return Chunks(path, plain_special)

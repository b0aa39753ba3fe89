"""Whole texts to token ids with the ``tokenizers`` library, each distinct chunk encoded once per worker.

Both tokenizers in use split a text into pieces before their merges, and no piece crosses the place where a
word ends and plain white space begins. A text is therefore cut there, and the ids of a chunk come from the
library the first time and from a bounded table afterwards. Texts with other white space or separators, whose
splitting depends on neighbours, go to the library whole.
"""

from __future__ import annotations

import re
import sys
from array import array
from functools import lru_cache

from tokenizers import Tokenizer

END_ID = 0
# Longer chunks are hardly seen twice.
_LONGEST = 64
_TABLE_SIZE = 1_000_000

_LETTERS = re.compile("[ ]?[A-Za-zÀ-ÖØ-öø-ÿ]+")

_CHUNK = re.compile(r"[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+")
# White space other than the plain four, separators, and marks that some definitions count as space.
_RARE_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200d\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")


# Byte-level vocabularies write each byte as a printable character: itself where it is one, else the next free one.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = dict(zip(sorted(set(range(256)) - set(_PRINTABLE)), range(256, 512)))
_ALPHABET = [chr(c) for c in range(0x41, 0x100) if _LETTERS.fullmatch(chr(c))]
_PROBES = [f"{s}{a}{b}er" for s in ("", " ") for a, b in zip(_ALPHABET, _ALPHABET[7:] + _ALPHABET[:7])]


def _packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class ChunkEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids, without special tokens.

    What the tokenizer does to white space and capitals is asked of it once: one that drops white space
    gets plain words, one that ignores case looks plain words up in lower case.
    """

    def __init__(self, path: str, table_size: int = _TABLE_SIZE):
        self._tokenizer = Tokenizer.from_file(path)
        self._table: dict[str, bytes] = {}
        self._table_size = table_size
        self._merges = self._tokenizer.model
        self._plain = False
        self.drops_space = self._ids(" \n ") == b""
        self.ignores_case = self._ids("Ab") == self._ids("ab")
        # The short way is taken only if it agrees on words that hold every letter it would meet.
        self._plain = True
        self._plain = all(self._piece(w) == self._ids(w) for w in _PROBES if not (self.drops_space and w[0] == " "))

    def _ids(self, text: str) -> bytes:
        return _packed(self._tokenizer.encode(text, add_special_tokens=False).ids)

    def _piece(self, chunk: str) -> bytes:
        """Ids of a chunk; one of plain letters is a single piece, to which only the merges apply."""
        if not self._plain or not _LETTERS.fullmatch(chunk):
            return self._ids(chunk)
        if self.ignores_case:
            chunk = chunk.lower()
        return _packed([t.id for t in self._merges.tokenize(chunk.encode().decode("latin-1").translate(_BYTE_CHARS))])

    def _chunk(self, chunk: str) -> bytes:
        return self._table.get(chunk) or self._learn(chunk)

    def _learn(self, chunk: str) -> bytes:
        """Ids of a chunk that the table lacks: those of its parts where pieces surely end, else the library's."""
        if len(chunk) > _LONGEST:
            return self._ids(chunk)
        if chunk[-1] in ".," and chunk[-2:-1].isalpha():
            ids = self._chunk(chunk[:-1]) + self._chunk(chunk[-1])
        elif chunk[0] == "\n" and chunk[1:2] not in ("", " ", "\n", "\t", "\r"):
            ids = self._chunk("\n") + self._chunk(chunk[1:])
        else:
            ids = self._piece(chunk)
        if len(self._table) >= self._table_size:
            self._table.clear()
        self._table[chunk] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _RARE_SPACE.search(text):
            return self._ids(text)
        chunks = text.split() if self.drops_space else _CHUNK.findall(text)
        known, learn = self._table.get, self._learn
        return b"".join([known(c) or learn(c) for c in chunks])


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    """One encoder per worker process and vocabulary."""
    return ChunkEncoder(path)


@lru_cache(maxsize=2)
def vocabulary_size(path: str) -> int:
    """One more than the largest id."""
    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values()) + 1

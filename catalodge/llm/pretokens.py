"""Exact token values of white-space-delimited pre-tokens, cached in the Python worker.

The tokenizer drops white space and never joins characters across it, so a text's ids
are the ids of its pre-tokens one after the other. Each worker keeps a bounded table of
the pre-tokens it has met; only misses reach the library.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer  # noqa: E402

# Letters that the tokenizer's normaliser maps just as str.lower does, and signs that it never joins with letters.
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'")


def _byte_signs() -> list[str]:
    """The sign that byte-level vocabularies have for each byte: visible Latin-1 signs stand for themselves."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


BYTE_SIGNS = _byte_signs()


class PreTokenCache:
    """pre-token (bytes) -> `value` of its ids; `join` adds the values of a word and the signs behind it.

    `frequent` is a first tier that is never dropped; the second tier is emptied when it
    holds `capacity` entries. Neither changes a result.
    """

    def __init__(self, path: str, value: Callable, join: Callable, frequent: dict | None = None, capacity: int = 300_000):
        self.library = Tokenizer.from_file(path)
        self.merges = self.library.model.tokenize
        self.value, self.join, self.capacity = value, join, capacity
        self.frequent = frequent or {}
        self.table = dict(self.frequent)
        self.words: dict = {}
        self.signs: dict = {}

    def load(self, unseen: Iterable[bytes]) -> None:
        """Add pre-tokens that the table lacks."""
        words, signs, table = self.words, self.signs, self.table
        for chunk in unseen:
            stem = chunk.rstrip(SIGNS)
            if stem.isalpha():  # ASCII letters
                word = stem.lower()
            elif LETTERS.fullmatch(text := stem.decode("utf-8", "replace")):
                word = text.lower().encode()
            else:
                text = chunk.decode("utf-8", "replace")
                table[chunk] = self.value(self.library.encode(text, add_special_tokens=False).ids)
                continue
            sign = chunk[len(stem) :]
            found = words.get(word)
            if found is None:
                found = words[word] = self.value(self._encode(word))
            if sign:
                if sign not in signs:
                    signs[sign] = self.value(self.library.encode(sign.decode(), add_special_tokens=False).ids)
                found = self.join(found, signs[sign])
            table[chunk] = found

    def _encode(self, word: bytes) -> list:
        """The ids of a word of letters only: one pre-token, so the library's merges alone decide."""
        signs = word.decode() if word.isascii() else "".join(map(BYTE_SIGNS.__getitem__, word))
        return [token.id for token in self.merges(signs)]

    def split(self, texts: list[bytes]) -> list[list[bytes]]:
        """Pre-tokens of each text, all of them in the table afterwards."""
        chunks = [text.split() for text in texts]
        unseen = set().union(*chunks).difference(self.table)
        if unseen:
            if len(self.table) + len(unseen) > self.capacity + len(self.frequent):
                self.table = dict(self.frequent)
                unseen = set().union(*chunks).difference(self.table)
            if len(self.words) > self.capacity:
                self.words, self.signs = {}, {}
            self.load(unseen)
        return chunks

"""Token ids of texts, by a public tokenizer, in Python workers."""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterator
from contextlib import contextmanager

from crosswind.llm.common import give_back

# Words whose ids a worker keeps at a time.
KEPT = 1 << 19
# Marks that end a word and that the tokenizer splits off.
MARKS = ".,;:!?"
# Characters that lower case or composition may change in ways of their own.
AFAR = re.compile("[^\x00-\xff]|[ªµº]")
# Bytes that a byte-level vocabulary writes as the character of the same number.
PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]


def default_tokenizer() -> str:
    """Place of the public vocabulary that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> dict[int, str]:
    """Characters for all bytes; those without their own follow from 256 on."""
    plain = set(PLAIN_BYTES)
    others = (byte for byte in range(256) if byte not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordIds(dict):
    """Ids of a word, as little-endian unsigned 32-bit numbers, kept for its next use.

    The tokenizer drops white space and never joins what stands on both sides
    of it, so the ids of a text are those of its words, in order. A word of
    plain Latin letters goes straight to the merges, as nothing but lower case
    stands before them; every other word takes the whole way.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise RuntimeError("ids are kept as little-endian 32-bit numbers")

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def merged(self, text: str) -> bytes:
        """Ids of a word of plain Latin letters in lower case."""
        letters = text if text.isascii() else text.encode().decode("latin-1").translate(self.letters)
        return array("I", [token.id for token in self.model.tokenize(letters)]).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        stem = text.rstrip(MARKS)
        tail = text[len(stem) :]
        if not stem.isalpha():
            ids = self.whole(text)
        elif not (stem.isascii() or not AFAR.search(stem)):
            ids = self[stem.encode()] + self[tail.encode()] if tail else self.whole(text)
        elif tail or stem != stem.lower():
            # The word itself is kept once, in lower case and without marks.
            ids = self[stem.lower().encode()] + (self[tail.encode()] if tail else b"")
        else:
            ids = self.merged(text)
        if len(self) >= KEPT:
            self.clear()
        if len(word) <= 64:
            self[word] = ids
        return ids

    def ids(self, text: bytes, end: int | None = None) -> bytes:
        tail = b"" if end is None else end.to_bytes(4, "little")
        return b"".join(map(self.__getitem__, text.split())) + tail


_loaded: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's own instance for a vocabulary file."""
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


@contextmanager
def task_ids(path: str) -> Iterator[WordIds]:
    """``word_ids`` for one task: what it kept goes when the task ends, so an idle worker holds none of it."""
    words = word_ids(path)
    try:
        yield words
    finally:
        words.clear()
        give_back()

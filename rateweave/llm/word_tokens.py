"""Ids of a word-level BPE (lower case, white space dropped) inside tasks.

Such a vocabulary never joins what white space parts, so the ids of a text are those of its
words in a row.  Ids of words met before are kept in a table of bounded size in the Python
worker; a new word of Latin letters goes to the tokenizer's model, its marks on either side
apart.  All other words go to the tokenizer, and texts that hold the string of an added token,
or one of the separators that Python alone takes for white space, go to it whole.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Sequence

from rateweave.llm.tokens import _LETTERS, _MARKS, KEPT_CHARS, KEPT_MOST, _latin

_SEPARATORS = re.compile("[\x1c-\x1f]")


def _letters(word: str) -> bool:
    """Latin letters only, which stay letters in lower case (U+0130 gets a mark)."""
    return _latin(word) and "\u0130" not in word


class WordEncoder(dict):
    """Ids of words, computed when first asked for."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def fresh(self, word: str) -> bytes:
        if _letters(word):
            low = word.lower()
            low = low if low.isascii() else low.encode().decode("latin-1").translate(_LETTERS)
            return array("I", [t.id for t in self.model.tokenize(low)]).tobytes()
        core = word.rstrip(_MARKS)
        if core != word and core and _letters(core):
            return self[core] + self[word[len(core):]]
        core = word.lstrip(_MARKS)
        if core != word and core and _letters(core):
            return self[word[: -len(core)]] + self[core]
        return self.whole(word)

    def __missing__(self, word: str) -> bytes:
        ids = self.fresh(word)
        if len(word) <= KEPT_CHARS:
            if len(self) >= KEPT_MOST:
                self.clear()
            self[word] = ids
        return ids

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        get = self.__getitem__
        return [self.whole(text) if any(mark in text for mark in self.added) or _SEPARATORS.search(text)
                else b"".join(map(get, text.split())) for text in texts]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]

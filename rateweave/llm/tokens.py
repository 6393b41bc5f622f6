"""Token ids of whole texts inside tasks.

A byte-level BPE splits a text before merging, at spaces for one, and never joins what
stands on two sides of a word's leading space.  So a text without a space next to other
white space is the join of its space-led pieces, and the ids of pieces met before are kept
in a table of bounded size in the Python worker.  A new piece that is a word of Latin
letters goes to the tokenizer's model as it is; around it, marks and line breaks are split
off as the tokenizer would.  All else, and other texts, go to the tokenizer whole; so does
a text that holds the string of an added token (a mark of the vocabulary), which the
tokenizer takes out before it splits.
"""

from __future__ import annotations

import os
import re
import string
from array import array
from collections.abc import Sequence

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Pieces kept in a worker, and the longest piece that is kept.
KEPT_MOST = 850_000
KEPT_CHARS = 40

_WHOLE = re.compile(r" \s| \Z")
_MARKS = string.punctuation.replace("'", "")


def _byte_letters() -> dict[int, str]:
    """How a byte-level vocabulary writes bytes: printable ones as themselves, others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + k) for k, b in enumerate(hidden)}


_LETTERS = _byte_letters()
_SPACE = _LETTERS[32]


def _latin(s: str) -> bool:
    return s.isalpha() and (s.isascii() or max(s) < "ɐ")


class _Kept(dict):
    """Ids of pieces, computed when first asked for."""

    def __init__(self, owner: Encoder, lead: str):
        self.owner, self.lead = owner, lead

    def __missing__(self, piece: str) -> bytes:
        ids = self.owner.fresh(piece, self.lead)
        if len(piece) <= KEPT_CHARS:
            if len(self) >= KEPT_MOST:
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.spaced, self.bare, self.line = (_Kept(self, lead) for lead in (" ", "", "\n"))

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def fresh(self, s: str, lead: str) -> bytes:
        """Ids of ``lead`` + s, where s has no space."""
        if lead == "\n":
            return self.whole("\n") + self.bare[s]
        if _latin(s):
            word = s if s.isascii() else s.encode().decode("latin-1").translate(_LETTERS)
            return array("I", [t.id for t in self.model.tokenize(_SPACE + word if lead else word)]).tobytes()
        same = self.spaced if lead else self.bare
        core = s.rstrip(_MARKS)
        if core != s and core and _latin(core):
            return same[core] + self.bare[s[len(core):]]
        core = s.lstrip(_MARKS)
        if core != s and core and _latin(core):
            return same[s[: -len(core)]] + self.bare[core]
        lines = s.split("\n")
        if len(lines) > 1 and all(lines) and not any(x[0].isspace() or x[-1].isspace() for x in lines):
            return same[lines[0]] + b"".join([self.line[x] for x in lines[1:]])
        return self.whole(lead + s)

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out, spaced, bare = [], self.spaced.__getitem__, self.bare.__getitem__
        for text in texts:
            if _WHOLE.search(text) or not text or any(mark in text for mark in self.added):
                out.append(self.whole(text))
            else:
                pieces = text.split(" ")
                first = pieces.pop(0)
                out.append((bare(first) if first else b"") + b"".join(map(spaced, pieces)))
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def forget() -> None:
    """Drop all encoders and what they keep."""
    _ENCODERS.clear()


def groups(texts: Sequence[str | None], chars: int = 1 << 20) -> list[tuple[int, int]]:
    """Row ranges of about ``chars`` characters, so that the ids in hand stay few."""
    out, start, size = [], 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= chars:
            out.append((start, i + 1))
            start, size = i + 1, 0
    if start < len(texts):
        out.append((start, len(texts)))
    return out

"""Splitting text into the pieces that byte-pair merges never cross.

``FAST`` is the split pattern of the rank files for texts whose characters all lie below U+0250,
with the Unicode classes spelled out; on those the tests compare every code point with the
libraries. Other texts take the library's (or the ``regex`` module's) own classes.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import regex

#: Characters that FAST and the word pattern may not see.
BEYOND_FAST = re.compile("[^\x00-ɏ]")
_LIMIT = 0x250


def _ranges(first: str) -> str:
    inside = [c for c in range(_LIMIT) if unicodedata.category(chr(c)).startswith(first)]
    out, start = [], None
    for i, c in enumerate(inside):
        start = c if start is None else start
        if i + 1 == len(inside) or inside[i + 1] != c + 1:
            out.append(f"{re.escape(chr(start))}-{re.escape(chr(c))}")
            start = None
    return "".join(out)


LETTER, NUMBER = _ranges("L"), _ranges("N")
#: White space below U+0250.
SPACE = "\t-\r \x85\xa0"
#: White space everywhere, as the libraries' regex engine has it.
ANY_SPACE = SPACE + "  -     　"

FAST = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
FAST_WORDS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^{SPACE}{LETTER}{NUMBER}]+")


@lru_cache(maxsize=4)
def whole_pattern(pattern: str) -> regex.Pattern:
    """The pattern over all of Unicode, with white space as the libraries class it."""
    return regex.compile(pattern.replace(r"[^\s", f"[^{ANY_SPACE}").replace(r"\S", f"[^{ANY_SPACE}]")
                         .replace(r"\s", f"[{ANY_SPACE}]"))


@lru_cache(maxsize=1)
def byte_letters() -> list[str]:
    """The printable character by which byte-level vocabularies write each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


@lru_cache(maxsize=1)
def _byte_table() -> dict[int, str]:
    return dict(enumerate(byte_letters()))


def byte_level(piece: str) -> str:
    if piece.isascii() and piece.isprintable() and " " not in piece:
        return piece  # these bytes are written as themselves
    return piece.encode("utf-8").decode("latin-1").translate(_byte_table())


def added_tokens(path: str) -> tuple[re.Pattern | None, dict[str, int]]:
    """Pattern and ids of the special strings that the library takes out of a text before anything
    else. Only plain ones are supported: no stripping, no word boundary, matched on the raw text."""
    with open(path, encoding="utf-8") as f:
        entries = json.load(f)["added_tokens"]
    for e in entries:
        if e["single_word"] or e["lstrip"] or e["rstrip"] or e["normalized"]:
            raise ValueError(f"added token {e['content']!r} isn't plain")
    ids = {e["content"]: e["id"] for e in entries}
    longest = sorted(ids, key=len, reverse=True)
    return (re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None), ids


class ByteMemo(dict):
    """A memo of strings whose two generations hold about ``limit`` bytes each, whatever their lengths."""

    #: Bytes of a key, a value and their place in the dict, besides what they spell.
    OVERHEAD = 200

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit, self.old, self.held = compute, limit, {}, 0

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        self.held += self.OVERHEAD + len(key) + (len(value) if isinstance(value, bytes) else 0)
        if self.held > self.limit:
            self.old, self.held = dict(self), 0
            self.clear()
        self[key] = value
        return value


#: White space directly before a space: then a space isn't always the start of a match of FAST.
SPACE_RUN = re.compile(f"[{SPACE}] ")

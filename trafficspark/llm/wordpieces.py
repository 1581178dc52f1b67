"""Pieces of a text as the word BPE tokenizer sees them, with caches of what each encodes to.

The tokenizer normalises (NFC, white space, lower case), splits into pieces and encodes each piece on its own. No
piece holds white space, and neither normal form nor case reaches across it, so a text's ids are those of its runs
of other characters in a row. Runs of plain characters are split here by a pattern, any other run by the library.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# The splitting pattern of the tokenizer file, over the characters that PLAIN admits.
LETTERS = "a-zß-öø-ÿĀ-įĲ-ž"
PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\s0-9{LETTERS}]+")
SPLIT = re.compile(PIECE.pattern + "|\n")
PLAIN = re.compile("[\n\x21-\x7eÀ-ÖØ-öø-ÿĀ-įĲ-ž–—‘-”…€]*")
#: White space for str.split, but not for the library.
ODD = "\x1c\x1d\x1e\x1f"

_loaded: dict[str, object] = {}


def load(path: str):
    """The tokenizer of a file, read once in each Python worker."""
    if path not in _loaded:
        from tokenizers import Tokenizer

        _loaded[path] = Tokenizer.from_file(path)
    return _loaded[path]


def is_plain(run: str) -> bool:
    """Whether PIECE over the lower-cased run (or runs in lines) gives the library's pieces."""
    return PLAIN.fullmatch(run) is not None and "<|" not in run


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE: itself, or the next free one from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


SYMBOL = byte_symbols()


def symbols(piece: str) -> str:
    """The piece as byte-level BPE reads it: one symbol for each byte."""
    return piece if piece.isascii() else "".join([SYMBOL[b] for b in piece.encode()])


def runs(text: str) -> list[str]:
    """The text's runs between white space; a text with characters that only str.split takes for white space is one run."""
    return [text] if any(c in text for c in ODD) else text.split()


class Cache:
    """Remembers a value for each distinct string; starts anew when it holds `limit` strings or `room` characters, so memory is bounded."""

    def __init__(self, make: Callable[[list[str]], list], limit: int = 700_000, room: int = 30_000_000):
        self.make, self.limit, self.room, self.known, self.held = make, limit, room, {}, 0

    def of(self, strings: list[str]) -> list:
        try:
            return list(map(self.known.__getitem__, strings))
        except KeyError:
            pass
        if len(self.known) > self.limit or self.held > self.room:
            self.known, self.held = {}, 0
        new = list(set(strings).difference(self.known))
        self.known.update(zip(new, self.make(new), strict=True))
        self.held += sum(map(len, new))
        return list(map(self.known.__getitem__, strings))


def pieces_of_runs(new: list[str]) -> tuple[list[str], list[str]]:
    """From distinct runs: the pieces of the plain ones in a row, each run closed by a line feed, and the other runs, in order."""
    lines = "\n".join([*new, ""])
    if is_plain(lines):
        return SPLIT.findall(lines.lower()), []
    plain = [r for r in new if is_plain(r)]
    return SPLIT.findall("\n".join([*plain, ""]).lower()) if plain else [], [r for r in new if not is_plain(r)]

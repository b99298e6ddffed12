"""Cutting texts into chunks whose tokens don't depend on their neighbours.

The byte-level pattern ``'s|..| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`` never matches
across the place before a single space that stands between two other characters: no match goes on
over that space, and the match that begins there takes the space with what follows. So a text may
be cut at such spaces and each chunk tokenised, and remembered, alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import Any

TOUCHING = re.compile(r" \s|\s ")
CUT = re.compile(r"(?<=\S) (?=\S)")
#: A word of Latin letters, whose class is the same in all Unicode tables, and perhaps one mark.
PLAIN = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ɏ]+)([.,;:!?]?)").fullmatch


class Remembered(dict):
    """Results of ``make`` by key: the last ``most`` new ones, and as many of those before them."""

    def __init__(self, make: Callable[[Any], Any], most: int = 150_000, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest = make, most, longest
        self.before: dict = {}

    def __missing__(self, key: Any) -> Any:
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.before = dict(self)
                self.clear()
            self[key] = value
        return value


_made: dict = {}


def once(key: tuple, make: Callable[[], Any]) -> Any:
    """``make()`` once in a Python worker, which runs many tasks: what it remembers stays warm."""
    if key not in _made:
        _made.clear()
        _made[key] = make()
    return _made[key]


def chunks(text: str) -> list[str]:
    """The chunks of a text without the spaces between them; the first may be empty."""
    return CUT.split(text) if TOUCHING.search(text) else text.split(" ")


class ByChunk:
    """``make`` of each chunk of a text; ``make`` gets the chunk with the space before it."""

    def __init__(self, make: Callable[[str], Any]):
        self.make = make
        self.after_space = Remembered(lambda chunk: make(" " + chunk))

    def __call__(self, text: str) -> list:
        first, *rest = chunks(text)
        return [*([self.make(first)] if first else []), *map(self.after_space.__getitem__, rest)]

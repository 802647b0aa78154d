"""Cutting text at white space into chunks on which the byte-level pattern works independently."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import regex

#: Unicode White_Space, as the tokenizer libraries read \s (Python's own \s also takes U+001C to U+001F).
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

#: A chunk is a run without white space and the one space before it; the rest of each white-space run stands alone.
#: No alternative of the byte-level pattern crosses these cuts.
CHUNK = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def chunks(text: str) -> list[str]:
    return CHUNK.findall(text)


def pretoken_pattern(pattern: str) -> regex.Pattern:
    """The given pattern with its \\s and \\S spelled out as White_Space."""
    inside = pattern.replace("[^\\s", f"[^{SPACE}")
    return regex.compile(inside.replace("\\S", f"[^{SPACE}]").replace("\\s", f"[{SPACE}]"))


class Cache(dict):
    """A worker's cache of ``make(key)`` in two generations: when the young one is full it becomes the old one, whose
    entries come back as they are used. Holds at most twice ``entries``; keys longer than ``longest`` are not kept."""

    def __init__(self, make: Callable[[str], object], entries: int = 450_000, longest: int = 64) -> None:
        self.make, self.entries, self.longest, self.old = make, entries, longest, {}

    def __missing__(self, key: str) -> object:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.keep(key, value)
        return value

    def keep(self, key: str, value: object) -> None:
        if len(key) <= self.longest:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[key] = value

    def unknown(self, keys: Iterable[str]) -> list[str]:
        return [k for k in set(keys) if k not in self and k not in self.old]

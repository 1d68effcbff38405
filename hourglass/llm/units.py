"""Splitting of a text into units that a byte-level BPE tokenizer treats
independently, and bounded memos for what a unit gives.

The split pattern of such tokenizers never joins white space to a character
before it, and has no look-behind.  So wherever a space follows a character
that is not white space, one piece ends and a fresh one begins, whatever
stands on either side.  Cutting there and working on each unit alone gives
exactly the pieces of the whole text.
"""

from __future__ import annotations

from collections.abc import Callable

MEMO_ENTRIES = 150_000
MEMO_KEY = 64


class _Open(Exception):
    """A unit that ends in white space: its last piece may go on."""


class Memo(dict):
    """unit -> result of ``fn(prefix + unit)``.  When full it becomes the older
    half, from which what is asked for again comes back: frequent units stay.
    Long units are not kept."""

    def __init__(self, fn: Callable[[str], object], prefix: str):
        self.fn, self.prefix, self.older = fn, prefix, {}

    def __missing__(self, unit: str):
        if (found := self.older.get(unit)) is not None:
            self._keep(unit, found)
            return found
        if not unit or unit[-1].isspace():
            raise _Open
        return self.of(unit)

    def of(self, unit: str):
        found = self.fn(self.prefix + unit)
        if len(unit) <= MEMO_KEY and unit and not unit[-1].isspace():
            self._keep(unit, found)
        return found

    def _keep(self, unit: str, found) -> None:
        if len(self) >= MEMO_ENTRIES:
            self.older = self.copy()
            self.clear()
        self[unit] = found


class Units:
    """``fn`` of every unit of a text, in order."""

    def __init__(self, fn: Callable[[str], object]):
        self.first, self.rest = Memo(fn, ""), Memo(fn, " ")

    def __call__(self, text: str) -> list:
        parts = text.split(" ")
        try:
            return [self.first[parts[0]], *map(self.rest.__getitem__, parts[1:])]
        except _Open:
            parts = _closed(parts)
            return [self.first.of(parts[0]), *(self.rest.get(p) or self.rest.of(p) for p in parts[1:])]


def _closed(parts: list[str]) -> list[str]:
    """Parts that end in white space, or are empty, joined to the next one."""
    out, held = [], None
    for part in parts:
        if held is not None:
            part = f"{held} {part}"
        held = part if not part or part[-1].isspace() else None
        if held is None:
            out.append(part)
    return out if held is None else [*out, held]

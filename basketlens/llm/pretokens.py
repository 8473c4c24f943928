"""Cutting texts into chunks at single spaces, so that work on a chunk is done
once per distinct chunk instead of once per occurrence.

A byte-level BPE pattern never lets a match run across the start of a space,
except inside a run of white space. So a text is the row of its chunks, each a
space with what follows up to the next space, unless a chunk other than the
last ends in white space; such texts are matched whole.
"""

from __future__ import annotations

import regex

ENDS_IN_SPACE = regex.compile(r"\s\Z")

# entries of each generation of a worker's memo, and the longest key kept
MEMO_ENTRIES = 200_000
MEMO_KEY = 64


class Memo(dict):
    """key -> ``work(key)`` in two generations of ``entries`` at most: when the
    young one is full it becomes the old one, so keys in use stay and the others
    are forgotten, and computed again if they come back."""

    def __init__(self, work, entries: int | None = None):
        super().__init__()
        self.work, self.old, self.entries = work, {}, entries or MEMO_ENTRIES

    def __missing__(self, key):
        value = self.old[key] if key in self.old else self.work(key)
        if len(key) <= MEMO_KEY:
            self.keep(key, value)
        return value

    def keep(self, key, value):
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        self[key] = value

    def unknown(self, keys: set) -> list:
        """The keys in neither generation."""
        return list(keys.difference(self).difference(self.old))


def ends_in_space(chunk: str) -> bool:
    return not chunk or ENDS_IN_SPACE.search(chunk) is not None


def by_chunk(text: str, memo: dict, work) -> list | None:
    """The values of the chunks of ``text`` in order, or None if the text must be
    worked on whole. ``work`` maps a string that needs no leading space."""
    chunks = text.split(" ")
    if len(chunks) < 3:
        return None
    first, last = chunks[0], chunks[-1]
    if first and ENDS_IN_SPACE.search(first):
        return None
    values = list(map(memo.__getitem__, chunks[1:-1]))
    if None in values:
        return None
    if first:
        values.insert(0, work(first))
    values.append(work(" " + last))
    return values


def rows_of(batch, step: int = 256):
    """Python rows of an Arrow batch, ``step`` at a time: long texts become
    Python strings only in small numbers."""
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        yield [part.column(i).to_pylist() for i in range(part.num_columns)]

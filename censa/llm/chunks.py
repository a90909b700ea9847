"""Values of the white-space chunks of texts, worked out once per distinct chunk in a worker.

Words repeat far more often than they are new, so whatever depends on one chunk alone
(its token ids, its hash) is looked up, and texts become integer arrays by one gather.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from itertools import chain, repeat
from typing import ClassVar

import numpy as np
import regex

#: ``str.split`` also splits at these, Unicode white space does not hold them.
NOT_SPACE = re.compile("[\x1c-\x1f]")
SPACE = regex.compile(r"\p{White_Space}+")


def split(text: str) -> list[str]:
    """Chunks between Unicode white space."""
    if NOT_SPACE.search(text):
        return [c for c in SPACE.split(text) if c]
    return text.split()


class _Numbers(dict):
    """A number for each string met."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, string: str) -> int:
        number = self[string] = len(self)
        self.new.append(string)
        return number


class _Memory:
    """The values of numbered strings, one after the other."""

    def __init__(self, dtype) -> None:
        self.numbers = _Numbers()
        self.chars = self.used = 0
        self.pool = np.empty(1 << 16, dtype)
        self.starts = np.empty(1 << 14, np.int64)
        self.sizes = np.empty(1 << 14, np.int64)

    def values(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the wanted numbers, and where each begins (one more at the end)."""
        sizes = self.sizes[wanted]
        stops = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        moved = np.repeat(self.starts[wanted] - stops[:-1], sizes)
        moved += np.arange(len(moved))
        return self.pool[moved], stops

    def add(self, numbers: np.ndarray, values: np.ndarray, sizes: np.ndarray) -> None:
        self.pool = _room(self.pool, self.used + len(values))
        self.starts, self.sizes = _room(self.starts, len(self.numbers)), _room(self.sizes, len(self.numbers))
        self.pool[self.used : self.used + len(values)] = values
        self.sizes[numbers] = sizes
        self.starts[numbers] = self.used + np.cumsum(sizes) - sizes
        self.used += len(values)


Encode = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


def flat(rows: Sequence[Sequence[int]], dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values one after the other, and how many each row has."""
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    return np.fromiter(chain.from_iterable(rows), dtype, int(sizes.sum())), sizes


class Memory:
    """Values of strings, by ``encode`` where they are new; ``limit`` bounds the characters kept in either half.

    When the young half is full it becomes the old one, whose strings move up again when they
    are met, so strings that are met often are never forgotten and the memory does not grow with
    the data.
    """

    def __init__(self, encode: Encode, dtype, limit: int) -> None:
        self.encode, self.dtype, self.limit = encode, dtype, limit
        self.clear()

    def clear(self) -> None:
        self.young, self.old = _Memory(self.dtype), _Memory(self.dtype)

    def renew(self) -> None:
        """Between two batches: numbers given before are void after a change of halves."""
        if self.young.chars > self.limit:
            self.young, self.old = _Memory(self.dtype), self.young

    def learn(self) -> None:
        """Find the values of all strings that got a number since the last time."""
        young, old = self.young, self.old
        new = young.numbers.new
        if not new:
            return
        first = len(young.numbers) - len(new)
        before = np.fromiter(map(old.numbers.get, new, repeat(-1)), np.int64, len(new))
        held = np.flatnonzero(before >= 0)
        if len(held):
            values, stops = old.values(before[held])
            young.add(first + held, values, np.diff(stops))
        rest = np.flatnonzero(before < 0)
        if len(rest):
            young.add(first + rest, *self.encode([new[k] for k in rest.tolist()]))
        young.chars += sum(map(len, new))
        young.numbers.new = []


class ChunkTable:
    """Texts as the values of their chunks.  A worker process serves one operator after another, so only the table in use is kept."""

    in_use: ClassVar[ChunkTable | None] = None

    def __init__(self, encode: Encode, dtype, limit: int = 1_250_000, cut: Callable[[str], list[str]] = split) -> None:
        self.encode, self.cut, self.memory = encode, cut, Memory(encode, dtype, limit)

    def _clear(self) -> None:
        self.memory.clear()
        if hasattr(self.encode, "forget"):
            self.encode.forget()

    def rows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The values of all texts one after the other, and where each text starts (one more at the end)."""
        if ChunkTable.in_use is not self:
            if ChunkTable.in_use is not None:
                ChunkTable.in_use._clear()
            ChunkTable.in_use = self
        self.memory.renew()
        found: list[int] = []
        ends = np.zeros(len(texts) + 1, np.int64)
        number, cut = self.memory.young.numbers.__getitem__, self.cut
        for at, text in enumerate(texts):
            found.extend(map(number, cut(text)))
            ends[at + 1] = len(found)
        self.memory.learn()
        values, stops = self.memory.young.values(np.array(found, np.int64))
        return values, stops[ends]


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    grown = np.empty(max(size, 2 * len(array)), array.dtype)
    grown[: len(array)] = array
    return grown

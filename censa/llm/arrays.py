"""Texts as flat arrays: the bytes or code points of many texts one after the other."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def blocks(batches: Iterator[pa.RecordBatch], size: int, column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut to at most ``size`` bytes of text (a longer text stands alone), with the
    UTF-8 bytes of their texts (null: none) and the places where each starts and the last ends."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = pc.fill_null(batch.column(column), "")
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        start = 0
        while start < len(texts):
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1)
            yield batch.slice(start, stop - start), data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
            start = stop


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of true places that do not cross a text's border: their starts, ends and texts."""
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(mask))]
    before, after = np.zeros(len(mask), bool), np.zeros(len(mask), bool)
    before[1:], after[:-1] = mask[:-1], mask[1:]
    before[inner] = False
    after[inner - 1] = False
    starts, ends = np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def sums(values: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
    """Exact sums of whole numbers (or rows of them) by a sorted owner; 0 for owners without any."""
    out = np.zeros((size, *values.shape[1:]), values.dtype)
    if len(owner):
        first = np.flatnonzero(np.diff(owner, prepend=owner[0] - 1))
        out[owner[first]] = np.add.reduceat(values, first, axis=0)
    return out


class Pool:
    """The bytes of each of many tokens, to be joined by a gather."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.pool = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids one after the other, and where each begins (one more at the end)."""
        sizes = self.sizes[ids]
        stops = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        return self.pool[np.repeat(self.starts[ids] - stops[:-1], sizes) + np.arange(stops[-1])], stops

"""Best-fit packing of token sequences: greedy filling, then best two-fit replacement.

A document is its token ids and an end id.  One longer than the capacity is cut into
full pieces and a rest; nothing else is cut.  The packing itself only depends on how many
pieces of each length there are, at most ``capacity`` numbers.  From them the driver
makes bin *patterns* with multiplicities: the longest pieces that fit fill a bin; then the
bin's smallest piece gives way to two unpacked pieces that fill the widened gap more
tightly, as long as such a pair exists.  A pattern is repeated while its lengths last, so
the plan is that of filling bin after bin, and its size does not grow with the documents.
Every piece finds its place by the number it has among the pieces of its length.

Nulls count as empty texts (one end id).  Equal documents and repeated rows are packed
one by one.  An empty table gives no rows.
Texts of any length are read whole; further columns play no part, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from censa.llm.shared import kept, steps
from censa.llm.tokens import encoder

CAPACITY = 4096
END_ID = 1

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, number long"


def pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """One row per piece, with its number among the pieces of its length in its task; ``ids``: also the ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = encoder(tokenizer)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch, texts in steps(batches):
            values, bounds = codes.rows(texts)
            out: dict[str, list] = {n: [] for n in ("doc_id", "piece", "start", "length", "ids_crc32", "part", "number")}
            parts = []
            for doc, lo, hi in zip(batch.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                own = np.append(values[lo:hi], np.uint32(end_id)).astype("<u4")
                for number, start in enumerate(range(0, len(own), capacity)):
                    piece = own[start : start + capacity].tobytes()
                    length = len(piece) // 4
                    row = (doc, number, start, length, zlib.crc32(piece), part, int(seen[length]))
                    seen[length] += 1
                    for column, value in zip(out.values(), row, strict=True):
                        column.append(value)
                    parts.append(piece)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            arrays = [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(parts, pa.binary())] * ids, [*out, *["ids"] * ids])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, PIECES + ", ids binary" * ids)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Slots by length: pieces ``low`` to ``high`` of a length go, ``uses`` to a bin, into bins from ``bin`` on at ``offset``."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    taken = np.zeros(capacity + 1, np.int64)
    slots: list[tuple[int, int, int, int, int, int]] = []
    first_bin = 0
    every = np.arange(capacity + 1)
    while left.any():
        free = left.copy()
        longest = np.maximum.accumulate(np.where(free > 0, every, 0))
        items: list[int] = []
        gap = capacity
        while gap and (length := int(longest[gap])):
            items.append(length)
            gap -= length
            free[length] -= 1
            if not free[length]:
                longest = np.maximum.accumulate(np.where(free > 0, every, 0))
        while gap:
            smallest = min(items)
            pair = _best_pair(free, gap + smallest, every)
            if sum(pair) <= smallest:
                break
            items.remove(smallest)
            free[smallest] += 1
            for length in pair:
                items.append(length)
                free[length] -= 1
            gap += smallest - sum(pair)
        lengths, uses = np.unique(np.array(items), return_counts=True)
        times = int((left[lengths] // uses).min())
        offset = 0
        for length, use in zip(lengths[::-1].tolist(), uses[::-1].tolist(), strict=True):
            low = int(taken[length])
            slots.append((length, low, low + times * use, use, first_bin, offset))
            taken[length] += times * use
            offset += length * use
        left[lengths] -= times * uses
        first_bin += times
    table = np.array(sorted(slots), np.int64).reshape(-1, 6)
    return dict(zip(("length", "low", "high", "uses", "bin", "offset"), table.T, strict=True))


def _best_pair(free: np.ndarray, room: int, every: np.ndarray) -> tuple[int, int]:
    """The two unpacked lengths with the largest sum within ``room`` (0, 0 if there are none)."""
    top = min(room, len(free) - 1)
    upper = np.flatnonzero(free[: top + 1] > 0)
    if not len(upper):
        return 0, 0
    below = np.maximum.accumulate(np.where(free > 0, every, 0))
    smaller = np.maximum.accumulate(np.concatenate([[0], np.where(free > 0, every, 0)[:-1]]))
    rest = np.minimum(room - upper, upper)
    lower = np.where((rest == upper) & (free[upper] < 2), smaller[upper], below[rest])
    lower = np.where(lower > 0, lower, 0)
    sums = np.where(lower > 0, upper + lower, 0)
    best = int(sums.argmax())
    return (int(upper[best]), int(lower[best])) if sums[best] else (0, 0)


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id`` and ``offset`` of kept pieces (see :func:`pieces`)."""
    spark = cut.sparkSession
    counts = kept(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "packing-counts")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # At most ``capacity`` rows, whatever the input.
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(plan(totals, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = slots.value
        keys = table["length"] << 40 | table["low"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy() + batch.column("base").to_numpy()
            slot = np.searchsorted(keys, length << 40 | number, side="right") - 1
            turn, use = np.divmod(number - table["low"][slot], table["uses"][slot])
            names = [n for n in batch.schema.names if n not in ("part", "number", "base")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(table["bin"][slot] + turn), pa.array(table["offset"][slot] + use * length)],
                [*names, "sequence_id", "offset"],
            )

    held = [f for f in cut.schema.fields if f.name not in ("part", "number")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held) + ", sequence_id long, offset long"
    # One base for each task and length grows with the input, so it is never broadcast.
    return cut.join(bases.hint("merge"), ["part", "length"]).select(*cut.columns, "base").mapInArrow(place, schema)


def packed(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """The place of every piece of every document."""
    return pack(kept(pieces(documents, tokenizer, capacity, end_id, ids), "packing-pieces"), capacity)


def sequences(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The packed sequences: ``sequence_id``, ids (little-endian 32-bit), documents and their offsets in order."""
    placed = packed(documents, tokenizer, capacity, end_id, ids=True)
    inside = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return placed.groupBy("sequence_id").agg(inside.alias("_in")).select(
        "sequence_id",
        F.aggregate("_in.ids", F.unhex(F.lit("")), lambda a, b: F.concat(a, b)).alias("ids"),
        F.col("_in.doc_id").alias("doc_ids"),
        F.col("_in.offset").alias("offsets"),
    )

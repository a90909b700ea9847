"""Windows: runs of bytes by which any number of patterns are looked for in texts.

A pattern is covered by windows of one width, the largest power of two within it and
WIDEST; the last one ends with the pattern.  A text holds a pattern only if it holds all
its windows.  Windows go by a 64-bit hash, so what they find is to be compared in full.
The task functions are local, so executors need numpy and pyarrow but not this package.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of the widest window.
WIDEST = 32
#: Cells of the sieve (a Bloom filter) for each window and those it sets: some five windows in a million that no
#: pattern has pass.  The number of cells is a power of two, at most 2^27 (16 MB).
CELLS, SET, LEAST_BITS, MOST_BITS = 32, 8, 15, 27
#: Cells in a block, as ``bitmap_construct_agg`` makes them.
BLOCK = 1 << 15
#: Bytes hashed at once.
STEP = 1 << 16


def _reader() -> tuple[Callable, Callable]:
    """Functions of a task: borders and bytes of a binary column; hashes of all its windows."""
    import numpy as np

    factors = {2 << k: np.uint64(pow(0x9E3779B97F4A7C15, 1 << k, 1 << 64)) for k in range(WIDEST.bit_length() - 1)}
    widest, step = WIDEST, STEP

    def read(column):
        import pyarrow as pa

        kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
        _, borders, data = column.buffers()
        borders = np.frombuffer(borders, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        return borders, np.frombuffer(data if data is not None else b"", np.uint8)

    def hashes(borders, data, widths):
        """``start``, ``width`` and the hashes of the windows that begin in the step from ``start``."""
        for start in range(borders[0], borders[-1], step):
            found = data[start : min(start + step + widest - 1, borders[-1])].astype(np.uint64)
            found += np.uint64(1)
            for width in [1, *factors]:
                if width > 1:
                    half = width // 2
                    found = found[:-half] * factors[width] + found[half:]
                if width in widths:
                    yield start, width, (found[:step] + np.uint64(width)) * np.uint64(0xD6E8FEB86659FD93)

    return read, hashes


def filed(patterns: DataFrame, name: str) -> DataFrame:
    """``patterns`` with the ``__width`` and hash ``__gram`` of each window that covers the text of ``name`` (not empty)."""
    read, hashes = _reader()
    widest = WIDEST

    def cover(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            borders, data = read(batch.column("__bytes"))
            sizes = np.diff(borders)
            width = 1 << (np.frexp(np.minimum(sizes, widest))[1].astype(np.int64) - 1)
            windows = -(-sizes // width)
            row = np.repeat(np.arange(len(sizes)), windows)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
            place = borders[row] + np.minimum(nth * width[row], (sizes - width)[row])
            grams = np.zeros(len(row), np.uint64)
            for start, wide, found in hashes(borders, data, set(width.tolist())):
                low, high = np.searchsorted(place, [start, start + len(found)])
                here = low + np.flatnonzero(width[row[low:high]] == wide)
                grams[here] = found[place[here] - start]
            firsts = np.concatenate([[0], np.cumsum(windows)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(firsts, pa.array(grams.view(np.int64)))
            others = [batch.column(c) for c in batch.schema.names if c != "__bytes"]
            yield pa.RecordBatch.from_arrays([*others, pa.array(width.astype(np.int32)), lists], [*names, "__width", "__grams"])

    names = patterns.columns
    schema = ", ".join(f"`{c}` {kind}" for c, kind in [*patterns.dtypes, ("__width", "int"), ("__grams", "array<long>")])
    covered = patterns.withColumn("__bytes", F.col(name).cast("binary")).mapInArrow(cover, schema)
    return covered.withColumn("__gram", F.explode("__grams")).drop("__grams")


def sieve(windows: DataFrame) -> Column:
    """One value that tells most windows that no pattern has: ``bits``, ``widths`` and the ``blocks`` with cells set.

    Past 4 million windows it lets more and more through; joins decide in any case.
    """
    bits = windows.agg(
        F.least(F.greatest(F.ceil(F.log2(F.count(F.lit(1)) * CELLS)), F.lit(LEAST_BITS)), F.lit(MOST_BITS)).cast("int")
    ).scalar()
    first = F.shiftrightunsigned("__gram", 64 - MOST_BITS)
    stride = F.shiftrightunsigned("__gram", 64 - 2 * MOST_BITS).bitwiseAND(F.lit((1 << MOST_BITS) - 1))
    every = F.transform(F.sequence(F.lit(0), F.lit(SET - 1)), lambda i: (first + stride * i) % (1 << MOST_BITS))
    cell = F.floor(F.col("__at") / F.pow(F.lit(2.0), F.lit(MOST_BITS) - bits))
    blocks = (
        windows.select("__width", F.explode(every).alias("__at"))
        .select("__width", cell.cast("long").alias("__cell"))
        .groupBy(F.floor(F.col("__cell") / BLOCK).cast("int").alias("block"))
        .agg(F.bitmap_construct_agg(F.col("__cell") % BLOCK).alias("cells"), F.collect_set("__width").alias("widths"))
    )
    whole = blocks.agg(F.collect_list(F.struct("block", "cells")).alias("blocks"), F.flatten(F.collect_list("widths")).alias("widths"))
    return whole.select(F.struct(bits.alias("bits"), F.array_distinct("widths").alias("widths"), "blocks")).scalar()


def sifted(texts: DataFrame, key: str, name: str, passes: Column) -> DataFrame:
    """``key``, text and distinct ``__grams`` of each text with windows that pass the sieve.

    The sieve comes with the first row of each partition.
    """
    read, hashes = _reader()
    most, count = MOST_BITS, SET

    def passed(cells, cell):
        return (cells[cell >> 3] >> (cell & 7).astype("uint8") & 1).nonzero()[0]

    def distinct(row, gram):
        import numpy as np

        order = np.lexsort((gram, row))
        row, gram = row[order], gram[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
        return row[new], gram[new]

    def sift(batches):
        import numpy as np
        import pyarrow as pa

        cells = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if cells is None:
                given = batch.column("__sieve")[0].as_py()
                if not given["blocks"]:
                    return
                cells = np.zeros((1 << given["bits"]) // 8, np.uint8)
                for block in given["blocks"]:
                    cells[block["block"] * 4096 : (block["block"] + 1) * 4096] = np.frombuffer(block["cells"], np.uint8)
                shift, widths = most - given["bits"], set(given["widths"])
            borders, data = read(batch.column("__bytes"))
            rows, grams = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
            for start, width, found in hashes(borders, data, widths):
                at = passed(cells, (found >> np.uint64(64 - most)).view(np.int64) >> shift)
                for k in range(1, count):
                    gram = found[at]
                    stride = gram >> np.uint64(64 - 2 * most) & np.uint64((1 << most) - 1)
                    cell = (gram >> np.uint64(64 - most)) + stride * np.uint64(k) & np.uint64((1 << most) - 1)
                    at = at[passed(cells, cell.view(np.int64) >> shift)]
                if not len(at):
                    continue
                row = np.searchsorted(borders, start + at, "right") - 1
                inside = start + at + width <= borders[row + 1]
                row, gram = distinct(row[inside], found[at[inside]])
                rows.append(row)
                grams.append(gram)
            row, gram = distinct(np.concatenate(rows), np.concatenate(grams))
            if not len(row):
                continue
            held, firsts = np.unique(row, return_index=True)
            lists = pa.ListArray.from_arrays(np.append(firsts, len(row)).astype(np.int32), pa.array(gram.view(np.int64)))
            picked = batch.select(["__key", "__bytes"]).take(pa.array(held))
            yield pa.RecordBatch.from_arrays([*picked.columns, lists], ["__key", "__bytes", "__grams"])

    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    given = texts.select(F.col(key).alias("__key"), F.col(name).cast("binary").alias("__bytes"), F.when(first, passes).alias("__sieve"))
    found = given.mapInArrow(sift, "__key string, __bytes binary, __grams array<long>")
    # Joins filter their keys; done here, it is the same plan wherever the rows are used, and one shuffle serves all.
    found = found.filter("__key IS NOT NULL")
    return found.select(F.col("__key").alias(key), F.col("__bytes").cast("string").alias(name), "__grams")

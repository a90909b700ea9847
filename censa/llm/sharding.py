"""Shards of near-equal bytes by longest-processing-time scheduling.

Documents of equal text form a group that stays together.  Groups go, largest first, to
the least loaded shard, which a heap gives.  Groups whose sizes agree in their 11 leading
bits form a size class (sizes below 2048 are classes of their own), so the heap deals
classes with counts, at most some 50,000 rows whatever the input: a class first fills the
shards up to one level, and its last groups go one by one through the heap.  Each group
then takes the shard that its number within its class falls to.

Null texts count as empty and form one group with empty texts.  Repeated rows are rows of
the same group.  Ties go to the shard with the smaller number.  An empty table gives no
rows.  Groups are told apart by a 64-bit hash; two texts that share one only stay together.
Texts of any length are read whole; further columns play no part, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from censa.llm.shared import kept, numbered

LEADING_BITS = 11
ROW_BYTES = 8


def size_class(size: Column) -> Column:
    """A number that grows with the size and has at most 1024 values for each power of two."""
    cut = F.greatest(F.length(F.bin(size)) - LEADING_BITS, F.lit(0))
    # The bits cut off, in the high part, then the leading bits.
    return cut.cast("long") * (1 << 20) + F.floor(size / F.pow(F.lit(2.0), cut)).cast("long")


def schedule(classes: list[tuple[int, int, int]], shards: int) -> list[tuple[int, int, int]]:
    """(class, first number, shard) of each run of groups, from (class, groups, bytes) rows."""
    heap = [(0.0, shard) for shard in range(shards)]
    runs = []
    for kind, groups, size in sorted(classes, reverse=True):
        mean = size / groups
        taken = dict.fromkeys(range(shards), 0)
        if groups > shards:
            loads = np.array(sorted(heap), dtype=np.float64)[:, 0]
            # The level to which groups * mean bytes fill the least loaded shards.
            levels = (np.cumsum(loads) + groups * mean) / np.arange(1, shards + 1)
            level = levels[max(k for k in range(shards) if k == 0 or levels[k] >= loads[k])]
            filled = []
            for load, shard in heap:
                taken[shard] = int(max(0.0, level - load) // mean)
                filled.append((load + taken[shard] * mean, shard))
            heap = filled
            heapq.heapify(heap)
        over = sum(taken.values()) - groups
        while over > 0:  # a rounding of the level, at most
            shard = max(taken, key=lambda s: taken[s])
            taken[shard] -= 1
            heap = [(load - mean * (s == shard), s) for load, s in heap]
            heapq.heapify(heap)
            over -= 1
        for _ in range(-over):
            load, shard = heapq.heappop(heap)
            taken[shard] += 1
            heapq.heappush(heap, (load + mean, shard))
        first = 0
        for shard, count in taken.items():
            if count:
                runs.append((kind, first, shard))
                first += count
    return runs


def sharded(documents: DataFrame, shards: int) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` (gapless from 0 in its shard) of every row."""
    spark = documents.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = kept(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.monotonically_increasing_id().alias("row"),
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("group"),
        ),
        "sharding-rows",
    )
    groups = kept(rows.groupBy("group").agg(F.sum("size").alias("bytes")).withColumn("class", size_class(F.col("bytes"))), "sharding-groups")
    classes = groups.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    runs = sorted(schedule([tuple(r) for r in classes.collect()], shards))
    kinds = np.unique(np.array([r[0] for r in runs], np.int64))
    table = spark.sparkContext.broadcast(
        (kinds, np.searchsorted(kinds, [r[0] for r in runs]).astype(np.int64) << 40 | np.array([r[1] for r in runs], np.int64), np.array([r[2] for r in runs], np.int32))
    )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, keys, shard = table.value
        for batch in batches:
            key = np.searchsorted(kinds, batch.column("class").to_numpy()).astype(np.int64) << 40 | batch.column("number").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("group"), pa.array(shard[np.searchsorted(keys, key, side="right") - 1])], ["group", "shard"])

    dealt = numbered(groups, "class", [F.col("group")], "number").select("group", "class", "number").mapInArrow(deal, "group long, shard int")
    # A text with very many copies is a hot key on one side only, which the skew join splits.
    placed = kept(rows.join(dealt, "group").drop("group"), "sharding-placed")
    return numbered(placed, "shard", [F.col("doc_id"), F.col("row")], "slot").select("doc_id", "size", "text_crc32", "shard", "slot")

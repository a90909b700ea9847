"""Token-id files of directly addressable codes.

A file is a Parquet table whose rows are segments of whole documents in ascending
``doc_id`` order; written by Spark's commit protocol, so lost tasks leave nothing behind.
A segment holds its ids as *levels*: level 0 has the lowest chunk (8 bits) of every id,
level 1 the next chunk of those ids that go on, and so on.  Each level has a bitmap that
says which of its ids go on and a rank directory (set bits before each block of 512), so
the place of an id in the next level is one rank.  Any token is read by one look into
each level, without decoding what stands around it.

``doc_id`` order: nulls first; repeated ids in the order of their text's hash.  Null texts
are empty (only the end id).  An empty table gives a file without segments.
Texts of any length are read whole; further columns play no part, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from censa.llm.shared import steps, width
from censa.llm.tokens import encoder

CHUNK_BITS = 8
RANK_BLOCK = 512
SEGMENT_TOKENS = 1 << 18
END_ID = 1
#: Characters of chunks remembered in a worker, twice.
CHARS = 2_500_000

SEGMENT = "part int, first long, n_tokens long, doc_ids array<long>, lengths array<int>, chunks array<binary>, bits array<binary>, ranks array<binary>"
ARROW = pa.schema(
    [("part", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32()))]
    + [(n, pa.list_(pa.binary())) for n in ("chunks", "bits", "ranks")]
)


def encode_levels(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Chunks, continuation bitmaps and rank directories of ids below 2**32."""
    chunks, bits, ranks = [], [], []
    rest = ids.astype(np.uint32)
    while True:
        goes_on = rest >= (1 << CHUNK_BITS)
        chunks.append(rest.astype(np.uint8).tobytes())
        bits.append(np.packbits(goes_on, bitorder="little").tobytes())
        by_block = np.add.reduceat(goes_on, np.arange(0, len(rest), RANK_BLOCK), dtype=np.int64) if len(rest) else np.zeros(0, np.int64)
        ranks.append((np.cumsum(by_block) - by_block).astype("<u4").tobytes())
        rest = rest[goes_on] >> CHUNK_BITS
        if not len(rest):
            return chunks, bits, ranks


def decode_levels(chunks: list[bytes], bits: list[bytes]) -> np.ndarray:
    """All ids of a segment."""
    ids = np.zeros(0, np.uint32)
    for level in range(len(chunks) - 1, -1, -1):
        low = np.frombuffer(chunks[level], np.uint8).astype(np.uint32)
        goes_on = np.unpackbits(np.frombuffer(bits[level], np.uint8), count=len(low), bitorder="little").astype(bool)
        low[goes_on] |= ids << CHUNK_BITS
        ids = low
    return ids


def _rank(bitmap: np.ndarray, directory: bytes, place: np.ndarray) -> np.ndarray:
    """Set bits before each place: those before its block by the directory, the others byte by byte."""
    block = place // RANK_BLOCK
    entries = np.frombuffer(directory, "<u4").astype(np.int64)
    rank = entries[np.minimum(block, len(entries) - 1)]
    for step in range(RANK_BLOCK // 8):
        byte = block * (RANK_BLOCK // 8) + step
        whole, partly = byte < place >> 3, byte == place >> 3
        value = bitmap[np.minimum(byte, len(bitmap) - 1)]
        value = np.where(partly, value & ((1 << (place & 7)) - 1), np.where(whole, value, 0)).astype(np.uint8)
        rank += np.bitwise_count(value)
    return rank


def access(chunks: list[bytes], bits: list[bytes], ranks: list[bytes], at: np.ndarray) -> np.ndarray:
    """The ids at some places of a segment, each by one look into every level it reaches."""
    ids = np.zeros(len(at), np.uint32)
    who, place = np.arange(len(at)), at.astype(np.int64)
    for level in range(len(chunks)):
        ids[who] |= np.frombuffer(chunks[level], np.uint8)[place].astype(np.uint32) << np.uint32(CHUNK_BITS * level)
        bitmap = np.frombuffer(bits[level], np.uint8)
        going = (bitmap[place >> 3] >> (place & 7)) & 1 == 1
        who, place = who[going], place[going]
        if not len(who):
            break
        place = _rank(bitmap, ranks[level], place)
    return ids


def spans(chunks: list[bytes], bits: list[bytes], ranks: list[bytes], starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ids of some stretches of a segment, one after the other.

    The directory tells where a stretch begins in the next level; its further ids follow there.
    """
    owner = np.repeat(np.arange(len(starts)), sizes)
    ids = np.zeros(len(owner), np.uint32)
    who, start = np.arange(len(owner)), starts.astype(np.int64)
    for level in range(len(chunks)):
        own = owner[who]
        # Places within a stretch count up from where it begins in this level.
        first = np.flatnonzero(np.diff(own, prepend=-1))
        place = np.repeat(start[own[first]] - first, np.diff(np.append(first, len(own)))) + np.arange(len(own))
        ids[who] |= np.frombuffer(chunks[level], np.uint8)[place].astype(np.uint32) << np.uint32(CHUNK_BITS * level)
        bitmap = np.frombuffer(bits[level], np.uint8)
        going = (bitmap[place >> 3] >> (place & 7)) & 1 == 1
        who = who[going]
        if not len(who):
            break
        beyond = np.zeros(len(start), np.int64)
        beyond[own[first]] = _rank(bitmap, ranks[level], start[own[first]])
        start = beyond
    return ids


def write(documents: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Encode every text, add the end id and write the segments below ``path``."""
    spark = documents.sparkSession

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = encoder(tokenizer, CHARS)
        part, first = 0, 0
        docs: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def segment() -> pa.RecordBatch:
            chunks, bits, ranks = encode_levels(np.concatenate(held))
            row = {"part": part, "first": first, "n_tokens": size, "doc_ids": docs, "lengths": [len(x) for x in held], "chunks": chunks, "bits": bits, "ranks": ranks}
            return pa.RecordBatch.from_pylist([row], ARROW)

        for batch, texts in steps(batches):
            values, bounds = codes.rows(texts)
            part = batch.column("part")[0].as_py()
            for doc, lo, hi in zip(batch.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                docs.append(doc)
                held.append(np.append(values[lo:hi], np.uint32(end_id)))
                size += hi - lo + 1
                if size >= segment_tokens:
                    yield segment()
                    first, size, docs, held = first + size, 0, [], []
        if held:
            yield segment()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Rows of one id (null above all) are cut into ranges too: by their text, and copies by their place.
    order = ["doc_id", F.xxhash64("text"), F.monotonically_increasing_id()]
    ordered = rows.repartitionByRange(width(spark), *order).sortWithinPartitions(*order[:2])
    ordered.withColumn("part", F.spark_partition_id()).mapInArrow(segments, SEGMENT).write.parquet(path)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments with ``start``, the number of ids before each in the whole file."""
    rows = spark.read.schema(SEGMENT).parquet(path)
    # One row per part of the write; the parts stand in doc_id order.
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # As many rows as the write had partitions, so the segments stay where they are read.
    return rows.join(F.broadcast(bases), "part").withColumn("start", F.col("base") + F.col("first")).drop("base")


def read(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` and ``ids`` (little-endian 32-bit) of every document, from the files."""
    names = ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * ids]

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                stops = np.cumsum(lengths)
                data = spans(row["chunks"], row["bits"], row["ranks"], stops - lengths, lengths).astype("<u4").tobytes()
                own = [data[4 * (e - n) : 4 * e] for n, e in zip(lengths.tolist(), stops.tolist(), strict=True)]
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + stops - lengths), pa.array(lengths), pa.array([zlib.crc32(x) for x in own], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(own, pa.binary())] * ids, names)

    return segments(spark, path).mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * ids)


def lookup(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """``doc_id``, ``position`` (from 0) and ``token_id`` for wanted (doc_id, position) rows; places outside a document are left out."""

    def at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                places = np.array([w["place"] for w in row["wanted"]], np.int64)
                ids = access(row["chunks"], row["bits"], row["ranks"], places)
                columns = [pa.array([w[n] for w in row["wanted"]], pa.int64()) for n in ("doc_id", "position")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(ids.astype(np.int64))], ["doc_id", "position", "token_id"])

    rows = spark.read.schema(SEGMENT).parquet(path)
    inside = rows.select("part", "first", F.posexplode(F.arrays_zip("doc_ids", "lengths")).alias("k", "d"))
    before = Window.partitionBy("part", "first").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    places = inside.select("part", "first", F.col("d.doc_ids").alias("doc_id"), F.col("d.lengths").alias("n"), F.coalesce(F.sum("d.lengths").over(before), F.lit(0)).alias("low"))
    hits = wanted.select("doc_id", "position").distinct().join(places, "doc_id").filter("position >= 0 AND position < n")
    grouped = hits.groupBy("part", "first").agg(F.collect_list(F.struct("doc_id", "position", (F.col("low") + F.col("position")).alias("place"))).alias("wanted"))
    return rows.join(grouped, ["part", "first"]).mapInArrow(at, "doc_id long, position long, token_id long")

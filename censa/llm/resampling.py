"""Importance resampling of documents towards the feature distribution of target texts.

The features of a text are its words and its pairs of consecutive words, hashed to
BUCKETS buckets.  A bucket's *gain* is the log of its smoothed share in the target texts
over its share in all documents, in thousandths.  A document's weight is the mean gain of its features,
and the documents with the highest weight plus Gumbel noise (fixed by seed and ``doc_id``) are drawn.

Weights are exact and bit-sliced.  The bucket counts of a document are bit planes of
BUCKETS bits, the gains signed planes (two's complement, the last plane counts negative).
Every plane of counts is ANDed with every plane of gains, the set bits are counted and
summed by the powers of two that both planes stand for.  Words of 64 buckets in which a
document's plane has no bit are not stored.

CRC-32 is linear over its register, so it is worked out for all words of a block at once
and that of a pair is put together from those of its words.

A null or empty text has no features and weight 0.  Repeated rows (equal ``doc_id``) have equal
scores when their texts are equal and each may be drawn; equal scores go by ``doc_id``
(null last), then by the order in which the rows were read.  No documents give no rows; no target
texts are a target without features.  Other columns play no part.  A text of any length is read whole;
a task holds one block of BLOCK_BYTES (or one longer text) in arrays.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from censa.llm.arrays import blocks, runs, sums
from censa.llm.shared import kept, numbered

BUCKETS = 10_000
#: 64-bit words of one plane.
WIDE = -(-BUCKETS // 64)
BLOCK_BYTES = 1 << 20
#: Words up to this length are hashed in arrays, longer ones one by one.
LONG = 64
ONES = 0xFFFFFFFF


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word bytes, lower case, one CRC-32 step by low byte, and any number of zero bytes by register byte."""
    every = np.arange(256)
    inside = (every >= 0x80) | ((every >= 0x30) & (every <= 0x39)) | ((every >= 0x41) & (every <= 0x5A)) | ((every >= 0x61) & (every <= 0x7A))
    lower = np.where((every >= 0x41) & (every <= 0x5A), every + 32, every).astype(np.uint8)
    step = every.astype(np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    zeros = np.empty((LONG + 1, 4, 256), np.uint32)
    zeros[0] = every.astype(np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
    for k in range(LONG):
        zeros[k + 1] = (zeros[k] >> 8) ^ step[zeros[k] & 255]
    return inside, lower, step, zeros


def _after_zeros(register: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Registers after ``count`` (at most LONG) zero bytes."""
    zeros = _tables()[3]
    out = zeros[count, 0, register & 255]
    for k in (1, 2, 3):
        out = out ^ zeros[count, k, (register >> (8 * k)) & 255]
    return out


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text and the bucket of each feature, and the words of each text."""
    inside, lower, step, _ = _tables()
    data = lower[data]
    starts, ends, text = runs(inside[data], offsets)
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    place, size = starts[order], lengths[order]
    register = np.zeros(len(order), np.uint32)
    counts = np.searchsorted(-size, -np.arange(LONG), "left")  # words longer than k bytes
    for k, n in enumerate(counts[: int(size[0]) if len(size) else 0].tolist()):
        now = register[:n]
        register[:n] = (now >> 8) ^ step[(now ^ data[place[:n] + k]) & 255]
    own = np.empty_like(register)  # the word's register from 0
    own[order] = register
    far = np.flatnonzero(lengths > LONG).tolist()
    for k in far:
        own[k] = zlib.crc32(data[starts[k] : ends[k]], ONES) ^ ONES
    short = np.minimum(lengths, LONG)
    single = own ^ _after_zeros(np.full(len(own), ONES, np.uint32), short)
    for k in far:
        single[k] = zlib.crc32(data[starts[k] : ends[k]]) ^ ONES
    pair = np.flatnonzero(text[1:] == text[:-1])
    blank = (single[pair] >> 8) ^ step[(single[pair] ^ 0x20) & 255]
    double = _after_zeros(blank, short[pair + 1]) ^ own[pair + 1]
    for k in far:
        if k and text[k] == text[k - 1]:
            double[np.searchsorted(pair, k - 1)] = zlib.crc32(data[starts[k] : ends[k]], int(blank[np.searchsorted(pair, k - 1)]) ^ ONES) ^ ONES
    crc = np.concatenate([single, double]) ^ np.uint32(ONES)
    return np.concatenate([text, text[pair]]), (crc % BUCKETS).astype(np.int64), np.bincount(text, minlength=len(offsets) - 1)


def gain_planes(gains: np.ndarray) -> np.ndarray:
    """Two's complement planes of the gains, lowest first; the last one counts negative."""
    bits = max(int(np.abs(gains).max()).bit_length(), 1) + 1
    planes = np.zeros((bits, WIDE * 64), np.uint8)
    planes[:, : len(gains)] = (gains[None, :] >> np.arange(bits)[:, None]) & 1
    return np.packbits(planes, axis=1, bitorder="little").view("<u8")


def gain_sums(text: np.ndarray, bucket: np.ndarray, n_texts: int, planes: np.ndarray) -> np.ndarray:
    """For each text the exact sum of the gains of its features."""
    found, counts = np.unique(text * (WIDE * 64) + bucket, return_counts=True)
    word, bit = found >> 6, np.uint64(1) << (found & 63).astype(np.uint64)
    total = np.zeros(n_texts, np.int64)
    for i in range(int(counts.max()).bit_length() if len(counts) else 0):
        here = (counts >> i) & 1 == 1
        first = np.flatnonzero(np.diff(word[here], prepend=-1))
        if not len(first):
            continue
        plane, at = np.bitwise_or.reduceat(bit[here], first), word[here][first]
        owner, column = at // WIDE, at % WIDE
        each = np.zeros(len(at), np.int64)
        for j, gains in enumerate(planes):
            power = np.bitwise_count(plane & gains[column]).astype(np.int64) << j
            each += -power if j == len(planes) - 1 else power
        total += sums(each, owner, n_texts) << i
    return total


def bucket_counts(texts: DataFrame) -> DataFrame:
    """``bucket`` and the number ``n`` of features in it, over all texts; every task hands on at most BUCKETS rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for _, data, offsets in blocks(batches, BLOCK_BYTES):
            total += np.bincount(features(data, offsets)[1], minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    parts = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of every bucket; BUCKETS numbers come to the driver.  Runs the count of both tables."""
    spark = documents.sparkSession
    both = bucket_counts(documents).withColumn("side", F.lit("s")).unionByName(bucket_counts(target).withColumn("side", F.lit("t")))
    seen = both.groupBy("bucket").pivot("side", ["s", "t"]).agg(F.sum("n"))
    every = spark.range(BUCKETS).withColumnRenamed("id", "bucket").join(seen, "bucket", "left").fillna(0, ["s", "t"])
    # One row holds both totals.
    all_s, all_t = (F.sum(c).over(Window.partitionBy()).cast("double") for c in ("s", "t"))
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    gain = F.floor(1000 * F.log((t + 1) * (all_s + BUCKETS) / ((s + 1) * (all_t + BUCKETS))))
    found = every.select("bucket", gain.cast("long").alias("gain")).collect()
    out = np.zeros(BUCKETS, np.int64)
    for row in found:
        out[row["bucket"]] = row["gain"]
    return out


def weighed(documents: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``weight`` of every row."""
    held = documents.sparkSession.sparkContext.broadcast(gain_planes(gain))  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches, BLOCK_BYTES):
            text, bucket, n_words = features(data, offsets)
            n = np.bincount(text, minlength=len(n_words))
            weight = gain_sums(text, bucket, len(n_words), held.value) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, (n_words, n, weight))], ["doc_id", "n_words", "n_features", "weight"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resampled(documents: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row.

    Drawn are ``percent`` (rounded down) of the documents of at least ``least_words``
    words, by score; ``rank`` is 1, 2, 3... in that order and null for all others.
    """
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((noise + 0.5) / F.lit(4294967296.0))))
    rows = weighed(documents, gains(documents, target)).withColumns({"score": F.col("weight") + gumbel, "row": F.monotonically_increasing_id()})
    rows = kept(rows, "resampling-rows")
    able = rows.filter(F.col("n_words") >= least_words).select("row", "score", F.col("doc_id").isNull().alias("no"), F.coalesce("doc_id", F.lit(0)).alias("id"))
    # Scores are whole and lie between the least gain and the largest plus that of the noise,
    # so one row a score is some tens of thousands of rows at most.
    order = Window.partitionBy().orderBy(F.desc("score"))
    by_score = able.groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    by_score = by_score.select(
        "score",
        F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("higher"),
        F.floor(F.sum("n").over(Window.partitionBy()) * percent / 100).alias("drawn"),
    ).filter("higher < drawn")
    near = able.join(by_score, "score")
    # Rows of one number and one score are one row before the window.
    ids = near.groupBy("score", "no", "id", "higher").agg(F.count(F.lit(1)).alias("same"))
    before = F.sum("same").over(Window.partitionBy("score").orderBy("no", "id").rowsBetween(Window.unboundedPreceding, -1))
    ids = ids.select("score", "no", "id", (F.col("higher") + F.coalesce(before, F.lit(0))).alias("place"))
    placed = kept(near.join(ids, ["score", "no", "id"]).select("row", "place", "drawn"), "resampling-placed")
    rank = (F.col("place") + F.col("inside") + 1).cast("long")
    ranked = numbered(placed, "place", [F.col("row")], "inside").withColumn("rank", rank).filter("rank <= drawn")
    return rows.join(ranked.select("row", "rank"), "row", "left").select("doc_id", "n_words", "n_features", "weight", "score", "rank")

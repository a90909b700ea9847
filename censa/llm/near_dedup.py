"""Near-duplicate documents by Order MinHash and banded alignment.

The k-mers of a text are its runs of five lower-cased words, labelled by how often each
occurred before.  Each of SKETCHES sketches takes the three k-mers of the smallest
hashes and keeps them in text order, so two texts share a sketch only when common k-mers
stand in the same order.  Texts that share one are candidates.

Two texts are near copies when the longest common subsequence of their k-mer sequences
makes up at least 0.8 of all k-mers of either (common / (n + m - common)).  It is found
by aligning equal k-mers within a band as wide as a shift can be at that similarity.

Texts of the same words are one node from the start.  The nodes of a shared sketch form
a bucket; equal buckets are kept once.  A bucket of up to BLOCK nodes is one block, a
larger one is cut by length (near copies differ by a fourth at most) and dealt to blocks by a
hash.  Within a block candidate pairs come from exact counts of common k-mers, and only pairs
that are not yet connected are aligned: first in the largest bucket of each node, then,
with the components of that, in all buckets that hold several.  Where a large bucket is left
with nodes outside its main component, these are then compared with all of its blocks, so
no pair of a bucket is left out, and no task holds more than two blocks.  Classes are the
connected components of the links found.

At similarity 0.8 a sketch is shared with probability 0.5 and all sixteen are missed
with probability 1.5e-5.

A null text is empty.  Texts without a word are one class.  A text of fewer than five
words is one k-mer.  Repeated rows are copies.  The smallest ``doc_id`` names a class
(nulls last).  An empty table gives no rows.
Texts of any length are read whole; further columns play no part, whatever their names.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censa.llm.chunks import ChunkTable, flat
from censa.llm.components import components
from censa.llm.shared import kept, steps

WORDS = 5
SIMILARITY = 0.8
SKETCHES = 16
TAKEN = 3
#: Nodes and words of a block at most (a text of more words is a block with what falls to it).
BLOCK = 256
BLOCK_WORDS = 2_000_000

ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=1)
def word_table() -> ChunkTable:
    """Chunks to 32-bit hashes of their lower-cased words."""
    return ChunkTable(lambda chunks: flat([(xxhash.xxh32_intdigest(c.lower()),) for c in chunks], np.uint32), np.uint32, 750_000)


def kmers(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit k-mer hashes of several texts one after the other, and the texts' bounds."""
    sizes = np.diff(bounds)
    counts = np.maximum(sizes - WORDS + 1, 1)
    padded = np.concatenate([words.astype(np.uint64) + np.uint64(1), np.zeros(WORDS, np.uint64)])
    stops = np.concatenate([[0], np.cumsum(counts)])
    first = np.repeat(bounds[:-1] - stops[:-1], counts) + np.arange(stops[-1])
    end = np.repeat(bounds[1:], counts)
    out = np.zeros(len(first), np.uint64)
    for k in range(WORDS):
        at = first + k
        out = mixed(out * ODD + np.where(at < end, padded[np.minimum(at, len(words))], np.uint64(0)))
    return out, stops


def labelled(hashes: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """k-mer hashes with the number of earlier occurrences in the same text mixed in."""
    text = np.repeat(np.arange(len(stops) - 1), np.diff(stops))
    order = np.lexsort((hashes, text))  # stable: equal k-mers stay in text order
    sorted_hashes, sorted_text = hashes[order], text[order]
    new = np.ones(len(order), bool)
    new[1:] = (sorted_hashes[1:] != sorted_hashes[:-1]) | (sorted_text[1:] != sorted_text[:-1])
    starts = np.flatnonzero(new)
    earlier = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    out = hashes.copy()
    again = earlier > 0
    out[order[again]] = mixed(sorted_hashes[again] + earlier[again].astype(np.uint64) * ODD)
    return out


def sketches(hashes: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """For each text SKETCHES numbers that stand for the ordered smallest k-mers."""
    starts, n = stops[:-1], len(stops) - 1
    text = np.repeat(np.arange(n), np.diff(stops))
    out = np.zeros((n, SKETCHES), np.uint64)
    largest = np.uint64(np.iinfo(np.uint64).max)
    for s in range(SKETCHES):
        keys = mixed(hashes ^ mixed(np.full(1, s + 1, np.uint64) * ODD))
        places = np.full((n, TAKEN), len(hashes), np.int64)
        for k in range(TAKEN):
            least = np.minimum.reduceat(keys, starts)
            found = np.flatnonzero(keys == np.repeat(least, np.diff(stops)))
            found = found[keys[found] != largest]
            owner = text[found][::-1]
            places[owner, k] = found[::-1]  # of equal keys the first in the text
            keys[places[places[:, k] < len(hashes), k]] = largest
        places.sort(axis=1)  # text order
        sketch = np.full(n, s + 1, np.uint64)
        for k in range(TAKEN):
            taken = np.append(hashes, np.uint64(0))[places[:, k]]
            sketch = mixed(sketch * ODD + taken)
        out[:, s] = sketch
    return out


def signed(documents: DataFrame, order: str = "doc_id") -> DataFrame:
    """Per row its words (32-bit hashes), two hashes of the whole, and its sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_table()
        for batch, texts in steps(batches):
            words, bounds = table.rows(texts)
            hashes, stops = kmers(words, bounds)
            rows = sketches(labelled(hashes, stops), stops).view(np.int64)
            raw = words.astype("<u4").tobytes()
            own = [raw[4 * lo : 4 * hi] for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            keys = np.array([(d >> 64, d & (1 << 64) - 1) for d in map(xxhash.xxh3_128_intdigest, own)], np.uint64).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, SKETCHES), pa.int32()), pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("order"), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(own, pa.binary()), lists],
                ["row", "doc_id", "order", "key", "key2", "words", "sketches"],
            )

    text = F.col("text").cast("string").alias("text")
    rows = documents.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col(order).cast("long").alias("order"), text)
    return rows.mapInArrow(run, "row long, doc_id long, order long, key long, key2 long, words binary, sketches array<long>")


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Common k-mers in order, of all k-mers of two sequences of labelled k-mers, by banded alignment."""
    n, m = len(a), len(b)
    least = int(np.ceil(SIMILARITY * (n + m) / (1 + SIMILARITY) - 1e-9))
    if min(n, m) < least:
        return 0.0
    if n == m and (a == b).all():
        return 1.0
    # Labelled k-mers are distinct, so each has one place at most in the other sequence.
    order = np.argsort(b)
    at = np.minimum(np.searchsorted(b[order], a), m - 1)
    place = order[at]
    equal = b[place] == a
    band = max(n, m) - least  # equal k-mers of a good alignment are shifted by no more
    inside = equal & (np.abs(place - np.arange(n)) <= band)
    if int(inside.sum()) < least:
        return 0.0
    tails: list[int] = []
    for p in place[inside].tolist():
        if not tails or p > tails[-1]:
            tails.append(p)
        else:
            tails[bisect.bisect_left(tails, p)] = p
    return len(tails) / (n + m - len(tails))


class _Sets:
    """Union-find over the nodes of one block."""

    def __init__(self, size: int) -> None:
        self.above = list(range(size))

    def root(self, at: int) -> int:
        while self.above[at] != at:
            self.above[at] = at = self.above[self.above[at]]
        return at

    def join(self, a: int, b: int) -> None:
        self.above[self.root(a)] = self.root(b)


def block_links(nodes: np.ndarray, words: list[bytes], known: np.ndarray, side: np.ndarray) -> list[tuple[int, int, float]]:
    """Links that connect the near copies of a block.

    ``known``: component labels so far.  ``side``: 0 or 1; where 1 occurs, only pairs with
    a node of side 1 are compared.
    """
    size = len(nodes)
    own = [np.frombuffer(w, "<u4") for w in words]
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in own])])
    hashes, stops = kmers(np.concatenate(own), bounds)
    hashes = labelled(hashes, stops)
    lengths = np.diff(stops)
    _, ids, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(counts[ids] > 1)
    column = np.cumsum(counts > 1)[ids[shared]] - 1
    owner = np.repeat(np.arange(size), lengths)[shared]
    common = np.zeros((size, size), np.float32)
    step = max(1, (1 << 22) // size)  # columns of 16 MB at once
    by_column = np.argsort(column, kind="stable")
    column, owner = column[by_column], owner[by_column]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        lo, hi = np.searchsorted(column, [low, low + step])
        part = np.zeros((size, step), np.float32)
        part[owner[lo:hi], column[lo:hi] - low] = 1
        part = part[:, : int(column[hi - 1]) - low + 1] if hi > lo else part[:, :0]
        common += part @ part.T
    either = lengths[:, None] + lengths[None, :] - common
    good = common >= SIMILARITY * either - 1e-6
    if side.any():
        good &= (side[:, None] == 1) | (side[None, :] == 1)
    first, second = np.nonzero(np.triu(good, 1))
    best = np.argsort(-(common / either)[first, second], kind="stable")
    sets = _Sets(size)
    seen: dict[int, int] = {}
    for at, label in enumerate(known.tolist()):
        sets.join(at, seen.setdefault(label, at))
    links = []
    for i, j in zip(first[best].tolist(), second[best].tolist(), strict=True):
        if sets.root(i) != sets.root(j):
            found = similarity(hashes[stops[i] : stops[i + 1]], hashes[stops[j] : stops[j + 1]])
            if found >= SIMILARITY - 1e-9:
                sets.join(i, j)
                links.append((int(nodes[i]), int(nodes[j]), found))
    return links


def _linked(blocks: DataFrame) -> DataFrame:
    """Links (a, b, similarity) within blocks: rows of bucket, block, node, known, side, words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        out: list[tuple[int, int, float]] = []

        def flush() -> None:
            if len(held) > 1:
                nodes, known, side, words = zip(*held, strict=True)
                out.extend(block_links(np.array(nodes), list(words), np.array(known), np.array(side)))
            held.clear()

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("bucket", "block", "node", "known", "side", "words")]
            for bucket, block, *row in zip(*columns, strict=True):
                if (bucket, block) != now:
                    flush()
                    now = bucket, block
                held.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["a", "b", "similarity"])
                out.clear()
        flush()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["a", "b", "similarity"])

    dealt = blocks.repartition("bucket", "block").sortWithinPartitions("bucket", "block", "node")
    return dealt.mapInArrow(run, "a long, b long, similarity double")


def _members(sketched: DataFrame) -> DataFrame:
    """``bucket``, its number of ``blocks``, and its nodes with their ``block`` and ``size`` (words).

    A bucket of more than BLOCK nodes is cut by length: near copies differ in length by a fourth
    at most, so a node goes with those of its own class of lengths and the next one.  Of
    buckets with the same nodes one is kept.
    """
    counted = sketched.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    several = sketched.join(counted, "bucket")
    # A little wider than 1 / SIMILARITY, so that rounding does not part near copies.
    length = F.floor(F.log(F.greatest(F.col("size"), F.lit(1))) / float(np.log(1.01 / SIMILARITY))).cast("int")
    by_length = several.filter(F.col("n") > BLOCK).select("bucket", "node", "size", length.alias("length"))
    by_length = by_length.select("node", "size", "bucket", "length", F.explode(F.array(F.col("length"), F.col("length") - 1)).alias("low"))
    by_length = by_length.select(F.xxhash64("bucket", "low").alias("bucket"), "node", "size", (F.col("length") == F.col("low")).alias("own"))
    whole = several.filter(F.col("n") <= BLOCK).select("bucket", "node", "size", F.lit(True).alias("own"))
    placed = kept(whole.unionByName(by_length), "near-placed")
    full = placed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"), F.sum(F.hash("node").cast("long")).alias("sum"), F.expr("bit_xor(xxhash64(node))").alias("mix"), F.max("own").alias("own")
    )
    # Without a node of its own lower class a bucket is part of the next one.
    full = full.filter("n > 1 AND own").groupBy("n", "words", "sum", "mix").agg(F.min("bucket").alias("bucket"))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("words") / BLOCK_WORDS)).cast("int")
    found = placed.join(full.select("bucket", "n", F.greatest(blocks, F.lit(1)).alias("blocks")), "bucket")
    return kept(found.select("bucket", "n", "blocks", "node", "size", F.pmod(F.xxhash64("bucket", "node"), "blocks").cast("int").alias("block")), "near-members")


def _labelled(members: DataFrame, label: DataFrame) -> DataFrame:
    """Members with the component each node is ``known`` to be in."""
    return members.join(label, "node", "left").withColumn("known", F.coalesce("component", "node")).drop("component")


def _joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links: the components of what the labels stand for."""
    ends = [label.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}")) for c in ("a", "b")]
    edges = links.select("a", "b").join(ends[0], "a", "left").join(ends[1], "b", "left")
    edges = edges.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    higher = components(edges)
    every = label.select("node", "component").unionByName(higher.select("node", F.col("node").alias("component")).join(label.select("node"), "node", "left_anti"))
    higher = higher.select(F.col("node").alias("component"), F.col("component").alias("top"))
    return kept(every.join(higher, "component", "left").select("node", F.coalesce("top", "component").alias("component")), "near-labels")


def found_links(rows: DataFrame, same: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links that connect all near copies, and the components they make."""
    nodes = rows.select("row", "sketches", (F.length("words") / 4).cast("long").alias("size")).join(same.select(F.col("node").alias("row")), "row", "left_semi")
    sketched = kept(nodes.select(F.col("row").alias("node"), "size", F.explode("sketches").alias("bucket")), "near-sketches")
    members = _members(sketched)
    # The words of members only, written once: they are needed for each round of links.
    # No side of these joins has a bound, so they are sorted ones at every size.
    words = rows.select(F.col("row").alias("node"), "words")
    words = kept(words.join(members.select("node").distinct().hint("merge"), "node", "left_semi"), "near-words")
    placed = lambda known: known.select("bucket", F.col("block").cast("long").alias("block"), "node", "known", F.lit(0).alias("side"))
    # First each node looks for near copies in its largest bucket only, which connects most groups by
    # one tree; then all buckets that hold several components link these.
    largest = members.groupBy("node").agg(F.max(F.struct("n", "bucket")).alias("most")).select("node", F.col("most.bucket").alias("bucket"))
    fresh = members.join(largest, ["node", "bucket"], "left_semi").withColumn("known", F.col("node"))
    links = kept(_linked(placed(fresh).join(words.hint("merge"), "node")), "near-links")
    label = components(links)
    known = kept(_labelled(members, label), "near-known")
    apart = known.groupBy("bucket").agg(F.min("known").alias("low"), F.max("known").alias("high")).filter("low < high")
    more = known.join(apart.select("bucket"), "bucket", "left_semi")
    more = kept(_linked(placed(more).join(words.hint("merge"), "node")), "near-links")
    label = _joined(label, more)
    links = links.unionByName(more)
    large = members.filter("blocks > 1")
    if not large.isEmpty():
        more = _across(large, label, words)
        label = _joined(label, more)
        links = links.unionByName(more)
    return links, label


def classes(documents: DataFrame, order: str = "doc_id") -> DataFrame:
    """``doc_id``, ``class_id``, ``class_size``, ``kept`` and ``least_similarity`` of every row.

    Of a class the row with the smallest ``order`` stays (nulls last).  The least similarity is that
    of the links that connect the class (1 where all its texts have the same words).
    """
    rows = kept(signed(documents, order), "near-rows")
    # One node for each distinct sequence of words; copies combine before the shuffle.
    same = kept(rows.groupBy("key", "key2").agg(F.min("row").alias("node")), "near-nodes")
    links, label = found_links(rows, same)
    return _described(rows, same, links, label)


def _across(large: DataFrame, label: DataFrame, words: DataFrame) -> DataFrame:
    """Links between the nodes outside a large bucket's main component and all of the bucket."""
    known = kept(_labelled(large, label), "near-known")
    counts = known.groupBy("bucket", "known").agg(F.count(F.lit(1)).alias("k"), F.sum("size").alias("words"))
    main = counts.groupBy("bucket").agg(F.max(F.struct("k", "known", "words")).alias("main"), F.sum("k").alias("all"), F.sum("words").alias("words"))
    parts = F.ceil(F.greatest((F.col("all") - F.col("main.k")) / BLOCK, (F.col("words") - F.col("main.words")) / BLOCK_WORDS)).cast("int")
    main = main.select("bucket", F.col("main.known").alias("main"), parts.alias("parts"))
    told = known.join(main.filter("parts > 0"), "bucket")
    out = F.col("known") != F.col("main")
    part = F.pmod(F.xxhash64("node", "bucket"), F.col("parts")).cast("int")
    place = lambda block, part: (block.cast("long") * F.col("parts") + part)
    # Every block meets every part of the outside nodes.
    blocks = told.select("bucket", F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: place(F.col("block"), p))).alias("block"), "node", "known", F.lit(0).alias("side"), out.alias("out"), part.alias("part"), "parts")
    # A node of the part that the block holds itself is there once, as a node of the part.
    blocks = blocks.filter("NOT (out AND block % parts = part)").drop("out", "part", "parts")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    parts = told.filter(out).select("bucket", F.explode(F.transform(every, lambda b: place(b, part))).alias("block"), "node", "known", F.lit(1).alias("side"))
    return kept(_linked(blocks.unionByName(parts).join(words.hint("merge"), "node")), "near-links")


def _described(rows: DataFrame, same: DataFrame, links: DataFrame, label: DataFrame) -> DataFrame:
    grouped = same.join(label, "node", "left").select("key", "key2", F.coalesce("component", "node").alias("class"))
    # Few keys are hot: copies of one text, and classes; the skew join splits them.
    placed = kept(rows.select("row", "doc_id", "order", "key", "key2").join(grouped, ["key", "key2"]).select("row", "doc_id", "order", "class"), "near-placed")
    least = links.join(label, F.col("a") == F.col("node")).groupBy(F.col("component").alias("class")).agg(F.min("similarity").alias("least_similarity"))
    first = placed.groupBy("class").agg(F.min(F.struct(F.col("order").isNull().alias("no"), "order", "row", "doc_id")).alias("first"), F.count(F.lit(1)).alias("class_size"))
    first = kept(first.join(least, "class", "left").fillna(1.0, ["least_similarity"]), "near-first")
    return placed.join(first, "class").select(
        "doc_id",
        F.col("first.doc_id").alias("class_id"),
        "class_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "least_similarity",
    )


def deduplicated(documents: DataFrame) -> DataFrame:
    """One row of each class, with its columns (the row of the smallest number where a class has no ``doc_id``)."""
    row = "near_row" + "_" * max(map(len, documents.columns))  # none of the columns is that long
    numbered = kept(documents.withColumn(row, F.monotonically_increasing_id()), "near-input")
    found = classes(numbered.select(F.col(row).alias("doc_id"), "text", F.col("doc_id").cast("long").alias("order")), "order")
    return numbered.join(found.filter("NOT kept").select(F.col("doc_id").alias(row)), row, "left_anti").select(*documents.columns)

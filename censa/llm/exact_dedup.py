"""Exact dedup by two-pass Bloom filtering, in built-in functions only.

Texts are equal when identical after each run of spaces, tabs and line ends is made one
space.  The first pass sets two cells of a Bloom filter for each row's hash and keeps the
cells that more than one row set.  The second pass asks that filter: a row with a cell of
its own is alone and passes straight through; only the others are shuffled by their
SHA-256 and compared in full.  The filter has 16 cells for each row, in blocks; each row has
its cells in one block.  Up to MAX_BLOCKS blocks are broadcast.  A larger filter stays in its blocks, and
hashes (not texts) are brought to them.

Null texts count as empty.  Of equal texts the row with the smallest ``doc_id`` stays
(null ids last); of repeated rows with that id one stays.  An empty table gives no rows.
Texts of any length are read whole; further columns play no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from censa.llm.shared import kept

CELLS_PER_ROW = 16
BLOCK_BITS = 15
#: Blocks of 4 KB: 16 MB of filter, the most that is broadcast.
MAX_BLOCKS = 1 << 12


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def _cells(sha: Column, blocks: int) -> tuple[Column, Column, Column]:
    """Block of the filter and two cells in it."""
    hashed = F.xxhash64(sha)
    cell = F.shiftrightunsigned(hashed, 64 - BLOCK_BITS).cast("int")
    step = F.shiftrightunsigned(hashed, 64 - 2 * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")
    other = cell.bitwiseXOR(F.greatest(step, F.lit(1)))
    return F.pmod(hashed, F.lit(blocks)).cast("int"), cell, other


def _blocks(n_rows: int) -> int:
    return max(1, -(-max(n_rows, 1) * CELLS_PER_ROW >> BLOCK_BITS))


def maybe_repeated(rows: DataFrame, n_rows: int, sha: str = "sha") -> DataFrame:
    """``rows`` with ``maybe``: false where no other row has the hash.  ``rows`` is read twice.

    Beyond MAX_BLOCKS the rows are shuffled to their blocks, so they should be small.
    """
    blocks = _blocks(n_rows)
    block, cell, other = _cells(F.col(sha), blocks)
    size = 1 << BLOCK_BITS
    set_twice = (
        rows.select(F.explode(F.array(block.cast("long") * size + cell, block.cast("long") * size + other)).alias("at"))
        .groupBy("at")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(
            F.floor(F.col("at") / size).cast("int").alias("_block"),
            F.pmod(F.floor(F.col("at") / 64), F.lit(size // 64)).cast("int").alias("word"),
            F.expr("shiftleft(1L, cast(at % 64 as int))").alias("mask"),
        )
        .groupBy("_block", "word")
        .agg(F.bit_or("mask").alias("mask"))
        .groupBy("_block")
        .agg(F.map_from_entries(F.collect_list(F.struct("word", "mask"))).alias("words"))
        .select("_block", F.transform(F.sequence(F.lit(0), F.lit(size // 64 - 1)), lambda i: F.coalesce(F.col("words")[i], F.lit(0).cast("long"))).alias("_words"))
    )
    bit = lambda c: F.getbit(F.get(F.col("_words"), F.shiftright(c, 6)), c.bitwiseAND(F.lit(63))) == 1
    # A hot text makes a hot block on the side of the rows, which the skew join splits.
    side = F.broadcast(set_twice) if blocks <= MAX_BLOCKS else set_twice.hint("merge")
    asked = rows.withColumn("_block", block).join(side, "_block", "left")
    return asked.withColumn("maybe", F.col("_words").isNotNull() & bit(cell) & bit(other)).drop("_block", "_words")


def groups(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of every row."""
    rows = kept(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), digest(F.col("text")).alias("sha")),
        "exact-rows",
    )
    asked = kept(maybe_repeated(rows, rows.count()), "exact-asked")
    alone = asked.filter("NOT maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    some = asked.filter("maybe")
    first = some.groupBy("sha").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("group_size"))
    # A text with very many copies is a hot key on one side only.  The skew join splits it,
    # as both sides are plain shuffles: the groups are written first.
    first = kept(first, "exact-groups")
    repeated = some.join(first, "sha").select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), F.col("sha").alias("text_sha256")
    )
    return alone.unionByName(repeated)


def deduplicated(documents: DataFrame) -> DataFrame:
    """The rows that stay, with their columns.  Rows that no other may equal are not shuffled while the filter is broadcast.

    Of equal texts with one ``doc_id`` the row of the smallest hash of all its columns stays.
    """
    n_rows = documents.count()
    order = F.struct(F.col("doc.doc_id").isNull().alias("no"), F.col("doc.doc_id").alias("id"), F.xxhash64(F.to_json("doc")).alias("hash"))
    if _blocks(n_rows) <= MAX_BLOCKS:
        asked = maybe_repeated(documents.select(F.struct("*").alias("doc"), digest(F.col("text")).alias("sha")), n_rows)
        one = asked.filter("maybe").groupBy("sha").agg(F.min_by("doc", order).alias("doc"))
        return asked.filter("NOT maybe").select("doc.*").unionByName(one.select("doc.*"))
    # Hashes and row numbers alone are brought to the blocks; only rows that go are joined back.
    numbered = kept(documents.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "exact-input")
    rows = kept(numbered.select("row", order.alias("order"), digest(F.col("doc.text")).alias("sha")), "exact-rows")
    some = maybe_repeated(rows, n_rows).filter("maybe").select("row", "order", "sha")
    first = kept(some.groupBy("sha").agg(F.min(F.struct("order", "row")).alias("first")), "exact-groups")
    gone = some.join(first, "sha").filter("row <> first.row").select("row")
    return numbered.join(gone, "row", "left_anti").select("doc.*")

"""One-permutation MinHash fingerprints with low-order bits, in built-in functions only.

The shingles (five words) of a text are hashed once.  The leading byte of a hash is its
bin, the smallest hash of a bin its value.  Empty bins are densified: each probes bins in
an order of its own, drawn by a hash and the same for all texts, and takes the value of
the first that is filled; a second to sixth round serves texts of so few shingles that
sixteen probes found nothing.  Four low bits of each bin are stored, 128 bytes in all,
and a likeness takes off the one match in sixteen that is chance.

A null text is empty, and an empty text has one empty shingle, as has a text of fewer
than five words one shingle.  Equal texts have equal fingerprints; a likeness of two
equal fingerprints is 1.  An empty table gives no rows.
Texts of any length are read whole; further columns play no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WORDS = 5
BINS = 256
BITS = 4
PROBES = (16, 8, 8, 8, 8, 8)
LOW = (1 << 56) - 1
#: Rows between two borders of the ``doc_id`` order, and the most borders.
BORDER_ROWS = 512
MAX_BORDERS = 1 << 14
STEP = 128


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def shingles(text: Column) -> Column:
    """Hashes of all runs of five words."""
    words = F.transform(F.split(F.trim(text), r"\s+"), lambda w: F.xxhash64(w))
    zero = F.lit(0).cast("long")
    filled = _bound(words, lambda h: F.when(F.size(h) >= WORDS, h).otherwise(F.concat(h, F.array_repeat(zero, F.lit(WORDS) - F.size(h)))))
    return _bound(
        filled,
        lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - WORDS), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WORDS)))),
    )


def _bins(hashes: Column) -> Column:
    """The low bits of the smallest hash of each bin, null for empty bins.

    A mark at the upper end of each bin is sorted in with the hashes, so the first value
    of every bin is its smallest hash or, in an empty bin, the mark.
    """
    marks = F.expr("array(" + ", ".join(f"{_signed(b << 56 | LOW)}L" for b in range(BINS)) + ")")
    least = _bound(
        F.sort_array(F.concat(hashes, marks)),
        lambda s: F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, 56) != F.shiftright(F.get(s, i - 1), 56))),
    )
    return F.transform(least, lambda x: F.when(x.bitwiseAND(F.lit(LOW)) != LOW, x.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")))


def _filling(turn: int, probes: int):
    """One round: an empty bin takes the first filled one of its probes."""

    def fill(d: Column) -> Column:
        probed = lambda i, k: F.pmod(F.xxhash64(F.lit(turn), F.lit(k), i), F.lit(BINS)).cast("int")
        tries = lambda x, i: F.coalesce(x, *(F.get(d, probed(i, k)) for k in range(probes)))
        return F.when(F.size(F.array_compact(d)) == BINS, d).otherwise(F.transform(d, tries))

    return fill


def _densified(bins: Column) -> Column:
    for turn, probes in enumerate(PROBES):
        bins = _bound(bins, _filling(turn, probes))
    return F.transform(bins, lambda x: F.coalesce(x, F.lit(0)))


def fingerprint(text: Column) -> Column:
    """Sixteen longs with sixteen bins each."""
    each = 64 // BITS
    return _bound(
        _densified(_bins(shingles(text))),
        lambda d: F.transform(
            F.sequence(F.lit(0), F.lit(BINS // each - 1)),
            lambda w: F.aggregate(F.slice(d, w * each + 1, F.lit(each)), F.lit(0).cast("long"), lambda a, x: F.shiftleft(a, BITS).bitwiseOR(x.cast("long"))),
        ),
    )


def shown(packed: Column) -> Column:
    """A fingerprint as hexadecimal text, one digit a bin."""
    return F.array_join(F.transform(packed, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """The estimated share of common shingles, 0 to 1."""
    ones = F.lit(0x1111111111111111)

    def differing(x: Column) -> Column:
        half = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        return F.bit_count(half.bitwiseOR(F.shiftrightunsigned(half, 2)).bitwiseAND(ones))

    unlike = F.aggregate(F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y)), F.lit(0), lambda n, x: n + differing(x))
    chance = 1 / (1 << BITS)
    return F.greatest(F.lit(0.0), (1 - unlike / F.lit(BINS) - chance) / (1 - chance))


def fingerprints(documents: DataFrame) -> DataFrame:
    """``documents`` with ``fingerprint``."""
    return documents.withColumn("fingerprint", shown(fingerprint(F.coalesce(F.col("text").cast("string"), F.lit("")))))


def with_next(documents: DataFrame, columns: list[str], key: str = "doc_id") -> DataFrame:
    """Rows with ``next_<column>`` of the next row in descending order of ``key``, after the last the first.

    Borders of the order, at most MAX_BORDERS, cut the rows into stretches; the row at a
    border is also handed to the next stretch, so one shuffle by stretch is all.  Nulls
    come after all keys; rows of equal keys are ordered by a hash of their columns.
    """
    at = F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)).cast("long"))
    keys = documents.select(at.alias("k"))
    n = documents.count()
    wanted = min(MAX_BORDERS, max(1, n // BORDER_ROWS))
    shares = [(i + 1) / (wanted + 1) for i in range(wanted)]
    found = keys.agg(F.max("k").alias("top"), F.percentile_approx("k", shares, max(10_000, 10 * wanted)).alias("at")).first()
    borders = sorted(set(found["at"] or []) - {found["top"]})
    literal = F.array(*map(F.lit, borders)).cast("array<bigint>")
    coarse = F.array(*map(F.lit, borders[STEP - 1 :: STEP])).cast("array<bigint>")
    below = lambda bounds, k: F.size(F.filter(bounds, lambda b: b < k))
    first = F.col("_first")
    rows = documents.withColumn("_k", at).withColumn("_first", below(coarse, F.col("_k")) * STEP)
    rows = rows.withColumn("_stretch", first + below(F.slice(literal, first + 1, F.lit(STEP)), F.col("_k")))
    own = F.struct(F.col("_stretch").alias("stretch"), F.lit(False).alias("copy"))
    after = F.when(F.array_contains(literal, F.col("_k")), F.struct((F.col("_stretch") + 1).alias("stretch"), F.lit(True).alias("copy")))
    around = F.when(F.col("_k") == F.lit(found["top"]), F.struct(F.lit(0).alias("stretch"), F.lit(True).alias("copy")))
    rows = rows.withColumn("_to", F.explode(F.array_compact(F.array(own, after, around))))
    order = Window.partitionBy("_to.stretch").orderBy(F.desc("_to.copy"), "_k", F.xxhash64(*columns))
    # All columns in one window, or each would be sorted and shuffled anew.
    rows = rows.withColumn("_next", F.lag(F.struct(*columns)).over(order)).filter("NOT _to.copy")
    return rows.select(*documents.columns, *(F.col(f"_next.{name}").alias(f"next_{name}") for name in columns))


def compared(documents: DataFrame) -> DataFrame:
    """Every text against its edited text (its last third replaced by the next document's start) and the next document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), fingerprint(text).alias("print"))
    rows = with_next(own, ["text", "print"])
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.length("text") - third), F.substr("next_text", F.lit(1), third))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "print", "next_print", edited.alias("edited"))
    rows = rows.select("*", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), fingerprint(F.col("edited")).alias("edited_print"))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        shown(F.col("print")).alias("fingerprint"),
        shown(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )

"""Exact positions over a whole frame, without a single-task window and without writing the frame.

Equal rows are one row with a count first, so no number of copies burdens a task.  Borders
taken from a sample cut the order into ranges.  A row's range depends on nothing but the row,
so the sizes of ranges and the positions inside them agree whenever they are worked out,
also after an executor is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sampled rows for each range.
PER_RANGE = 20
#: Copies of one row that one task numbers at most.
COPIES = 10_000
_ROW, _KEY, _N, _RANGE, _FIRST = "__row", "__key", "__n", "__range", "__first"


def _borders(rows: DataFrame, ranges: int) -> Column:
    """Sorted borders between ranges, as one array; one value, found while the query runs.

    The sample is the rows of the smallest hashes, so it has the same size for any frame.
    """
    sample = rows.select(_KEY).orderBy(F.xxhash64(_KEY), _KEY).limit(ranges * PER_RANGE)
    place = lambda i: F.greatest(F.lit(1), F.ceil(i * F.size("s") / ranges).cast("int"))
    picked = F.transform(F.sequence(F.lit(1), F.lit(max(ranges - 1, 1))), lambda i: F.element_at("s", place(i)))
    return sample.agg(F.sort_array(F.collect_list(_KEY)).alias("s")).select(F.when(F.size("s") > 0, picked)).scalar()


def _with_range(rows: DataFrame, ranges: int) -> DataFrame:
    """Add the number of borders below each row's key, by a binary search of one projection a step."""
    borders, step = _borders(rows, ranges), 1 << max(ranges - 1, 1).bit_length()
    rows = rows.withColumn(_RANGE, F.lit(0))
    while step := step // 2:
        below = F.get(borders, F.col(_RANGE) + F.lit(step - 1)) < F.col(_KEY)
        rows = rows.withColumn(_RANGE, F.when(below, F.col(_RANGE) + F.lit(step)).otherwise(F.col(_RANGE)))
    return rows


def ranked(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Distinct rows (``__row``) with their number of copies (``__n``), range, and first position (``__first``, from 0).

    Rows of equal order keys follow each other by a hash of the row.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(row.alias(_ROW)).groupBy(_ROW).agg(F.count(F.lit(1)).alias(_N))
    key = F.struct(*[F.col(f"{_ROW}.`{c}`").alias(f"k{i}") for i, c in enumerate(order)], F.xxhash64(_ROW).alias("hash"))
    rows = _with_range(rows.withColumn(_KEY, key), ranges)
    sizes = rows.groupBy(_RANGE).agg(F.sum(_N).alias("size"))
    earlier = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(_RANGE, F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy(_RANGE).orderBy(_KEY).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inside", F.coalesce(F.sum(_N).over(inside), F.lit(0)))
    # One row a range: the window and the broadcast are as small as the partition count.
    first = (F.col("before") + F.col("inside")).cast("long")
    return placed.join(F.broadcast(before), _RANGE).select(_ROW, _N, _RANGE, first.alias(_FIRST))


def number_rows(df: DataFrame, order: Sequence[str], out: str = "id") -> DataFrame:
    """Exact row numbers 1..n in the given order, nulls first; nothing runs yet."""
    rows = ranked(df, order)
    numbers = lambda first, n: F.explode(F.sequence(first + 1, first + n)).alias(out)
    few = rows.filter(F.col(_N) <= COPIES).select(_ROW, numbers(F.col(_FIRST), F.col(_N)))
    # Copies of a hot row are dealt to tasks in shares.
    shares = rows.filter(F.col(_N) > COPIES).select(_ROW, _FIRST, _N, F.explode(F.sequence(F.lit(0).cast("long"), F.col(_N) - 1, F.lit(COPIES).cast("long"))).alias("from"))
    shares = shares.repartition("from", _FIRST)
    many = shares.select(_ROW, numbers(F.col(_FIRST) + F.col("from"), F.least(F.lit(COPIES), F.col(_N) - F.col("from"))))
    return few.unionByName(many).select(f"{_ROW}.*", out)


def sparse_ids(df: DataFrame, out: str = "id") -> DataFrame:
    """Unique ids with gaps: no shuffle, no order."""
    return df.withColumn(out, F.monotonically_increasing_id() + 1)


def has_unique_column(df: DataFrame, column: str) -> bool:
    """Whether a column exists and no value, null included, occurs twice."""
    if column not in df.columns:
        return False
    repeated = df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return repeated.limit(1).count() == 0


def ensure_id(df: DataFrame, order: Sequence[str], column: str = "id") -> DataFrame:
    """Keep a unique ``id`` column, else number the rows.  Whether it is unique is found out at once, by one job."""
    return df if has_unique_column(df, column) else number_rows(df.drop(column), order, column)


def seeded_sample(df: DataFrame, n: int, seed: int = 1) -> DataFrame:
    """The ``n`` rows with the smallest seeded row hash: repeatable, top-n without a full sort."""
    key = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in df.columns], F.lit(str(seed))))
    return df.withColumn("__key", key).orderBy("__key", *df.columns).limit(n).drop("__key")

"""Column profiles: counts, lengths, flags, samples, frequent values, quartiles.

Row and null counts are plain aggregates.  Where distinct values are needed, wide
frames are unpivoted to (column, value) and grouped, so one shuffle serves all columns
and copies combine before it; each task passes on one partial row per column, or its
first few values.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_SIZE = 10
TOP_VALUES = 5
# The approximate quantile is off by at most 1 / ACCURACY of the rows, so a bracket of
# twice that to either side holds the exact one.
ACCURACY = 100_000
BRACKET = 2 / ACCURACY

# How a value's kind is told apart, first match wins.
INTEGER_TEXT = r"^-?[0-9]+$"
DECIMAL_TEXT = r"^-?[0-9]+\.[0-9]+$"

# Texts a yes/no column may hold, lower case.
BOOLEAN_TEXTS = ["0", "1", "true", "false", "yes", "no"]


def _as_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column_name, value) rows, every value as text."""
    columns = list(columns)
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return texts.unpivot([], columns, "column_name", "value")


def value_counts(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Rows per (column_name, value), null values included."""
    columns = df.columns if columns is None else list(columns)
    return _as_text(df, columns).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def leading_zero(value: Column) -> Column:
    return value.rlike("^0[0-9]+$")


def special_character(value: Column) -> Column:
    """Any character that is neither letter, digit, underscore nor blank space."""
    return value.rlike(r"[^\p{L}\p{N}_\s]")


def value_kind(value: Column) -> Column:
    """Kind of the trimmed text: 1 integer, 2 float, 3 string.

    Numbers, not names, so that their minimum and maximum are hash-aggregated.
    """
    text = F.trim(value)
    return F.when(text.rlike(INTEGER_TEXT), 1).when(text.rlike(DECIMAL_TEXT), 2).otherwise(3)


def boolean_text(value: Column) -> Column:
    return F.lower(F.trim(value)).isin(BOOLEAN_TEXTS)


def iso_date_text(value: Column) -> Column:
    shaped = value.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$")
    return shaped & F.try_to_date(value, "yyyy-M-d").isNotNull()


def magnitude(value: Column) -> Column:
    """Absolute value of integer text, null for anything else; the cast sees no other text, where it is slow."""
    return F.when(F.trim(value).rlike(INTEGER_TEXT), F.abs(value.try_cast("decimal(38,0)")))


def _ranked(counts: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` non-null values per column; Spark keeps ``k`` per task before the shuffle.

    The orders put null last, and it is dropped here, after the window: dropped
    earlier it would give this branch a shuffle of its own.
    """
    window = Window.partitionBy("column_name").orderBy(*order)
    ranked = counts.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
    return ranked.filter(F.col("value").isNotNull())


def _sizes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and nulls of each column, in one pass without a shuffle of rows."""
    counts = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(c)).alias(c) for c in columns])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col("__rows").alias("n_rows"), (F.col("__rows") - F.col(c)).alias("n_null")) for c in columns]
    return counts.select(F.inline(F.array(*rows)))


def _flags(values: DataFrame) -> DataFrame:
    """Number, lengths and flags of the distinct values of each column.

    None of them depends on how often a value occurs, so each value is looked at once.
    """
    value = F.col("value")
    # A character value of length zero says nothing about lengths.
    length = F.when(F.length(value) > 0, F.length(value))
    kind = value_kind(value)
    return values.groupBy("column_name").agg(
        F.count(value).alias("n_distinct"),
        F.max(length).alias("max_length"),
        F.min(length).alias("min_length"),
        F.max(leading_zero(value)).alias("leading_zeros"),
        F.max(special_character(value)).alias("special_chars"),
        (F.min(kind) != F.max(kind)).alias("mixed_types"),
        F.bool_and(boolean_text(value)).alias("all_boolean"),
        F.bool_and(iso_date_text(value)).alias("all_dates"),
        F.max(magnitude(value)).alias("largest"),
    )


def column_profile(df: DataFrame, columns: Iterable[str] | None = None, sample: int = SAMPLE_SIZE) -> DataFrame:
    """One row per column with the nine profile metrics, and what type suggestion needs.

    Flags and lengths describe text columns and are computed on all values.  The
    sample holds the smallest distinct values in text order.  On top come the row
    count, whether all values are yes/no texts or ISO dates, and the largest integer.
    All but the counts of rows and nulls is taken from one shuffle, of distinct values.
    """
    columns = df.columns if columns is None else list(columns)
    fields = {f.name: f.dataType for f in df.schema.fields}
    values = _as_text(df, columns).filter(F.col("value").isNotNull()).distinct()
    samples = _ranked(values, [F.asc_nulls_last("value")], sample).groupBy("column_name").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "value"))), lambda s: s["value"]).alias("sample")
    )
    listed = df.sparkSession.createDataFrame(
        [(i, c, fields[c].simpleString(), isinstance(fields[c], T.StringType)) for i, c in enumerate(columns)],
        "position int, column_name string, data_type string, is_text boolean",
    )
    no, zero = F.lit(False), F.lit(0)
    text = F.col("is_text")
    return (
        # One row per column of the frame on every side.
        listed.join(F.broadcast(_sizes(df, columns)), "column_name", "left")
        .join(F.broadcast(_flags(values)), "column_name", "left")
        .join(F.broadcast(samples), "column_name", "left")
        .select(
            "position",
            "column_name",
            "data_type",
            F.coalesce("n_rows", zero).alias("n_rows"),
            F.coalesce("n_distinct", zero).alias("n_distinct"),
            F.coalesce("n_null", zero).alias("n_null"),
            F.coalesce("sample", F.array().cast("array<string>")).alias("sample"),
            F.when(text, F.coalesce("max_length", zero)).otherwise(0).alias("max_length"),
            F.when(text, F.coalesce("min_length", zero)).otherwise(0).alias("min_length"),
            (text & F.coalesce("leading_zeros", no)).alias("leading_zeros"),
            (text & F.coalesce("special_chars", no)).alias("special_chars"),
            (text & F.coalesce("mixed_types", no)).alias("mixed_types"),
            F.coalesce("all_boolean", no).alias("all_boolean"),
            F.coalesce("all_dates", no).alias("all_dates"),
            "largest",
        )
    )


def list_metrics(df: DataFrame, values: str) -> DataFrame:
    """Add the five basic metrics of a list-of-text column, row by row.

    Here a leading zero needs no digits after it, and mixed means some values are
    all digits and some are not.
    """
    items = F.col(values)
    lengths = F.transform(items, lambda v: F.length(v))

    def digits(v: Column) -> Column:
        return v.rlike("^[0-9]+$")

    def special(v: Column) -> Column:
        return ~v.rlike(r"^[\p{L}\p{N}]+$") & ~v.rlike(r"^\s+$")

    def some(test) -> Column:
        return F.coalesce(F.exists(items, test), F.lit(False))

    return df.withColumns(
        {
            "max_length": F.coalesce(F.array_max(lengths), F.lit(0)),
            "min_length": F.coalesce(F.array_min(lengths), F.lit(0)),
            "leading_zeros": some(lambda v: v.startswith("0") & (F.length(v) > 1)),
            "special_chars": some(special),
            "mixed_types": some(digits) & some(lambda v: ~digits(v)),
        }
    )


def null_ratio(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Nulls and their share of all rows per column, in one pass without a shuffle of rows."""
    columns = df.columns if columns is None else list(columns)
    counts = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(c)).alias(c) for c in columns])
    total = F.col("__rows")
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            (total - F.col(c)).alias("n_null"),
            F.coalesce((total - F.col(c)) / F.nullif(total, F.lit(0)), F.lit(0.0)).alias("ratio"),
        )
        for c in columns
    ]
    return counts.select(F.inline(F.array(*rows)))


def top_values(df: DataFrame, columns: Iterable[str] | None = None, k: int = TOP_VALUES) -> DataFrame:
    """Distinct count and the ``k`` most frequent values per column; ties go to the smaller value."""
    counts = value_counts(df, columns).filter(F.col("value").isNotNull())
    # Filtering on ``n`` makes both branches share one shuffle.
    distinct = counts.filter("n > 0").groupBy("column_name").agg(F.count("value").alias("n_distinct"))
    top = _ranked(counts.filter("n > 0"), [F.desc("n"), F.asc("value")], k)
    # One row per column on the broadcast side.
    return top.join(F.broadcast(distinct), "column_name").select(
        "column_name", "n_distinct", "rank", "value", F.col("n").alias("n_rows")
    )


def unique_columns(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Whether each column's values, null included, are all different."""
    counts = value_counts(df, columns)
    return counts.groupBy("column_name").agg((F.max("n") == 1).alias("is_unique"))


def max_lengths(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Longest text per column."""
    columns = list(columns)
    longest = df.agg(*[F.coalesce(F.max(F.length(c)), F.lit(0)).alias(c) for c in columns])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("max_length")) for c in columns]
    return longest.select(F.inline(F.array(*rows)))


def _borders(numbers: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """Per column borders close below and above each wanted quantile, ascending; one row a column."""
    around = sorted({min(max(s + d, 0.0), 1.0) for s in shares for d in (-BRACKET, BRACKET)})
    found = numbers.agg(*[F.percentile_approx(c, around, ACCURACY).alias(c) for c in columns])
    return found.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("borders")) for c in columns])))


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """Interpolated exact quantiles of numeric columns, as (column_name, share, quantile); nothing runs yet.

    Approximate quantiles a little to either side of each wanted one cut the values into slices.
    The sizes of all slices tell for certain which slices hold the wanted ranks, whatever
    the borders, and only the values of these are counted one by one.  Good borders make
    these slices a small part of all values; poor ones cost time, not the result.
    """
    columns = list(columns)
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    values = numbers.unpivot([], columns, "column_name", "value").filter("value IS NOT NULL")
    # One row a column is broadcast.
    borders = F.broadcast(_borders(numbers, columns, shares))
    # Borders one by one instead of a function over the array, which would not be compiled.
    passed = [F.coalesce((F.get("borders", F.lit(i)) < F.col("value")).cast("int"), F.lit(0)) for i in range(2 * len(shares))]
    sliced = values.join(borders, "column_name").select("column_name", "value", reduce(add, passed, F.lit(0)).alias("slice"))
    sizes = sliced.groupBy("column_name", "slice").agg(F.count(F.lit(1)).alias("size"))
    own = Window.partitionBy("column_name")
    upto = F.sum("size").over(own.orderBy("slice"))
    sizes = sizes.select("column_name", "slice", (upto - F.col("size")).alias("before"), upto.alias("upto"), F.sum("size").over(own).alias("n"))
    places = F.array(*[F.struct(F.lit(float(s)).alias("share"), ((F.col("n") - 1) * F.lit(float(s))).alias("at")) for s in shares])
    ranks = sizes.select("column_name", "slice", "before", "upto", F.explode(places).alias("w")).select("*", "w.share", "w.at").drop("w")
    ranks = ranks.select("*", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))).alias("rank")).filter("rank >= before AND rank < upto")
    # As many rows as ranks are wanted are broadcast.
    wanted = F.broadcast(ranks.select("column_name", "slice", "before").distinct())
    inside = sliced.join(wanted, ["column_name", "slice"]).groupBy("column_name", "slice", "before", "value").agg(F.count(F.lit(1)).alias("n"))
    last = F.col("before") + F.sum("n").over(Window.partitionBy("column_name", "slice").orderBy("value"))
    placed = inside.select("column_name", "slice", "value", (last - F.col("n")).alias("first"), last.alias("last"))
    held = placed.join(F.broadcast(ranks.select("column_name", "slice", "share", "at", "rank")), ["column_name", "slice"]).filter("rank >= first AND rank < last")
    low, high = F.min("value"), F.max("value")
    return held.groupBy("column_name", "share", "at").agg(low.alias("low"), high.alias("high")).select(
        "column_name", "share", (F.col("low") + (F.col("high") - F.col("low")) * (F.col("at") - F.floor("at"))).alias("quantile")
    )


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum per numeric column."""
    summary = df.agg(
        *[
            F.struct(
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("s")) for c in columns]
    basics = summary.select(F.inline(F.array(*rows))).select("column_name", "s.*")
    quartiles = (
        exact_quantiles(df, columns, [0.25, 0.5, 0.75])
        .groupBy("column_name")
        .agg(
            *[
                F.max(F.when(F.col("share") == share, F.col("quantile"))).alias(name)
                for share, name in [(0.25, "q1"), (0.5, "median"), (0.75, "q3")]
            ]
        )
    )
    return basics.join(quartiles, "column_name", "left").select(
        "column_name", "n", "mean", "std", "min", "q1", "median", "q3", "max"
    )


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct count, most frequent value and its frequency per text column."""
    counts = value_counts(df, columns).filter(F.col("value").isNotNull())
    # The most frequent value, the smaller one on ties: maximal n, then minimal value.
    totals = counts.groupBy("column_name").agg(
        F.sum("n").alias("n"), F.count("value").alias("n_distinct"), F.max("n").alias("freq")
    )
    top = _ranked(counts, [F.desc("n"), F.asc("value")], 1).select("column_name", F.col("value").alias("top"))
    return totals.join(F.broadcast(top), "column_name").select("column_name", "n", "n_distinct", "top", "freq")

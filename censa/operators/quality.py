"""Data-quality rules and type suggestions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from censa.functions.dates import is_compact_date
from censa.functions.text import normalize_name, only_digits
from censa.operators.cleaning import text_columns
from censa.operators.profile import boolean_text, iso_date_text, magnitude

MAX_TEXT = 255
FACILITY_DIGITS = 7


def _checked(df: DataFrame, columns: Iterable[str] | None) -> list[str]:
    columns = text_columns(df) if columns is None else list(columns)
    return [c for c in columns if not c.startswith("ERRO_")]


def text_violations(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Non-ASCII values and longest text per text column, in one pass."""
    columns = _checked(df, columns)
    counts = df.agg(
        *[
            F.struct(
                F.count_if(F.col(c).rlike(r"[^\x00-\x7F]")).alias("odd"),
                F.coalesce(F.max(F.length(c)), F.lit(0)).alias("longest"),
            ).alias(c)
            for c in columns
        ]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(c).odd.alias("n_non_ascii"),
            F.col(c).longest.alias("max_length"),
            (F.col(c).longest > MAX_TEXT).alias("too_long"),
        )
        for c in columns
    ]
    return counts.select(F.inline(F.array(*rows)))


def require_clean_text(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """The frame itself if every text column is ASCII and short enough, else an error."""
    if not _checked(df, columns):
        return df
    bad = text_violations(df, columns).filter("n_non_ascii > 0 OR too_long").collect()
    if bad:
        raise ValueError("text columns break the rules: " + ", ".join(r.column_name for r in bad))
    return df


def date_format_ok(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Whether every present value of a column is a ``yyyyMMdd`` date."""
    columns = list(columns)
    checks = df.agg(
        *[
            F.coalesce(F.bool_and(F.when(F.col(c).isNotNull(), is_compact_date(F.col(c)))), F.lit(True)).alias(c)
            for c in columns
        ]
    )
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("is_date_format")) for c in columns]
    return checks.select(F.inline(F.array(*rows)))


def valid_facility(code: Column) -> Column:
    """Whether a code is seven digits; null is not."""
    return F.coalesce(only_digits(code, FACILITY_DIGITS), F.lit(False))


def profile_problems(profile: DataFrame) -> DataFrame:
    """Profile rows with a required metric missing, with the names of the missing ones."""
    required = ["data_type", "n_distinct", "n_null", "sample", "max_length", "min_length"]
    # An absent column is missing for every row.
    absent = [F.when(F.col(c).isNull(), F.lit(c)) if c in profile.columns else F.lit(c) for c in required]
    missing = F.array_compact(F.array(*absent))
    return profile.select("column_name", missing.alias("missing")).filter(F.size("missing") > 0)


def complete_profile(profile: DataFrame) -> DataFrame:
    """Fill absent profile metrics with their defaults, or from the sample where it tells."""
    sample = F.col("sample")
    defaults = {
        "data_type": F.lit("string"),
        "n_distinct": F.lit(0).cast("long"),
        "n_null": F.lit(0).cast("long"),
        "n_rows": F.lit(None).cast("long"),
        "max_length": F.coalesce(F.array_max(F.transform(sample, F.length)), F.lit(0)),
        "min_length": F.coalesce(F.array_min(F.transform(sample, F.length)), F.lit(0)),
        "leading_zeros": F.exists(sample, lambda v: v.startswith("0") & (F.length(v) > 1)),
        "special_chars": F.lit(False),
        "mixed_types": F.lit(False),
        "all_boolean": (F.size(sample) > 0) & F.forall(sample, boolean_text),
        "all_dates": (F.size(sample) > 0) & F.forall(sample, iso_date_text),
        "largest": F.array_max(F.transform(sample, magnitude)),
    }
    empty = F.array().cast("array<string>")
    filled = profile.withColumn("sample", F.coalesce("sample", empty) if "sample" in profile.columns else empty)
    return filled.withColumns(
        {c: F.coalesce(F.col(c), d) if c in profile.columns else d for c, d in defaults.items()}
    )


def suggested_type() -> Column:
    """SQL type suggested by a profile row; the first rule that applies wins.

    Digits stored as text stay text, so codes never turn into numbers.
    """
    kind, largest = F.col("data_type"), F.col("largest")
    integers = kind.isin("tinyint", "smallint", "int", "bigint")
    fractions = kind.isin("float", "double") | kind.startswith("decimal")
    longest, shortest = F.col("max_length"), F.col("min_length")
    return (
        F.when((F.col("n_null") > 0) & (F.col("n_null") == F.col("n_rows")), F.lit("TEXT"))
        .when(F.col("leading_zeros"), F.lit("TEXT"))
        .when(F.size("sample") == 0, F.lit("TEXT"))
        .when(F.col("all_boolean"), F.lit("BOOLEAN"))
        .when((kind == "date") | F.col("all_dates"), F.lit("DATE"))
        .when(integers & (largest <= 32767), F.lit("SMALLINT"))
        .when(integers & (largest <= 2147483647), F.lit("INTEGER"))
        .when(integers, F.lit("BIGINT"))
        .when(fractions, F.lit("NUMERIC"))
        .when(F.col("mixed_types"), F.lit("TEXT"))
        .when(longest == shortest, F.format_string("CHAR(%d)", longest))
        .when(longest <= MAX_TEXT, F.format_string("VARCHAR(%d)", longest))
        .otherwise(F.lit("TEXT"))
    )


def suggest_types(profile: DataFrame) -> DataFrame:
    """Normalised column name and suggested type for each profiled column."""
    return complete_profile(profile).select(
        F.col("column_name"),
        normalize_name(F.col("column_name")).alias("target_name"),
        suggested_type().alias("suggested_type"),
    )

"""Cleaning of whole frames: trimming, blanks, fills, date columns by name or content."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from censa.functions.dates import is_compact_date, parse_date
from censa.functions.text import blank_to_null

DATE_LIKE_SHARE = 0.8


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def number_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def trim_text(df: DataFrame) -> DataFrame:
    """Trim every text column; null stays null."""
    return df.withColumns({c: F.trim(F.col(c)) for c in text_columns(df)})


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Blank text and missing-value words become null in every text column."""
    return df.withColumns({c: blank_to_null(F.col(c)) for c in text_columns(df)})


def fill_nulls(df: DataFrame) -> DataFrame:
    """Text nulls and blanks become the empty text, numeric nulls zero, after trimming."""
    return trim_text(df).fillna("").fillna(0)


def date_columns_by_name(df: DataFrame) -> list[str]:
    """Text columns whose name says date."""
    return [c for c in text_columns(df) if "DT" in c.upper() or "DATA" in c.upper()]


def clean_frame(df: DataFrame, dates: Iterable[str] | None = None) -> DataFrame:
    """Trim, blank to null, and parse the date columns (by name unless listed)."""
    dates = date_columns_by_name(df) if dates is None else list(dates)
    cleaned = blanks_to_null(df)
    return cleaned.withColumns({c: parse_date(F.col(c)) for c in dates})


def date_likeness(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Share of present values that are ``yyyyMMdd`` dates, per column, in one pass."""
    columns = list(columns) if columns is not None else text_columns(df) + number_columns(df)
    shares = df.agg(
        *[
            F.struct(
                F.count(F.col(c)).alias("n"),
                F.count_if(is_compact_date(F.col(c).cast("string"))).alias("dates"),
            ).alias(c)
            for c in columns
        ]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(c).n.alias("n_present"),
            F.col(c).dates.alias("n_dates"),
            F.coalesce(F.col(c).dates / F.nullif(F.col(c).n, F.lit(0)) > DATE_LIKE_SHARE, F.lit(False))
            .alias("is_date"),
        )
        for c in columns
    ]
    return shares.select(F.inline(F.array(*rows)))


def date_columns_by_content(df: DataFrame, columns: Iterable[str] | None = None) -> list[str]:
    """Columns more than four fifths of whose values are dates (one row per column read)."""
    found = date_likeness(df, columns).filter("is_date").select("column_name").collect()
    return [row.column_name for row in found]


def preprocess(df: DataFrame, dates: Iterable[str] | None = None) -> DataFrame:
    """Parse date-like columns, trim, and fill what is missing."""
    dates = date_columns_by_content(df) if dates is None else list(dates)
    parsed = df.withColumns({c: parse_date(F.col(c).cast("string")) for c in dates})
    return fill_nulls(parsed)

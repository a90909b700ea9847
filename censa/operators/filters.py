"""Row and column selection of an extraction."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from censa.operators.cleaning import text_columns
from censa.registry.groups import ALL_FACILITIES


def project(df: DataFrame, fields: Iterable[str], facility: str) -> DataFrame:
    """The requested fields, and the facility column if it is not among them."""
    fields = list(fields)
    if facility.lower() not in {f.lower() for f in fields}:
        fields.append(facility)
    return df.select(*fields)


def keep_facilities(df: DataFrame, facility: str, codes: list[str]) -> DataFrame:
    """Rows of the listed facilities; ``["*"]`` keeps all."""
    if codes == ALL_FACILITIES:
        return df
    if facility.lower() not in {c.lower() for c in df.columns}:
        raise KeyError(f"column {facility} is not in the frame")
    return df.filter(F.col(facility).isin(codes))


def in_months(c: str, first: date, last: date) -> Column:
    """Whether a date or timestamp column lies in the months ``first`` to ``last``.

    Written as a half-open range on the bare column, so that it reaches the scan.
    """
    after = date(last.year + last.month // 12, last.month % 12 + 1, 1)
    return (F.col(c) >= F.lit(first.replace(day=1))) & (F.col(c) < F.lit(after))


def any_text(df: DataFrame) -> Column:
    """Whether at least one text column is not empty."""
    tests = [F.coalesce(F.length(c) > 0, F.lit(False)) for c in text_columns(df)]
    return reduce(or_, tests, F.lit(False))


def text_statistics(df: DataFrame) -> DataFrame:
    """Rows in all, and rows with at least one non-empty text."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(any_text(df)).alias("rows_with_text"),
    )


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows with a null in any of ``columns``."""
    return df.dropna(subset=columns)

"""Dates written as text and periods taken from file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Two-digit years from this one on belong to the last century.
CENTURY_PIVOT = 90


# Fixed patterns: dates with a possible month and a possible day.
COMPACT_DATE = "^(?!0000)[0-9]{4}(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])$"
ISO_DATE = "^(?!0000)[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$"


def _from_compact(text: Column) -> Column:
    """Date of eight digits, null when that is no date.

    The pattern lets only 30 and 31 in short months through to the cast.  A date
    parser would throw and catch an exception for each other bad value, which costs
    more than everything else on a column with many of them.
    """
    iso = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    return F.when(text.rlike(COMPACT_DATE), iso.try_cast("date"))


def date_of(text: Column) -> Column:
    """Date of trimmed ``yyyyMMdd`` or ISO text; anything else is null."""
    return F.coalesce(_from_compact(text), F.when(text.rlike(ISO_DATE), text.try_cast("date")))


def parse_date(c: Column) -> Column:
    """The same for text with blanks around it."""
    return date_of(F.trim(c))


def is_compact_date(c: Column) -> Column:
    """Whether the text is eight characters that form a ``yyyyMMdd`` date."""
    return _from_compact(c).isNotNull()


def full_year(yy: Column) -> Column:
    """Four-digit year of a two-digit one."""
    return yy + F.when(yy >= CENTURY_PIVOT, 1900).otherwise(2000)


def period_start(yymm: Column) -> Column:
    """First day of the month written as ``yymm``; null when that is no month."""
    digits = F.when(yymm.rlike("^[0-9]{2}(0[1-9]|1[0-2])$"), yymm)
    year = full_year(F.substring(digits, 1, 2).cast("int"))
    return F.make_date(year, F.substring(digits, 3, 2).cast("int"), F.lit(1))


def month_of(c: Column) -> Column:
    """First day of the month of a date or timestamp."""
    return F.trunc(c.cast("date"), "month")


def months_between(first: Column, last: Column) -> Column:
    """Every month start from ``first`` to ``last``, both included."""
    return F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))

"""Conversion of one padded text column to its declared type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from censa.functions.dates import date_of
from censa.functions.text import blank_to_null
from censa.registry.types import spark_type

# Fixed value: the text of an error flag.
ERROR_TEXT = "ERRO_TIPO"


def to_boolean(c: Column, rule: str = "map") -> Column:
    """Boolean of text.

    ``map``: True/1 and False/0, else null.  ``truthy``: everything but 0, false
    and f is true.  ``cast``: what Spark reads as a boolean, else null.
    """
    text = F.trim(c)
    if rule == "map":
        return F.when(text.isin("True", "1"), True).when(text.isin("False", "0"), False)
    if rule == "truthy":
        return F.when(c.isNotNull(), ~F.lower(text).isin("0", "false", "f"))
    if rule == "cast":
        return text.try_cast("boolean")
    raise ValueError(f"unknown boolean rule {rule}")


# Fixed patterns: texts the integer and decimal casts accept.
SHORT_INTEGER = "^[+-]?[0-9]{1,18}$"
LONG_INTEGER = "^[+-]?[0-9]{19,}$"
DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# Bits of the integer types narrower than bigint.
INTEGER_BITS = {"smallint": 16, "int": 32}


def wide_value(text: Column, declared: str, boolean_rule: str = "map") -> Column:
    """First half of a conversion: prepared text as the declared type, integers still as bigint.

    A failing cast throws and catches an exception per value, so what can be told
    by pattern is kept away from it.
    """
    target = spark_type(declared)
    if isinstance(target, T.StringType):
        return text
    if isinstance(target, T.DateType):
        return date_of(text)
    if isinstance(target, T.BooleanType):
        return to_boolean(text, boolean_rule)
    if isinstance(target, T.IntegralType):
        number = text.try_cast("bigint")
        return F.when(text.rlike(SHORT_INTEGER), number).when(text.rlike(LONG_INTEGER), number)
    if isinstance(target, (T.DecimalType, T.DoubleType)):
        return F.when(text.rlike(DECIMAL), text.try_cast(target))
    return text.try_cast(target)


def narrow_value(wide: Column, declared: str) -> Column:
    """Second half: integers cut to their declared range, null outside it."""
    kind = spark_type(declared).simpleString()
    if kind not in INTEGER_BITS:
        return wide
    top = 1 << (INTEGER_BITS[kind] - 1)
    return F.when(wide.between(-top, top - 1), wide.cast(kind))


def lost(text: Column, value: Column, declared: str, strict_digits: bool = False) -> Column:
    """Whether prepared text is present but its converted value is not.

    ``strict_digits`` instead calls every NUMERIC text with a non-digit an error.
    """
    target = spark_type(declared)
    if isinstance(target, T.StringType):
        return F.lit(False)
    if strict_digits and isinstance(target, T.DecimalType):
        return F.coalesce(text.rlike("[^0-9]"), F.lit(False))
    return text.isNotNull() & value.isNull()


def to_type(c: Column, declared: str, boolean_rule: str = "map") -> Column:
    """Value of raw text as the declared type."""
    return narrow_value(wide_value(blank_to_null(c), declared, boolean_rule), declared)


def error_flag(failed: Column) -> Column:
    """``ERRO_TIPO`` on failing rows, else null."""
    return F.when(failed, F.lit(ERROR_TEXT))

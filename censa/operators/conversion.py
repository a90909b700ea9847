"""Typed conversion of raw text frames, with flags or copies of what did not fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from censa.functions.convert import error_flag, lost, narrow_value, wide_value
from censa.functions.text import blank_to_null
from censa.registry.types import spark_type


def declared_type(types: dict[str, str], column: str) -> str:
    """Declared type of a column in any case; undeclared columns are text."""
    return {c.lower(): t for c, t in types.items()}.get(column.lower(), "TEXT")


def error_name(column: str) -> str:
    return f"new_{column}_error"


def _staged(df: DataFrame, types: dict[str, str], columns: list[str], boolean_rule: str) -> DataFrame:
    """Add prepared text ``__text_<i>`` and wide value ``__wide_<i>`` of each column.

    Two projections on top of each other: each text is prepared once and each value
    parsed once, however often the later expressions use them.
    """
    prepared = df.select(
        "*", *[blank_to_null(F.col(c).cast("string")).alias(f"__text_{i}") for i, c in enumerate(columns)]
    )
    return prepared.select(
        "*",
        *[
            wide_value(F.col(f"__text_{i}"), declared_type(types, c), boolean_rule).alias(f"__wide_{i}")
            for i, c in enumerate(columns)
        ],
    )


def _values(types: dict[str, str], columns: list[str]) -> dict[str, Column]:
    """Converted value per column of ``_staged``."""
    return {c: narrow_value(F.col(f"__wide_{i}"), declared_type(types, c)) for i, c in enumerate(columns)}


def _lost(types: dict[str, str], columns: list[str], strict_digits: bool) -> dict[str, Column]:
    """Per column, whether a present text was lost by the conversion of ``_staged``."""
    value = _values(types, columns)
    return {
        c: lost(F.col(f"__text_{i}"), value[c], declared_type(types, c), strict_digits)
        for i, c in enumerate(columns)
    }


def convert_with_errors(
    df: DataFrame, types: dict[str, str], boolean_rule: str = "map", strict_digits: bool = False
) -> DataFrame:
    """Every column as its declared type, each followed by its error flag column."""
    staged = _staged(df, types, df.columns, boolean_rule)
    value = _values(types, df.columns)
    failed = _lost(types, df.columns, strict_digits)
    selected = []
    for c in df.columns:
        selected.append(value[c].alias(c))
        selected.append(error_flag(failed[c]).alias(error_name(c)))
    return staged.select(*selected)


def error_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("new_") and c.endswith("_error")]


def error_counts(df: DataFrame) -> DataFrame:
    """Errors per converted column, all counted in one pass."""
    names = error_columns(df)
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in names])
    rows = [F.struct(F.lit(c).alias("error_column"), F.col(c).alias("n_errors")) for c in names]
    return counts.select(F.inline(F.array(*rows)))


def convert_quarantine(
    df: DataFrame, types: dict[str, str], boolean_rule: str = "map", strict_digits: bool = False
) -> DataFrame:
    """Convert and keep the values that failed, row by row, in ``new_<column>``."""
    columns = [c for c in df.columns if _is_declared(types, c)]
    staged = _staged(df, types, columns, boolean_rule)
    failed = _lost(types, columns, strict_digits)
    value = {c: v.alias(c) for c, v in _values(types, columns).items()}
    kept = [F.when(failed[c], F.col(c)).alias(f"new_{c}") for c in columns]
    return staged.select(*[value.get(c, F.col(c)) for c in df.columns], *kept)


def both_forms(
    df: DataFrame, types: dict[str, str], failures: Observation, boolean_rule: str = "map", strict_digits: bool = False
) -> DataFrame:
    """Declared columns converted, and as they were in ``new_<column>``; ``failures`` counts per column what fails."""
    columns = [c for c in df.columns if _is_declared(types, c)]
    staged = _staged(df, types, columns, boolean_rule)
    failed = _lost(types, columns, strict_digits)
    seen = staged.observe(failures, F.count(F.lit(1)).alias("__rows"), *[F.count_if(failed[c]).alias(c) for c in columns])
    value = {c: v.alias(c) for c, v in _values(types, columns).items()}
    return seen.select(*[value.get(c, F.col(c)) for c in df.columns], *[F.col(c).alias(f"new_{c}") for c in columns])


def convert_loader(df: DataFrame, types: dict[str, str], boolean_rule: str = "map") -> DataFrame:
    """Declared columns converted, what does not fit null; other columns untouched."""
    columns = [c for c in df.columns if _is_declared(types, c)]
    value = {c: v.alias(c) for c, v in _values(types, columns).items()}
    return _staged(df, types, columns, boolean_rule).select(*[value.get(c, F.col(c)) for c in df.columns])


def convert_strict(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Declared columns converted; the first value that does not fit fails the job."""
    columns = [c for c in df.columns if _is_declared(types, c)]
    staged = _staged(df, types, columns, "map")
    failed = _lost(types, columns, strict_digits=False)
    converted, value = _values(types, columns), {}
    for i, c in enumerate(columns):
        declared = declared_type(types, c)
        message = F.concat(F.lit(f"{c} is no {declared}: "), F.col(f"__text_{i}"))
        stop = F.raise_error(message).cast(spark_type(declared))
        value[c] = F.when(failed[c], stop).otherwise(converted[c]).alias(c)
    return staged.select(*[value.get(c, F.col(c)) for c in df.columns])


def alter_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Change the types of the listed columns, failing on values that do not fit."""
    return convert_strict(df, types)


def silent_nulls(
    raw: DataFrame, types: dict[str, str], boolean_rule: str = "map", strict_digits: bool = False
) -> DataFrame:
    """Per column, values that were present, came out null, and carry no error flag."""
    columns = [c for c in raw.columns if _is_declared(types, c)]
    staged = _staged(raw, types, columns, boolean_rule)
    flagged = _lost(types, columns, strict_digits)
    gone = _lost(types, columns, strict_digits=False)
    counts = [F.count_if(gone[c] & ~flagged[c]).alias(c) for c in columns]
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_silent")) for c in columns]
    return staged.agg(*counts).select(F.inline(F.array(*rows)))


def _is_declared(types: dict[str, str], column: str) -> bool:
    return column.lower() in {c.lower() for c in types}

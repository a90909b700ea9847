"""Column sets: names, order, missing and surplus columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censa.functions.text import normalized
from censa.registry.types import spark_type, struct_of

# The columns every loaded table carries.
SERVICE_COLUMNS = {"id": "SERIAL PRIMARY KEY", "id_log": "VARCHAR(255)", "uf": "CHAR(2)"}


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case column names, without the padding some raw names carry."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().upper() for c in df.columns])


def normalize_names(df: DataFrame, per_character: bool = False) -> DataFrame:
    """Identifier form of every column name."""
    return df.toDF(*[normalized(c, per_character) for c in df.columns])


def add_missing(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Add declared columns the frame lacks, as typed nulls."""
    present = {c.lower() for c in df.columns}
    absent = {c: t for c, t in types.items() if c.lower() not in present}
    return df.withColumns({c: F.lit(None).cast(spark_type(t)) for c, t in absent.items()})


def drop_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop columns, ignoring those that are not there."""
    return df.drop(*columns)


def align(df: DataFrame, types: dict[str, str], extra: Iterable[str] = ()) -> DataFrame:
    """Exactly the declared columns in declared order, then ``extra``."""
    return add_missing(df, types).select(*types, *[c for c in extra if c not in types])


def rename_present(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the columns that are there."""
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def sorted_columns(df: DataFrame, service: bool = True) -> DataFrame:
    """Columns in alphabetical order, service columns included."""
    wide = add_missing(df, SERVICE_COLUMNS) if service else df
    return wide.select(*sorted(wide.columns))


def common_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """Columns both frames have, lower-cased and sorted."""
    return sorted({c.lower() for c in a.columns} & {c.lower() for c in b.columns})


def evolve(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows of both, in the columns of the target plus the new ones of the incoming frame."""
    return target.unionByName(incoming, allowMissingColumns=True)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames over the union of their columns."""
    first, *rest = frames
    for other in rest:
        first = evolve(first, other)
    return first


def keep_originals(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Copy each declared column to ``new_<column>``."""
    declared = {c.lower() for c in types}
    return df.withColumns({f"new_{c}": F.col(c) for c in df.columns if c.lower() in declared})


def empty_columns(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """Which of ``columns`` hold only nulls, found in one pass."""
    columns = list(columns)
    if not columns:
        return []
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in columns]).first()
    return [c for c in columns if counts[c] == 0]


def drop_empty_columns(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Drop error columns without a single error."""
    if columns is None:
        columns = [c for c in df.columns if c.startswith("new_") and c.endswith("_error")]
    return df.drop(*empty_columns(df, columns))


def matches_types(df: DataFrame, types: dict[str, str]) -> bool:
    """Whether every declared column is there with its declared type."""
    actual = {f.name.lower(): f.dataType for f in df.schema.fields}
    return all(actual.get(f.name.lower()) == f.dataType for f in struct_of(types).fields)


def describe_columns(df: DataFrame) -> DataFrame:
    """One row per column: position, name, Spark type, declared type, non-null values."""
    from censa.registry.types import sql_type

    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("spark_type"),
            F.lit(sql_type(f.dataType)).alias("sql_type"),
            F.col(f.name).alias("n_present"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*rows)))

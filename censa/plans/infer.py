"""From raw files to a typed table definition: profile, suggest types, DDL, registry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censa.functions.text import normalize_name, normalized
from censa.operators.joins import first_contained
from censa.operators.profile import column_profile
from censa.operators.quality import suggest_types
from censa.operators.schema import SERVICE_COLUMNS
from censa.registry.groups import GROUP_DESCRIPTIONS
from censa.registry.types import create_table_text


def infer_types(df: DataFrame, service: bool = True) -> dict[str, str]:
    """Suggested type map of a frame, in alphabetical order (one row per column read)."""
    rows = suggest_types(column_profile(df)).select("target_name", "suggested_type").collect()
    types = {r.target_name: r.suggested_type for r in rows}
    return dict(sorted({**types, **(SERVICE_COLUMNS if service else {})}.items()))


def infer_tables(spark: SparkSession, sources: dict[str, str]) -> dict[str, dict[str, str]]:
    """Type map per table of ``{table name: parquet path}``."""
    return {normalized(name): infer_types(spark.read.parquet(path)) for name, path in sources.items()}


def table_definitions(tables: dict[str, dict[str, str]]) -> str:
    """CREATE TABLE text of all tables."""
    return "\n".join(create_table_text(name, types) for name, types in tables.items())


def group_patterns(descriptions: dict[str, str] | None = None) -> list[tuple[str, str]]:
    """(normalised description, group code) in registry order."""
    return [(normalized(text), code) for code, text in (descriptions or GROUP_DESCRIPTIONS).items()]


def build_registry(
    columns: DataFrame, patterns: Sequence[tuple[str, str]] | None = None
) -> DataFrame:
    """Group registry from (table_name, column_name) rows.

    A table belongs to the first group whose description its name contains; the
    columns of a group's tables are merged, without ``id``.  The table name of the
    group is the first in name order.  Rows are few per table: one per column.
    """
    named = columns.withColumn("table_key", normalize_name(F.col("table_name")))
    matched = first_contained(named, "table_key", patterns or group_patterns(), "group_code")
    return (
        matched.filter(F.col("column_name") != "id")
        .groupBy("group_code")
        .agg(
            F.min("table_key").alias("table_name"),
            F.array_sort(F.collect_set("column_name")).alias("columns"),
        )
    )

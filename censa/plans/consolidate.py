"""Consolidation: several groups, years and months of one state in one table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censa.registry.groups import invalid_groups
from censa.sinks.tables import create_or_append
from censa.sources.drift import union_widest
from censa.sources.files import scan_folders


def consolidated(
    spark: SparkSession, root: str, base: str, years: Sequence[int], months: Sequence[int], groups: Sequence[str], states: Sequence[str]
) -> DataFrame | None:
    """Rows of all groups for the years and months, with their ``group``; nothing where no folder is there.

    Unknown groups are an error.  Groups differ in columns and
    their types; absent ones are null.
    """
    unknown = invalid_groups(groups, base)
    if unknown:
        raise ValueError(f"groups not published by {base}: {unknown}")
    wanted = [date(year, month, 1) for year in years for month in months]
    frames = []
    for group in dict.fromkeys(groups):
        try:
            rows = scan_folders(spark, root, base, group, wanted, states, required=True)
        except FileNotFoundError:
            continue
        frames.append(rows.withColumn("group", F.lit(group)))
    return union_widest(frames) if frames else None


def consolidate(spark: SparkSession, table: str, *arguments, path: str | None = None) -> bool:
    """Append what ``consolidated`` finds to a table, made on first use; whether there was anything."""
    rows = consolidated(spark, *arguments)
    if rows is None:
        return False
    create_or_append(rows, table, path)
    return True

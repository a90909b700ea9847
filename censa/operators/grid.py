"""Expected states and months of a group, against what is there."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censa.functions.dates import months_between
from censa.registry.groups import STATES, invalid_groups


def month_grid(keys: DataFrame, first: date, last: date) -> DataFrame:
    """Every key with every month from ``first`` to ``last``; none if ``last`` is earlier."""
    if last < first:
        return keys.limit(0).withColumn("month", F.lit(None).cast("date"))
    return keys.withColumn("month", F.explode(months_between(F.lit(first), F.lit(last))))


def expected_folders(spark: SparkSession, group: str, states: Sequence[str], first: date, last: date) -> DataFrame:
    """``group``, ``state``, ``month`` and folder ``name`` of all folders a period should have."""
    unknown = sorted(set(states) - set(STATES))
    if unknown or all(invalid_groups([group], base) for base in ("SIH", "SIA")):
        raise ValueError(f"unknown group {group} or states {unknown}")
    keys = spark.createDataFrame([(group, s) for s in dict.fromkeys(states)], "group string, state string")
    name = F.concat("group", "state", F.date_format("month", "yyMM"), F.lit(".parquet"))
    return month_grid(keys, first, last).withColumn("name", name)


def counted_on(grid: DataFrame, seen: DataFrame, on: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """The grid with the counts of ``seen``, zero where it has none."""
    return grid.join(seen, list(on), "left").fillna(0, list(counts))


def absent(grid: DataFrame, seen: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of the grid that ``seen`` does not hold."""
    return grid.join(seen.select(*on), list(on), "left_anti")

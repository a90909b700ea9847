"""Ledger of processed ``group-year-month`` keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from censa.operators.joins import anti_join
from censa.plans.load import stored

KEY = "progress_key"


def progress_key(group: Column, year: Column, month: Column) -> Column:
    return F.concat_ws("-", group, year.cast("string"), month.cast("string"))


def not_processed(keys: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Keys the ledger lacks."""
    distinct = keys.select(KEY).distinct()
    return distinct if ledger is None else anti_join(distinct, ledger, KEY)


def record(spark: SparkSession, keys: DataFrame, path: str) -> DataFrame:
    """Append the keys that are new to the ledger and return the whole ledger."""
    not_processed(keys, stored(spark, path)).write.mode("append").parquet(path)
    return spark.read.parquet(path)

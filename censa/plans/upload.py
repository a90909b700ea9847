"""Direct upload of parquet files into one table, widened as new columns appear."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from censa.operators.schema import normalize_names
from censa.sinks.files import write_partitioned
from censa.sinks.tables import create_or_append, evolve_and_append
from censa.sources.files import read_concat


def upload(spark: SparkSession, paths: list[str], table: str) -> DataFrame:
    """Append the files to the table, adding columns it lacks."""
    df = normalize_names(read_concat(spark, *paths, merge_schema=True))
    if spark.catalog.tableExists(table):
        evolve_and_append(df, table)
    else:
        create_or_append(df, table)
    return spark.table(table)


def partition_table(spark: SparkSession, table: str, path: str, column: str = "uf") -> DataFrame:
    """The table's rows laid out in one folder per state."""
    write_partitioned(spark.table(table), path, [column])
    return spark.read.parquet(path)

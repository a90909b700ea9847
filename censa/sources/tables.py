"""Catalog and JDBC tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def run_query(spark: SparkSession, query: str, params: dict | None = None, **frames: DataFrame) -> DataFrame:
    """A parameterised SQL query; values go in as ``:name``, frames as ``{name}``."""
    return spark.sql(query, args=params or {}, **frames)


def table_or_none(spark: SparkSession, table: str) -> DataFrame | None:
    """A catalog table, or nothing when it does not exist."""
    return spark.table(table) if spark.catalog.tableExists(table) else None


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 32,
    **properties: str,
) -> DataFrame:
    """A database table, read in parallel slices of ``key`` when its bounds are given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if key and bounds:
        reader = (
            reader.option("partitionColumn", key)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.load()

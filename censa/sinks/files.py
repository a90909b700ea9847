"""File sinks: partitioned parquet, CSV, JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from censa.session import remove_folder, scratch_path


def balanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring equal keys together in tasks of even size.

    The rebalance hint lets Spark split a key that is too large for one task (one
    state may hold a third of all rows) and merge the small ones.
    """
    keys = ", ".join(f"`{c}`" for c in columns)
    return df.sparkSession.sql(f"SELECT /*+ REBALANCE({keys}) */ * FROM {{rows}}", rows=df)


def write_partitioned(
    df: DataFrame, path: str, columns: Sequence[str] = ("uf",), mode: str = "overwrite", shuffle: bool = True
) -> None:
    """Parquet folders per key value, in few files of even size.

    Rows that come grouped by key, as from one source folder per key, need no shuffle.
    """
    rows = balanced(df, columns) if shuffle else df
    rows.write.mode(mode).partitionBy(*columns).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header in every file."""
    df.write.mode("overwrite").option("header", True).csv(path)


def export_chunks(df: DataFrame, path: str, lines: int) -> None:
    """CSV in folders ``chunk=<k>`` of one file with exactly ``lines`` rows (the last may have fewer), in the frame's order.

    The header is repeated in each file.  The rows are written once as Parquet, where each knows its
    place in its file; the sizes of the files before it give its number in the whole frame.
    """
    spark = df.sparkSession
    whole = scratch_path(spark, "chunks")
    df.write.parquet(whole)
    rows = spark.read.schema(df.schema).parquet(whole)
    # Files are named by task and, within a task, by a running number.
    name = F.col("_metadata.file_name")
    task, part = (F.regexp_extract(name, r"^part-([0-9]+)-.*-c([0-9]+)[.]", k).cast("long") for k in (1, 2))
    rows = rows.select("*", task.alias("__task"), part.alias("__part"), F.col("_metadata.row_index").alias("__row"))
    sizes = rows.groupBy("__task", "__part").agg(F.count(F.lit(1)).alias("__size"))
    earlier = Window.orderBy("__task", "__part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("__task", "__part", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__before"))
    # One row a file of the frame: the window and the broadcast are as small as the number of its tasks.
    line = F.col("__before") + F.col("__row")
    numbered = rows.join(F.broadcast(before), ["__task", "__part"]).withColumn("__line", line)
    chunked = numbered.withColumn("chunk", F.floor(F.col("__line") / lines)).drop("__task", "__part", "__row", "__before")
    ordered = chunked.repartition("chunk").sortWithinPartitions("chunk", "__line").drop("__line")
    ordered.write.mode("overwrite").partitionBy("chunk").option("header", True).csv(path)
    remove_folder(spark, whole)


def export_report(report: DataFrame, path: str, per_hospital: bool = True) -> None:
    """Report as CSV folders per year and hospital, or per year with hospitals in order.

    Thousands of hospitals make as many small files; one folder per year avoids them.
    """
    folders = ["year", "hospital"] if per_hospital else ["year"]
    order = ["year", "hospital", "procedure_group", "procedure"]
    ordered = balanced(report, folders).sortWithinPartitions(*order)
    ordered.write.mode("overwrite").partitionBy(*folders).option("header", True).csv(path)


def export_profile(profile: DataFrame, path: str) -> None:
    """Profile as JSON lines; one row per column, so one file is enough."""
    profile.coalesce(1).write.mode("overwrite").json(path)


def compact(df: DataFrame, path: str) -> None:
    """Rewrite many small files of differing schemas as few of even size.

    An empty key list leaves the split to Spark's advisory partition size.
    """
    even = df.sparkSession.sql("SELECT /*+ REBALANCE */ * FROM {rows}", rows=df)
    even.write.mode("overwrite").parquet(path)

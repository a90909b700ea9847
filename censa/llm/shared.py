"""What the operators share: tables, tables kept in the shared folder, text batches, numbering."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from censa.session import remove_folder, scratch_path, shared_folder

#: Text handed to one step of Python code, in bytes; a longer text is a step of its own.
STEP_BYTES = 2 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shipped(spark: SparkSession) -> None:
    """Hand this package to the executors, once for each application, as ``--py-files`` would."""
    package = Path(__file__).resolve().parent.parent
    context = spark.sparkContext
    if getattr(context, "_censa_shipped", None) != context.applicationId:
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        context.addPyFile(archive)
        context._censa_shipped = context.applicationId


def kept(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there.

    Later steps do not repeat what made the rows, and values that depend on how the
    rows were dealt to tasks (row numbers) stay as they are when executors are lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{_kept_folder(spark)}/{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _kept_folder(spark: SparkSession) -> str:
    return f"kept-{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Delete all kept tables of this application, once its results are written; frames that read them are void after that."""
    remove_folder(spark, f"{shared_folder(spark).rstrip('/')}/{_kept_folder(spark)}")


def steps(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Batches cut to at most STEP_BYTES of text, with the texts (null: empty)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for at, size in enumerate(sizes):
            if held and held + size > STEP_BYTES:
                part = batch.slice(start, at - start)
                yield part, [t or "" for t in part.column(column).to_pylist()]
                start, held = at, 0
            held += size
        if start < len(sizes):
            part = batch.slice(start)
            yield part, [t or "" for t in part.column(column).to_pylist()]


def width(spark: SparkSession) -> int:
    """Partitions of a shuffle, as the session says."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """``name``: gapless numbers from 0 within each ``group``, however large one group is.

    The rows of a group are dealt to as many parts as a shuffle has; each part is
    numbered for itself and moved up by the rows of the parts before it.  Only counts by
    group and part are gathered by group.  ``df`` must be cheap to read twice (kept).
    """
    parts = width(df.sparkSession)
    dealt = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        dealt.groupBy(group, "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inside = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*order)) - 1
    return (
        dealt.withColumn("_inside", inside)
        .join(bases, [group, "_part"])
        .withColumn(name, (F.col("_base") + F.col("_inside")).cast("long"))
        .drop("_part", "_inside", "_base")
    )

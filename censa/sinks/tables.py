"""Table sinks: publish, append, empty copies, schema change, swap, reconcile."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from censa.operators.schema import add_missing
from censa.registry.types import spark_type, struct_of, text_length, types_of
from censa.sinks import generations
from censa.sinks.generations import swap  # noqa: F401  part of this module's interface
from censa.sources.tables import read_jdbc

JDBC_BATCH = 10_000


class CountMismatch(RuntimeError):
    """Source and target hold different numbers of rows."""


def reconcile(source_rows: int, target_rows: int) -> int:
    """The common row count; different counts are an error."""
    if source_rows != target_rows:
        raise CountMismatch(f"source has {source_rows} rows, target {target_rows}")
    return target_rows


def typed(df: DataFrame, types: dict[str, str] | None) -> DataFrame:
    """Declared columns cast to their declared types, others as they are."""
    declared = {c.lower(): t for c, t in (types or {}).items()}
    return df.select(
        *[F.col(c).cast(spark_type(declared[c.lower()])).alias(c) if c.lower() in declared else F.col(c)
          for c in df.columns]
    )


def register(spark: SparkSession, table: str, path: str, schema: T.StructType, root: str | None = None) -> None:
    """Let a published table show parquet files; columns may be fewer than in the files.

    The files are a complete generation before the name shows them.  Of the generations
    it showed before, the last one stays; folders of older ones below ``root`` are deleted.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    newest = generations.new_generation(spark, table)
    spark.sql(f"CREATE TABLE {newest} ({columns}) USING parquet LOCATION '{path}'")
    generations.show(spark, table, newest)
    generations.retire(spark, table, root)


@dataclass
class Published:
    """A published table, its row count, and the values in each optional column."""

    table: DataFrame
    n_rows: int
    values: dict[str, int]


def publish(
    df: DataFrame,
    table: str,
    root: str,
    types: dict[str, str] | None = None,
    optional: Sequence[str] = (),
) -> Published:
    """Replace ``table`` by the frame in one pass over it, and verify the count.

    The rows go to a fresh folder below ``root``; the table shows them only after the
    counts agree, by one catalog call, so a failed run leaves the old rows and a reader
    never meets a gap.  Row and ``optional`` column counts are observed while writing, and
    optional columns (error flags) without a value are left out of the table.  The rows that were
    replaced stay for the queries that began on them, until the table is replaced again.
    """
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{table.replace('.', '_')}-{uuid.uuid4().hex}"
    seen = Observation(f"publish-{uuid.uuid4().hex}")
    result = typed(df, types)
    result.observe(
        seen, F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(c)).alias(c) for c in optional]
    ).write.mode("errorifexists").parquet(path)
    counts = seen.get
    written = spark.read.schema(result.schema).parquet(path)
    n_rows = reconcile(counts["__rows"], written.count())
    used = [f for f in result.schema.fields if f.name not in optional or counts[f.name] > 0]
    register(spark, table, path, T.StructType(used), root)
    return Published(spark.table(table), n_rows, {c: counts[c] for c in optional})


def append(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> None:
    """Append the rows to an existing table, in its column order, missing columns null."""
    spark = df.sparkSession
    target = spark.table(table)
    names = list(columns or df.columns)
    wanted = {f.name: f.dataType for f in target.schema.fields}
    given = {c.lower(): c for c in names}
    df.select(
        *[
            (F.col(given[c.lower()]) if c.lower() in given else F.lit(None)).cast(t).alias(c)
            for c, t in wanted.items()
        ]
    ).write.insertInto(generations.stored_in(spark, table))


def create_or_append(df: DataFrame, table: str, path: str | None = None) -> None:
    """Append, creating the table on first use."""
    if df.sparkSession.catalog.tableExists(table):
        append(df, table)
    else:
        generations.first_rows(df, table, path)


def empty_like(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Create or replace an empty table with the frame's columns; its rows go to a folder of their own beside ``path``."""
    spark = df.sparkSession
    empty = spark.createDataFrame([], df.schema)
    generations.first_rows(empty, table, f"{path.rstrip('/')}-{uuid.uuid4().hex}" if path else None)
    generations.retire(spark, table)
    return spark.table(table)


def create_from_types(spark: SparkSession, table: str, types: dict[str, str], path: str) -> DataFrame:
    """Create a table from a type map."""
    register(spark, table, path, struct_of(types))
    return spark.table(table)


def add_table_columns(table: str, df: DataFrame) -> list[str]:
    """Add the frame's new columns to the table; stored rows read them as null."""
    spark = df.sparkSession
    present = {c.lower() for c in spark.table(table).columns}
    new = [f for f in df.schema.fields if f.name.lower() not in present]
    if new:
        held = generations.stored_in(spark, table)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {held} ADD COLUMNS ({columns})")
        if held != table:
            generations.show(spark, table, held)
    return [f.name for f in new]


def evolve_and_append(df: DataFrame, table: str) -> None:
    """Widen the table where needed, then append."""
    add_table_columns(table, df)
    append(add_missing(df, types_of(df.sparkSession.table(table))), table)


def write_jdbc(
    df: DataFrame, url: str, table: str, types: dict[str, str] | None = None, mode: str = "append", **properties: str
) -> None:
    """Write to a database table in batches, with declared types and text lengths on creation.

    ``properties`` are connection properties such as ``user``, ``password`` and ``driver``.
    """
    writer = typed(df, types).write.format("jdbc").options(**properties).mode(mode).option("url", url).option("dbtable", table)
    declared = {c.lower(): t for c, t in (types or {}).items()}
    lengths = [f"{c} {declared[c.lower()]}" for c in df.columns if text_length(declared.get(c.lower(), ""))]
    if lengths:
        writer = writer.option("createTableColumnTypes", ", ".join(lengths))
    writer.option("batchsize", JDBC_BATCH).save()


def publish_jdbc(df: DataFrame, url: str, table: str, types: dict[str, str] | None = None, **properties: str) -> int:
    """Replace a database table by the frame and verify the count.

    The rows are counted while they are written; the database counts its own.
    """
    seen = Observation(f"jdbc-{uuid.uuid4().hex}")
    write_jdbc(df.observe(seen, F.count(F.lit(1)).alias("n")), url, table, types, mode="overwrite", **properties)
    stored = read_jdbc(df.sparkSession, url, f"(SELECT COUNT(*) AS n FROM {table}) counted", **properties)
    return reconcile(seen.get["n"], stored.first()[0])


def fresh_name(label: str) -> str:
    """A table name no one uses yet."""
    return f"{label}_{uuid.uuid4().hex}"

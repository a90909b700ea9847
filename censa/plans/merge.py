"""Merge of two versions of a table, typed and re-partitioned by state."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censa.operators.conversion import alter_types
from censa.operators.schema import lower_names
from censa.operators.sets import in_both, merge_distinct
from censa.sinks import generations
from censa.sinks.files import write_partitioned

#: Property of a generation that holds distinct rows in one folder per value of this column.
_MERGED = "merged_by"


@dataclass
class Merged:
    """Distinct common rows of both versions, and the merged frame."""

    duplicates: DataFrame
    merged: DataFrame


def merge_versions(a: DataFrame, b: DataFrame, types: dict[str, str]) -> Merged:
    """Merge over the common columns and convert the listed ones."""
    a, b = lower_names(a), lower_names(b)
    return Merged(in_both(a, b), alter_types(merge_distinct(a, b), types))


def merge_and_partition(
    spark: SparkSession, a: str, b: str, target: str, path: str, types: dict[str, str], state: str
) -> DataFrame:
    """Merge tables ``a`` and ``b`` into table ``target``, one folder per state.

    The new rows are written before any table changes, so ``target`` may be ``a`` or
    ``b``, and ``path`` must be a new folder.
    """
    merged = merge_versions(spark.table(a), spark.table(b), types).merged
    write_partitioned(merged, path, [state], mode="errorifexists")
    _show(spark, target, spark.read.parquet(path), path, state, {})
    return spark.table(target)


def _show(spark: SparkSession, target: str, rows: DataFrame, path: str, state: str, as_before: dict[str | None, str]) -> None:
    """Publish the state folders below ``path`` and, by state, the given folders of earlier generations."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    newest = generations.new_generation(spark, target)
    spark.sql(
        f"CREATE TABLE {newest} ({columns}) USING parquet PARTITIONED BY (`{state}`) LOCATION '{path}' "
        f"TBLPROPERTIES ('{_MERGED}' = '{state}')"
    )
    spark.catalog.recoverPartitions(newest)
    for value, folder in as_before.items():
        spark.sql(f"ALTER TABLE {newest} ADD PARTITION ({_spec(state, value)}) LOCATION '{folder}'")
    generations.show(spark, target, newest)
    # Folders may be shared with later generations, so none is deleted here.
    generations.retire(spark, target)


def _spec(state: str, value: str | None) -> str:
    text = "null" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"`{state}` = {text}"


def state_digests(df: DataFrame, state: str) -> DataFrame:
    """Per state a digest of its rows that does not depend on their order: number, sum and exclusive or of row hashes."""
    row = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    return df.groupBy(state).agg(
        F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(20,0)")).alias("total"), F.bit_xor(row).alias("mix")
    )


def changed_states(held: DataFrame, version: DataFrame, state: str) -> list[str | None]:
    """States of ``version`` whose rows are not those that ``held`` has (one value per state reaches the driver)."""
    old = state_digests(held, state).select(F.col(state).alias("old"), F.struct("n", "total", "mix").alias("before"))
    new = state_digests(version, state).select(F.col(state).alias("new"), F.struct("n", "total", "mix").alias("now"))
    differs = ~F.col("before").eqNullSafe(F.col("now"))
    both = new.join(old, F.col("old").eqNullSafe(F.col("new")), "left")
    return [r.new for r in both.filter(differs).select("new").collect()]


def merge_changed(
    spark: SparkSession, target: str, version: str, path: str, types: dict[str, str], state: str
) -> list[str | None]:
    """Merge ``version`` into a merged table and write only the states whose rows differ; returns these.

    A state of equal digests on both sides, or one the version does not have, keeps its folder.
    The rows are those of the full merge.  Where ``target`` is no result of a merge by
    this state, or its columns would change, the merge is a full one.
    """
    held = generations.generation(spark, target)
    new = lower_names(spark.table(version))
    now = spark.table(target)
    merged_by = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {held}").collect()}.get(_MERGED) if held else None
    if merged_by != state or not set(now.columns) <= set(new.columns):
        merge_and_partition(spark, target, version, target, path, types, state)
        return [r[0] for r in spark.table(target).select(state).distinct().collect()]
    typed = alter_types(new.select(*now.columns), types)
    typed = typed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in now.schema.fields])
    changed = changed_states(now, typed, state)
    if not changed:
        return []
    wanted = F.coalesce(F.col(state).isin([x for x in changed if x is not None]), F.lit(False))
    if None in changed:
        wanted = wanted | F.col(state).isNull()
    merged = merge_distinct(now.filter(wanted), typed.filter(wanted))
    write_partitioned(merged, path, [state], mode="errorifexists")
    folders = {}
    for row in spark.table(held).select(state).distinct().collect():
        if row[0] not in changed:
            described = spark.sql(f"DESCRIBE TABLE EXTENDED {held} PARTITION ({_spec(state, row[0])})").collect()
            folders[row[0]] = next(r.data_type for r in described if r.col_name == "Location")
    _show(spark, target, now, path, state, folders)
    return changed

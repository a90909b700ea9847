"""Streaming load of new group files, each exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from censa.plans.load import LINEAGE, UNKNOWN_STATES, prepare, unknown_states
from censa.registry.schemas import loader_types
from censa.sinks.files import write_partitioned
from censa.sources.files import with_lineage

WITHOUT_STATE = "_without_state"


def load_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: list[str] | None = None,
    group: str | None = None,
    files_per_batch: int = 1000,
    side: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
) -> int:
    """Take up every file that arrived since the last run, then stop; returns the last batch number.

    The stream's checkpoint remembers the files.  Each batch overwrites its own
    folder ``batch=<n>``, so a batch that is run again after a failure replaces its
    rows instead of adding them twice.  ``side`` makes further outputs of each batch, which
    lie in folders of their own below the target under the same batch number.
    """

    def write_batch(batch: DataFrame, number: int) -> None:
        for name, made in (side or {}).items():
            made(batch).write.mode("overwrite").parquet(f"{target}/{name}/batch={number}")
        rows = transform(batch) if transform else batch
        path = f"{target}/batch={number}"
        if partition_by:
            write_partitioned(rows, path, partition_by, shuffle=False)
        else:
            rows.write.mode("overwrite").parquet(path)

    stream = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
    )
    query = (
        with_lineage(stream, group)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    progress = query.lastProgress
    return progress["batchId"] if progress else -1


def without_state(raw: DataFrame) -> DataFrame:
    """Files whose names tell no state, with their rows, which ``prepare`` leaves out."""
    return raw.filter(F.col("uf").isNull()).groupBy("id_arquivo").agg(F.count(F.lit(1)).alias("n_rows"))


def stream_group(spark: SparkSession, source: str, group: str, target: str, checkpoint: str) -> int:
    """Load the new files of a group as ``load_group`` does, remembering files in the checkpoint.

    Raw files are all text; a declared column a file lacks reads as null.  What a batch leaves out is
    counted by file under its batch number: SP rows of unknown states in ``_unknown_states``, rows
    of files without a state in ``_without_state``.
    """
    types = loader_types(group)
    raw = T.StructType([T.StructField(c.upper(), T.StringType()) for c in types if c not in LINEAGE])
    side: dict[str, Callable[[DataFrame], DataFrame]] = {WITHOUT_STATE: without_state}
    if group == "SP":
        side[UNKNOWN_STATES] = lambda batch: unknown_states(batch.filter(F.col("uf").isNotNull()))
    return load_new_files(
        spark, source, raw, target, checkpoint, lambda batch: prepare(batch, group, types), ["uf", "competencia"], group, side=side
    )

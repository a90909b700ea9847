"""Bulk load of raw group folders: only files that are not in the target yet, each load as one commit.

A load writes what it takes up under an id of its own: the files (``_taken/load=<id>``), the rows
(``load=<id>``), SP rows of unknown states (``_unknown_states/load=<id>``).  Last comes one small file
in ``_loads``, and only loads listed there count (``loaded``, ``committed``).  Whatever a load that failed
has left is no part of the target, and the next load deletes it.  One load may run on a target at a time.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censa.functions.text import zero_fill
from censa.operators.cleaning import trim_text
from censa.operators.conversion import convert_loader
from censa.operators.joins import anti_join
from censa.operators.schema import align, drop_present, lower_names
from censa.registry.groups import STATE_CODES
from censa.registry.schemas import loader_types
from censa.session import folder_exists
from censa.sinks.files import write_partitioned
from censa.sources.drift import read_drifting
from censa.sources.files import discover_files, file_id, with_lineage

TAKEN, UNKNOWN_STATES, LOADS = "_taken", "_unknown_states", "_loads"
#: Partition column of everything a load writes.
LOAD = "load"
LINEAGE = ["uf", "competencia", "id_arquivo", "id_log"]


def state_lookup(spark: SparkSession) -> DataFrame:
    """The fixed 27 state codes."""
    return spark.createDataFrame(list(STATE_CODES.items()), "state_code string, state string")


def decode_state(df: DataFrame, column: str) -> DataFrame:
    """Replace a numeric state code by its abbreviation; rows with an unknown code are dropped."""
    coded = df.withColumn("state_code", zero_fill(F.trim(F.col(column)), 2))
    decoded = coded.join(F.broadcast(state_lookup(df.sparkSession)), "state_code")  # 27 rows
    return decoded.withColumn(column, F.col("state")).drop("state", "state_code").select(*df.columns)


def loaded_files(target: DataFrame) -> DataFrame:
    """Files the target holds: by the stored file id, else cut from the lineage key."""
    if "id_arquivo" in target.columns:
        return target.select("id_arquivo").distinct()
    return target.select(file_id(F.col("id_log")).alias("id_arquivo")).distinct()


def prepare(raw: DataFrame, group: str, types: dict[str, str]) -> DataFrame:
    """Raw rows in the group's declared columns and types, with lineage.

    Lineage is taken from file metadata, unless the rows bring all of it along.
    Files without a state in their names are left out.
    """
    own = {c: t for c, t in types.items() if c not in ("id", *LINEAGE)}
    traced = raw if set(LINEAGE) <= set(raw.columns) else with_lineage(raw, group)
    # Set aside under other names, as raw files may hold columns of the same names.
    origin = {f"__{c}": c for c in LINEAGE}
    named = traced.withColumnsRenamed({c: o for o, c in origin.items()})
    named = drop_present(lower_names(named), ["id", *LINEAGE])
    if group == "SP":
        named = decode_state(named, "sp_uf")
        own["sp_uf"] = "CHAR(2)"
    typed = align(convert_loader(trim_text(named), own), own, list(origin))
    return typed.withColumnsRenamed(origin).filter(F.col("uf").isNotNull())


def unknown_states(raw: DataFrame, column: str = "sp_uf") -> DataFrame:
    """State codes that ``decode_state`` drops, with their rows, by file."""
    traced = raw if "id_arquivo" in raw.columns else with_lineage(raw, "SP", ["id_arquivo"])
    named = lower_names(traced)
    coded = named.select("id_arquivo", F.col(column).alias("code"), zero_fill(F.trim(F.col(column)), 2).alias("state_code"))
    lookup = F.broadcast(state_lookup(raw.sparkSession))  # 27 rows
    dropped = coded.join(lookup, "state_code", "left_anti")
    return dropped.groupBy("id_arquivo", "code").agg(F.count(F.lit(1)).alias("n_rows"))


def pending_files(
    spark: SparkSession, source: str, group: str, target: DataFrame | None, taken: DataFrame | None = None
) -> DataFrame:
    """Group files below ``source`` that neither the target nor the list of files taken up holds."""
    files = discover_files(spark, source, group)
    for held in (target, taken):
        if held is not None:
            files = anti_join(files, loaded_files(held), "id_arquivo")
    return files


def committed(spark: SparkSession, target: str, part: str = "") -> DataFrame | None:
    """Rows of all finished loads of the target, or of one of its side folders; nothing before the first."""
    done = stored(spark, f"{target}/{LOADS}", f"n_files long, {LOAD} string")
    rows = stored(spark, f"{target}/{part}" if part else target) if done is not None else None
    if rows is None or LOAD not in rows.columns:
        return None
    return rows.withColumn(LOAD, F.col(LOAD).cast("string")).join(done.select(LOAD), LOAD, "left_semi").drop(LOAD)


def loaded(spark: SparkSession, target: str) -> DataFrame | None:
    """The rows of the target; nothing before the first load."""
    return committed(spark, target)


def _discard_unfinished(spark: SparkSession, target: str) -> None:
    """Delete what loads without a commit have left (a listing of one folder a load)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def loads(folder: str) -> list[str]:
        found = store.globStatus(path(f"{folder}/{LOAD}=*")) or []
        return [f.getPath().getName() for f in found]

    done = set(loads(f"{target}/{LOADS}"))
    for folder in (target, f"{target}/{TAKEN}", f"{target}/{UNKNOWN_STATES}"):
        for name in loads(folder):
            if name not in done:
                store.delete(path(f"{folder}/{name}"), True)


def load_group(spark: SparkSession, source: str, group: str, target: str) -> int:
    """Load the pending files of a group into the target folder as one commit; returns their number.

    The pending files are written to the ledger first and joined from there, so no list of files
    reaches the driver, only the folders they are in (states x months).  Those may hold
    columns in different types.  The types are those the bulk load declares.
    """
    _discard_unfinished(spark, target)
    load = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    files = pending_files(spark, source, group, None, committed(spark, target, TAKEN))
    ledger = f"{target}/{TAKEN}/{LOAD}={load}"
    files.select("id_arquivo", F.regexp_replace("path", "/[^/]*$", "").alias("folder")).write.parquet(ledger)
    pending = spark.read.schema("id_arquivo string, folder string").parquet(ledger)
    folders = sorted(r.folder for r in pending.select("folder").distinct().collect())
    if not folders:
        _discard_unfinished(spark, target)
        return 0
    raw = read_drifting(spark, folders, lambda scan: with_lineage(scan, group))
    # Files of these folders that were taken up before, or are of another group, stay out.
    raw = raw.join(pending.select("id_arquivo"), "id_arquivo", "left_semi")
    # Each source folder is one state and month, so the rows are written where they are read.
    write_partitioned(prepare(raw, group, loader_types(group)), f"{target}/{LOAD}={load}", ["uf", "competencia"], mode="errorifexists", shuffle=False)
    if group == "SP":
        unknown_states(raw).write.parquet(f"{target}/{UNKNOWN_STATES}/{LOAD}={load}")
    n_files = pending.count()
    spark.createDataFrame([(n_files,)], "n_files long").coalesce(1).write.parquet(f"{target}/{LOADS}/{LOAD}={load}")
    return n_files


def stored(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """Frame of a parquet folder, or nothing when it is not there yet.

    With a schema no file is opened to infer one.
    """
    if not folder_exists(spark, path):
        return None
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise

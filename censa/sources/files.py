"""Monthly group folders: ``{base}/{group}/{group}{state}{yymm}[_part].parquet``."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from censa.functions.dates import full_year, period_start
from censa.registry.groups import GROUP_DESCRIPTIONS, STATES, Request
from censa.registry.types import struct_of
from censa.session import scratch_path
from censa.sources.drift import read_drifting

# Fixed pattern: group code, state, two-digit year and month, optional part number.
ANY_STATE = "|".join(STATES)
NAME_PATTERN = rf"(?i)^([A-Z]+?)({ANY_STATE})([0-9]{{4}})(?:_[0-9]+)?\.parquet"
FILE_ID_PATTERN = r"^(.*)_[0-9]+$"


def _segments() -> tuple[Column, Column]:
    """Folder name and file name of the row's file."""
    parts = F.split(F.col("_metadata.file_path"), "/")
    return F.element_at(parts, -2), F.element_at(parts, -1)


def name_part(name: Column, group: str | None, part: int) -> Column:
    """Part 2 (state) or 3 (yymm) of a group file or folder name, null if it does not fit."""
    pattern = NAME_PATTERN if group is None else NAME_PATTERN.replace("[A-Z]+?", group, 1)
    return F.nullif(F.upper(F.regexp_extract(name, pattern, part)), F.lit(""))


def group_start(group: str) -> str:
    """Pattern of a name's start: the group code and, as group 1, a state.

    Only real states count: a data file named ``part-...`` is no ``PA`` file of a state RT.
    Where a longer registered code fits the name too (AM, AMP), the name is that one's.
    """
    longer = [code for code in GROUP_DESCRIPTIONS if code.startswith(group.upper()) and code != group.upper()]
    other = f"(?!(?:{'|'.join(longer)})(?:{ANY_STATE}))" if longer else ""
    return f"(?i)^{other}{group}({ANY_STATE})"


def extract_state(name: Column, group: str) -> Column:
    """State after the group code at the start of a name, any case, else null."""
    return F.nullif(F.upper(F.regexp_extract(name, group_start(group), 1)), F.lit(""))


def file_id(lineage: Column) -> Column:
    """File part of a lineage key ``{folder}_{file}_{row}``."""
    return F.regexp_extract(lineage, FILE_ID_PATTERN, 1)


def lineage_columns(group: str | None = None) -> dict[str, Column]:
    """State, period, file id and lineage key of each row, from the file it is in."""
    folder, file = _segments()
    whole_id = F.concat_ws("_", folder, file)
    yymm = F.coalesce(name_part(file, group, 3), name_part(folder, group, 3))
    states = [name_part(file, group, 2), name_part(folder, group, 2)]
    if group:  # names without a month still tell the state
        states += [extract_state(file, group), extract_state(folder, group)]
    return {
        "uf": F.coalesce(*states),
        "competencia": period_start(yymm),
        "id_arquivo": whole_id,
        "id_log": F.concat_ws("_", whole_id, F.col("_metadata.row_index").cast("string")),
    }


def with_lineage(df: DataFrame, group: str | None = None, columns: Iterable[str] | None = None) -> DataFrame:
    """Add lineage columns (all, or the named ones) to a frame read from files."""
    wanted = lineage_columns(group)
    return df.withColumns({c: wanted[c] for c in (columns or wanted)})


def row_batches(df: DataFrame, size: int = 10_000, out: str = "batch_no") -> DataFrame:
    """Number of the fixed-size batch a row falls in, counted inside its file."""
    return df.withColumn(out, F.floor(F.col("_metadata.row_index") / size))


def folder_glob(root: str, base: str, group: str, states: Sequence[str], months: Sequence[date]) -> str:
    """Glob of the wanted folders and their parts; folders that are not there match nothing."""
    wanted = [",".join(states), ",".join(f"{month:%y%m}" for month in months)]
    return f"{root.rstrip('/')}/{base}/{group}/{group}{{{wanted[0]}}}{{{wanted[1]}}}{{,_*}}.parquet"


def scan_folders(
    spark: SparkSession,
    root: str,
    base: str,
    group: str,
    months: Sequence[date],
    states: Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
    types: dict[str, str] | None = None,
    skip_corrupt: bool = False,
    merge_schema: bool = True,
    required: bool = False,
    each: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Raw rows of the group's folders for the states and months.

    The names select the folders, so Spark lists and opens nothing else.  Months may
    differ in columns and in their types (``read_drifting``); ``merge_schema=False`` spares
    reading all footers where they do not.  ``types`` (column names of the group) gives the schema
    of an empty result; ``required`` makes it an error that no folder is there.  ``each`` is applied
    to every scan, for what needs the files' metadata.
    """
    options = {"ignoreCorruptFiles": skip_corrupt}
    wanted_states = states or STATES
    if months:
        found = None
        if merge_schema:
            whole = folder_glob(root, base, group, wanted_states, months)
            by_month = [folder_glob(root, base, group, wanted_states, [month]) for month in months]
            found = read_drifting(spark, [whole], each, missing_ok=True, finer={whole: by_month}, **options)
        else:
            try:
                found = spark.read.options(**options).parquet(folder_glob(root, base, group, wanted_states, months))
                found = each(found) if each else found
            except AnalysisException as missing:
                if missing.getCondition() != "PATH_NOT_FOUND":
                    raise
        if found is not None:
            return found.select(*columns) if columns else found
    if required:
        raise FileNotFoundError(f"no folder of {base}/{group} below {root} for the states and months asked for")
    names = columns or list(types or {})
    return spark.createDataFrame([], struct_of({c: "TEXT" for c in names}))


def scan_request(spark: SparkSession, root: str, request: Request, **options) -> DataFrame:
    """Raw rows a checked request asks for."""
    return scan_folders(
        spark, root, request.base, request.group, request.months, request.states, **options
    )


def discover_files(spark: SparkSession, root: str, group: str | None = None) -> DataFrame:
    """Data files below ``root`` whose own or folder name fits the group, without reading them.

    The content column is never selected, so only the listing is done.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select("path", "length", F.col("_metadata.file_name").alias("file_name"))
    )
    parts = F.split("path", "/")
    listing = listing.withColumn("folder", F.element_at(parts, -2))
    listing = listing.withColumn("id_arquivo", F.concat_ws("_", "folder", "file_name"))
    if group is None:
        return listing
    pattern = f"{group_start(group)}.+\\.parquet$"
    states = [F.nullif(F.upper(F.regexp_extract(c, pattern, 1)), F.lit("")) for c in ("file_name", "folder")]
    return listing.withColumn("uf", F.coalesce(*states)).filter(F.col("uf").isNotNull())


def read_concat(spark: SparkSession, *paths: str, merge_schema: bool = False) -> DataFrame:
    """Rows of files or directories, one after another; merged ones may hold a column in different types."""
    if merge_schema:
        return read_drifting(spark, paths)
    return spark.read.option("mergeSchema", merge_schema).parquet(*paths)


def merged_columns(spark: SparkSession, *paths: str) -> list[str]:
    """Union of the column names of files with different schemas."""
    return read_concat(spark, *paths, merge_schema=True).columns


def file_columns(spark: SparkSession, *paths: str) -> DataFrame:
    """Column names of each data file below the paths; a file that is no Parquet has a ``reason`` instead.

    Only footers are read, in parallel, one file per row.  A store that pyarrow does not
    know, and a file that cannot be reached, are errors: they say nothing about the file.
    The task function is local, so executors need pyarrow but not this package.
    """

    def footer(path: str) -> tuple[list[str] | None, str | None]:
        import re

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        system, name = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
        with system.open_input_file(name) as file:
            try:
                return [c.lower() for c in pq.read_schema(file).names], None
            except pa.ArrowInvalid as corrupt:
                return None, str(corrupt)

    def footers(batches):
        for batch in batches:
            found = [footer(path) for path in batch["path"]]
            yield batch.assign(columns=[names for names, _ in found], reason=[why for _, why in found])

    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    named = listing.select("path", F.col("_metadata.file_path").alias("file_path"))
    return named.mapInPandas(footers, "path string, file_path string, columns array<string>, reason string")


def checked_files(spark: SparkSession, paths: Sequence[str], types: dict[str, str]) -> DataFrame:
    """``path``, ``file_path`` (as row metadata has it), ``reason`` and ``broken`` of each data file.

    The reason is null for a valid file, else why it is rejected; a broken file is no Parquet.
    """
    wanted = F.array(*[F.lit(c.lower()) for c in types])
    absent = F.array_except(wanted, F.col("columns"))
    lacks = F.when(F.size(absent) > 0, F.concat(F.lit("columns missing: "), F.array_join(absent, ", ")))
    return file_columns(spark, *paths).select("path", "file_path", F.coalesce("reason", lacks).alias("reason"), F.col("columns").isNull().alias("broken"))


def valid_paths(spark: SparkSession, paths: Sequence[str], types: dict[str, str]) -> list[str]:
    """Data files below the paths that can be read and hold every declared column."""
    valid = checked_files(spark, paths, types).filter(F.col("reason").isNull())
    return sorted(row.path for row in valid.select("path").collect())


def read_valid(spark: SparkSession, paths: Sequence[str], types: dict[str, str]) -> DataFrame:
    """Rows of the valid files; their names are joined, so the driver holds no list of them.

    Nothing is ignored when rows are read: a valid file that then fails is an error.  Only
    files that are no Parquet are left out of the scan by name.
    """
    listed = scratch_path(spark, "checked-files")
    checked_files(spark, paths, types).write.parquet(listed)
    checked = spark.read.parquet(listed)
    valid = checked.filter(F.col("reason").isNull())
    try:  # footers only; those of broken files are passed over
        schema = spark.read.option("mergeSchema", True).option("ignoreCorruptFiles", True).option("recursiveFileLookup", True).parquet(*paths).schema
    except AnalysisException as nothing:
        if nothing.getCondition() != "UNABLE_TO_INFER_SCHEMA" or not valid.isEmpty():
            raise
        return spark.createDataFrame([], struct_of({c: "TEXT" for c in types}))
    rows = spark.read.schema(schema).option("ignoreCorruptFiles", False).option("recursiveFileLookup", True).parquet(*paths)
    # As many names as there are broken files; Spark drops files by name before it opens any.
    broken = [row.file_path for row in checked.filter("broken").select("file_path").collect()]
    named = rows.select("*", F.col("_metadata.file_path").alias("__file")).filter(~F.col("_metadata.file_path").isin(broken))
    return named.join(valid.select(F.col("file_path").alias("__file")), "__file", "left_semi").select(*rows.columns)


def batch_sizes(df: DataFrame, size: int = 100_000) -> DataFrame:
    """Rows per read batch of each file, empty batches absent."""
    return row_batches(df, size).groupBy(F.col("_metadata.file_name").alias("file_name"), "batch_no").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def year_of_name(yymm: Column) -> Column:
    """Four-digit year of a ``yymm`` text."""
    return full_year(F.substring(yymm, 1, 2).cast("int"))

"""Reading files that hold a column in different types.

Parquet files whose columns have the same types wherever they share one are read by one scan.  Where
Spark cannot merge their schemas, the paths are halved until it can, and parts that agree are put
together again, so there are as many scans as there are kinds of files.  The scans are united
over all columns; a column of several types takes the narrowest type that holds every value, at last text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Digits before the point that a whole-number type needs.
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
        return max(a, b, key=lambda t: _DIGITS[t.simpleString()])
    numbers = (T.IntegralType, T.DecimalType, T.FloatType, T.DoubleType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        if isinstance(a, (T.FloatType, T.DoubleType)) or isinstance(b, (T.FloatType, T.DoubleType)):
            # Whole numbers up to 32 bits and floats are doubles without loss; others are text.
            exact = all(isinstance(t, (T.FloatType, T.DoubleType, T.ByteType, T.ShortType, T.IntegerType)) for t in (a, b))
            return T.DoubleType() if exact else T.StringType()
        whole, scale = 0, 0
        for t in (a, b):
            digits = t.precision - t.scale if isinstance(t, T.DecimalType) else _DIGITS[t.simpleString()]
            whole, scale = max(whole, digits), max(scale, t.scale if isinstance(t, T.DecimalType) else 0)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    if {type(a), type(b)} <= {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return T.StringType()


def union_widest(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames over the union of their columns, each in the narrowest type that holds its values."""
    if len(frames) == 1:
        return frames[0]
    kinds: dict[str, list[T.DataType]] = {}
    names: dict[str, str] = {}
    for frame in frames:
        for field in frame.schema.fields:
            names.setdefault(field.name.lower(), field.name)
            kinds.setdefault(field.name.lower(), []).append(field.dataType)
    wide = {key: reduce(_wider, found) for key, found in kinds.items()}
    cast = [
        frame.select(*[F.col(f"`{f.name}`").cast(wide[f.name.lower()]).alias(names[f.name.lower()]) for f in frame.schema.fields])
        for frame in frames
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


def _schema(spark: SparkSession, paths: Sequence[str], options: dict) -> T.StructType | None:
    """Merged schema of the files, or nothing where they disagree."""
    try:
        return spark.read.options(**options).option("mergeSchema", True).parquet(*paths).schema
    except (Py4JJavaError, PySparkException) as error:
        if "CANNOT_MERGE_SCHEMAS" in str(error):
            return None
        raise


def _files(spark: SparkSession, path: str) -> list[str]:
    """Data files of one path."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return sorted(r.path for r in listing.load(path).select("path").collect())


def compatible_groups(
    spark: SparkSession,
    paths: Sequence[str],
    options: dict | None = None,
    missing_ok: bool = False,
    finer: dict[str, list[str]] | None = None,
) -> list[tuple[list[str], T.StructType]]:
    """The paths in groups of one schema each.

    The schemas are found by Spark's own reading of the footers, in parallel; the driver holds paths, not files.
    Only a path whose own files disagree is taken apart: into the ``finer`` paths given for it, else into files.
    """
    options, finer = options or {}, dict(finer or {})
    taken_apart: set[str] = set()

    def found(some: list[str]) -> Iterable[tuple[list[str], T.StructType]]:
        try:
            schema = _schema(spark, some, options)
        except AnalysisException as error:
            if not missing_ok or error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            if len(some) == 1:
                return
            schema = None
        if schema is not None:
            yield some, schema
            return
        if len(some) > 1:
            yield from found(some[: len(some) // 2])
            yield from found(some[len(some) // 2 :])
            return
        parts = finer.pop(some[0], None) or _files(spark, some[0])
        if len(parts) == 1 and parts[0] == some[0] and some[0] in taken_apart:
            raise ValueError(f"{some[0]} has no schema")
        taken_apart.add(some[0])
        yield from found(parts)

    groups: list[tuple[list[str], T.StructType]] = []
    for some, schema in found(list(paths)):
        own = {f.name.lower(): f.dataType for f in schema.fields}
        for at, (other, held) in enumerate(groups):
            if all(own.get(f.name.lower(), f.dataType) == f.dataType for f in held.fields):
                there = {f.name.lower() for f in held.fields}
                groups[at] = other + some, T.StructType([*held.fields, *(f for f in schema.fields if f.name.lower() not in there)])
                break
        else:
            groups.append((some, schema))
    return groups


def read_drifting(
    spark: SparkSession,
    paths: Sequence[str],
    each: Callable[[DataFrame], DataFrame] | None = None,
    missing_ok: bool = False,
    finer: dict[str, list[str]] | None = None,
    **options,
) -> DataFrame | None:
    """Rows of the paths, whatever types their files hold the columns in.

    ``each`` is applied to every scan, where the files' metadata can still be read.  With
    ``missing_ok`` paths that match nothing are left out, and without any there is no frame.
    """
    groups = compatible_groups(spark, paths, options, missing_ok, finer)
    scans = [spark.read.options(**options).schema(schema).parquet(*some) for some, schema in groups]
    if not scans:
        return None
    return union_widest([each(scan) if each else scan for scan in scans])

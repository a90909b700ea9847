"""Translation between declared SQL type names and Spark types."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# SQL names without arguments.
PLAIN_TYPES = {
    "SMALLINT": T.ShortType(),
    "INTEGER": T.IntegerType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "FLOAT": T.DoubleType(),
    "DOUBLE PRECISION": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "TEXT": T.StringType(),
}

# Unbounded NUMERIC has no Spark counterpart; this keeps ten decimal places.
OPEN_NUMERIC = T.DecimalType(38, 10)


def spark_type(sql_type: str) -> T.DataType:
    """Spark type of a declared SQL type; unknown names are kept as text."""
    name = " ".join(sql_type.upper().split())
    if name in PLAIN_TYPES:
        return PLAIN_TYPES[name]
    if name.startswith("SERIAL"):
        return T.LongType()
    numeric = re.fullmatch(r"(?:NUMERIC|DECIMAL)(?:\((\d+)(?:, ?(\d+))?\))?", name)
    if numeric:
        if numeric.group(1) is None:
            return OPEN_NUMERIC
        return T.DecimalType(int(numeric.group(1)), int(numeric.group(2) or 0))
    return T.StringType()


def text_length(sql_type: str) -> int | None:
    """Declared length of ``CHAR(n)`` / ``VARCHAR(n)``."""
    match = re.fullmatch(r"(?:VAR)?CHAR\((\d+)\)", sql_type.strip().upper())
    return int(match.group(1)) if match else None


def sql_type(data_type: T.DataType) -> str:
    """Declared SQL name of a Spark type, the inverse of ``spark_type``."""
    if isinstance(data_type, T.DecimalType):
        return f"NUMERIC({data_type.precision},{data_type.scale})"
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return "DOUBLE PRECISION"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    names = {type(t): name for name, t in PLAIN_TYPES.items() if name not in ("INT", "FLOAT")}
    names[T.ByteType] = "SMALLINT"
    return names.get(type(data_type), "TEXT")


def struct_of(types: dict[str, str]) -> T.StructType:
    """Schema of a type map; a text length travels as field metadata."""
    fields = []
    for name, declared in types.items():
        length = text_length(declared)
        meta = {"length": length} if length else {}
        fields.append(T.StructField(name, spark_type(declared), True, meta))
    return T.StructType(fields)


def types_of(df: DataFrame) -> dict[str, str]:
    """Type map of a frame."""
    return {f.name: sql_type(f.dataType) for f in df.schema.fields}


def create_table_text(table: str, types: dict[str, str], replace: bool = False) -> str:
    """CREATE TABLE text for a relational target, from a type map."""
    body = ",\n".join(f'    "{c}" {t}' for c, t in types.items())
    if replace:
        return f"DROP TABLE IF EXISTS {table};\nCREATE TABLE {table} (\n{body}\n);\n"
    return f"CREATE TABLE IF NOT EXISTS {table} (\n{body}\n);\n"


def spark_ddl(types: dict[str, str]) -> str:
    """Column list of a type map in Spark SQL."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in struct_of(types).fields)

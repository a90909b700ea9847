"""Tables that readers see through a view, so that replacing one leaves no gap.

A published name is a view over its newest *generation*, a plain table of its own.  A new
generation is made in full under a name no reader knows; then one catalog call points the
view at it.  Whatever fails before that call leaves the old rows, and there is no moment at which
the name shows nothing.  The generation that was replaced stays until the next replacement, as queries that
began on it still read its files.  Only one writer may replace a name at a time.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_MARK = "__g"
_NAME = re.compile(rf"{_MARK}[0-9]{{20}}_[0-9a-f]{{8}}$")
_SHOWN = re.compile(r"FROM (\S+)$")
#: Property of a generation: the one it replaced.
_BEFORE = "replaces"


def _qualified(spark: SparkSession, table: str) -> str:
    return table if "." in table else f"{spark.catalog.currentDatabase()}.{table}"


def new_generation(spark: SparkSession, table: str) -> str:
    """A name for the table's next generation; names sort by age."""
    return f"{_qualified(spark, table)}{_MARK}{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    """Details of a table or view, empty when there is none."""
    if not spark.catalog.tableExists(table):
        return {}
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    names = [r.col_name for r in rows]
    return {r.col_name: r.data_type for r in rows[names.index("# Detailed Table Information") :]}


def generation(spark: SparkSession, table: str) -> str | None:
    """The generation a published name shows; nothing for a plain table or an unknown name."""
    found = _SHOWN.search(_described(spark, table).get("View Text", ""))
    return found[1] if found else None


def stored_in(spark: SparkSession, table: str) -> str | None:
    """The table that holds a name's rows: its generation, or the plain table itself."""
    return generation(spark, table) or (table if spark.catalog.tableExists(table) else None)


def location(spark: SparkSession, table: str) -> str | None:
    """Folder of a table's rows, or nothing when there is no such table."""
    held = stored_in(spark, table)
    return _described(spark, held).get("Location") if held else None


def show(spark: SparkSession, table: str, newest: str, columns: Sequence[str] | None = None) -> None:
    """Let ``table`` show the complete table ``newest`` from now on, by one catalog call.

    ``columns`` are SQL expressions with names, instead of all columns.  A plain table of that name, made by other means, becomes the first generation.  That
    alone takes two calls, after which the name is a view for good.
    """
    held = stored_in(spark, table)
    if held == table:
        _adopt(spark, table)
        held = generation(spark, table)
    if held and held != newest:
        spark.sql(f"ALTER TABLE {newest} SET TBLPROPERTIES ('{_BEFORE}' = '{held}')")
    text = _text(spark, newest, columns)
    spark.sql(f"ALTER VIEW {table} AS {text}" if held else f"CREATE VIEW {table} AS {text}")


def _text(spark: SparkSession, held: str, columns: Sequence[str] | None = None) -> str:
    columns = columns or [f"`{c}`" for c in spark.table(held).columns]
    return f"SELECT {', '.join(columns)} FROM {_qualified(spark, held)}"


def _adopt(spark: SparkSession, table: str) -> None:
    first = new_generation(spark, table)
    spark.sql(f"ALTER TABLE {table} RENAME TO {first}")
    try:
        spark.sql(f"CREATE VIEW {table} AS {_text(spark, first)}")
    except Exception:
        spark.sql(f"ALTER TABLE {first} RENAME TO {table}")
        raise


def _chain(spark: SparkSession, table: str) -> list[str]:
    """The generation a name shows and those it showed before, newest first."""
    out: list[str] = []
    at = generation(spark, table)
    while at and spark.catalog.tableExists(at):
        out.append(at)
        at = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {at}").collect()}.get(_BEFORE)
    return out


def _unfinished(spark: SparkSession, table: str, chain: list[str]) -> list[str]:
    """Generations that no run finished."""
    database, name = _qualified(spark, table).lower().rsplit(".", 1)
    listed = [r.tableName.lower() for r in spark.sql(f"SHOW TABLES IN {database} LIKE '{name}{_MARK}*'").collect()]
    known = {x.lower() for x in chain}
    return [f"{database}.{t}" for t in listed if _NAME.search(t) and _NAME.sub("", t) == name and f"{database}.{t}" not in known]


def retire(spark: SparkSession, table: str, root: str | None = None, keep: int = 1) -> list[str]:
    """Drop the generations a name no longer shows but the ``keep`` newest, and those of failed runs; returns their names.

    Folders below ``root`` go with them; files elsewhere are left to their owner.
    """
    chain = _chain(spark, table)
    gone = [*chain[1 + keep :], *_unfinished(spark, table, chain)]
    for name in gone:
        _drop(spark, name, root)
    return gone


def _drop(spark: SparkSession, name: str, root: str | None) -> None:
    folder = location(spark, name)
    spark.sql(f"DROP TABLE {name}")
    if root and folder:
        _remove_below(spark, folder, root)


def _remove_below(spark: SparkSession, folder: str, root: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old, top = (files.makeQualified(path(p)).toString().rstrip("/") for p in (folder, root))
    if old.startswith(f"{top}/"):
        files.delete(path(folder), True)


def swap(spark: SparkSession, new: str, current: str) -> None:
    """``current`` shows the rows of table ``new`` from one catalog call on; then the name ``new`` is gone."""
    newest = generation(spark, new)
    if newest is None:  # a plain table, which no view shows yet
        newest = new_generation(spark, current)
        spark.sql(f"ALTER TABLE {new} RENAME TO {newest}")
        show(spark, current, newest)
    else:
        show(spark, current, newest)
        spark.sql(f"DROP VIEW {new}")
    retire(spark, current)


def remove(spark: SparkSession, table: str, root: str | None = None) -> None:
    """Drop a published table with all its generations."""
    chain = _chain(spark, table)
    gone = [*chain, *_unfinished(spark, table, chain)]
    spark.sql(f"DROP VIEW {table}")
    for name in gone:
        _drop(spark, name, root)


def first_rows(df: DataFrame, table: str, path: str | None = None) -> None:
    """Make a published table of the frame's rows under a name no one uses yet."""
    spark = df.sparkSession
    newest = new_generation(spark, table)
    writer = df.write.format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(newest)
    show(spark, table, newest)

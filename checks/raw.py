"""Raw, padded text derived from the driver tables, as text both engines can run.

``RAW_ORDERS`` looks like hospital records: padded numbers and dates, blanks, broken
numbers, impossible dates, numbers too large for their type, a flag coded 0/1/2.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from checks import table

RAW_ORDERS = """
SELECT
    o_orderkey AS sequencia,
    lpad(CAST(o_custkey AS STRING), 7, '0') AS cnes,
    CASE WHEN o_orderkey % 7 = 0 THEN concat('X', CAST(o_custkey AS STRING))
         WHEN o_orderkey % 11 = 0 THEN '              '
         ELSE lpad(CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING), 14, ' ') END AS val_tot,
    CASE WHEN o_orderkey % 13 = 0 THEN '19991399'
         WHEN o_orderkey % 17 = 0 THEN '        '
         ELSE concat(replace(substr(CAST(o_orderdate AS STRING), 1, 10), '-', ''), '  ') END AS dt_inter,
    concat(CAST(o_orderkey * 50 AS STRING), '   ') AS qt_diarias,
    CASE WHEN o_orderkey % 19 = 0 THEN '12.5' WHEN o_orderkey % 23 = 0 THEN 'None'
         ELSE lpad(CAST(o_custkey + 350000 AS STRING), 8, ' ') END AS munic_res,
    CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '0' ELSE '2' END AS homonimo,
    concat('  ', o_orderpriority, ' ') AS espec
FROM orders
"""

# Declared types of these columns in the hospital group.
RAW_TYPES = {
    "sequencia": "BIGINT",
    "cnes": "TEXT",
    "val_tot": "NUMERIC(15,2)",
    "dt_inter": "DATE",
    "qt_diarias": "SMALLINT",
    "munic_res": "INTEGER",
    "homonimo": "BOOLEAN",
    "espec": "TEXT",
}


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(RAW_ORDERS.replace("FROM orders", "FROM {orders}"), orders=table(spark, folder, "orders"))


def _text(c: str) -> str:
    return f"CASE WHEN trim({c}) NOT IN ('', 'NaN', 'None') THEN trim({c}) END"


# The same conversions spelled out in SQL.
VALUE_SQL = {
    "sequencia": "sequencia",
    "cnes": _text("cnes"),
    "val_tot": f"TRY_CAST({_text('val_tot')} AS DECIMAL(15,2))",
    "dt_inter": f"CAST(try_strptime({_text('dt_inter')}, '%Y%m%d') AS DATE)",
    "qt_diarias": f"TRY_CAST({_text('qt_diarias')} AS SMALLINT)",
    "munic_res": f"CASE WHEN {_text('munic_res')} NOT LIKE '%.%' THEN TRY_CAST({_text('munic_res')} AS INTEGER) END",
    "homonimo": "CASE trim(homonimo) WHEN '1' THEN true WHEN '0' THEN false END",
    "espec": _text("espec"),
}
PRESENT_SQL = {c: _text(c) if c != "sequencia" else c for c in VALUE_SQL}
FAILS_SQL = {c: f"(({PRESENT_SQL[c]}) IS NOT NULL AND ({VALUE_SQL[c]}) IS NULL)" for c in VALUE_SQL}


def from_raw(select: str) -> str:
    return f"WITH raw AS ({RAW_ORDERS}) SELECT {select} FROM raw"

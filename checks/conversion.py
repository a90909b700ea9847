"""Typed conversion."""

from __future__ import annotations

from pyspark.sql import functions as F

from censa.functions.convert import to_boolean
from censa.functions.dates import parse_date
from censa.operators import conversion as cv
from censa.operators import schema as sc
from censa.operators.cleaning import trim_text
from censa.plans.quarantine import publish_quarantined
from censa.session import scratch_path
from censa.sinks.tables import fresh_name
from checks import check
from checks.raw import FAILS_SQL, RAW_TYPES, VALUE_SQL, from_raw, raw_orders

_ERROR = "CASE WHEN {fails} THEN 'ERRO_TIPO' END AS new_{c}_error"
_CONVERTED = ", ".join(
    f"{VALUE_SQL[c]} AS {c}, " + _ERROR.format(fails=FAILS_SQL[c], c=c) for c in VALUE_SQL
)
_KEPT_TYPES = {c: t for c, t in RAW_TYPES.items() if t != "TEXT"}


@check(from_raw(_CONVERTED))
def convert_with_errors(spark, folder):
    return cv.convert_with_errors(raw_orders(spark, folder), RAW_TYPES)


@check(
    from_raw(
        ", ".join(f"{VALUE_SQL[c]} AS {c}" for c in VALUE_SQL)
        + ", CASE WHEN regexp_matches(trim(val_tot), '[^0-9]') THEN 'ERRO_TIPO' END AS new_val_tot_error"
    )
)
def convert_strict_digits(spark, folder):
    converted = cv.convert_with_errors(raw_orders(spark, folder), RAW_TYPES, strict_digits=True)
    return converted.select(*RAW_TYPES, "new_val_tot_error")


@check(
    from_raw(
        ", ".join(f"{VALUE_SQL[c] if c in _KEPT_TYPES else c} AS {c}" for c in VALUE_SQL)
        + ", "
        + ", ".join(f"CASE WHEN {FAILS_SQL[c]} THEN {c} END AS new_{c}" for c in _KEPT_TYPES)
    )
)
def convert_quarantine(spark, folder):
    return cv.convert_quarantine(raw_orders(spark, folder), _KEPT_TYPES)


@check(
    from_raw(
        "sequencia, cnes, CAST(NULL AS DECIMAL(15,2)) AS val_tot, homonimo, val_tot AS new_val_tot"
    )
)
def convert_quarantine_columns(spark, folder):
    raw = raw_orders(spark, folder).select("sequencia", "cnes", "val_tot", "homonimo")
    types = {"sequencia": "BIGINT", "val_tot": "NUMERIC(15,2)"}
    return publish_quarantined(raw, types, fresh_name("quarantined"), scratch_path(spark, "quarantined")).table


@check(from_raw(", ".join(f"{v} AS {c}" for c, v in VALUE_SQL.items())))
def convert_loader(spark, folder):
    return cv.convert_loader(raw_orders(spark, folder), RAW_TYPES)


@check(from_raw(f"sequencia, {VALUE_SQL['cnes']} AS cnes, CAST(trim(qt_diarias) AS BIGINT) AS qt_diarias"))
def convert_strict(spark, folder):
    raw = raw_orders(spark, folder).select("sequencia", "cnes", "qt_diarias")
    return cv.convert_strict(raw, {"sequencia": "BIGINT", "cnes": "TEXT", "qt_diarias": "BIGINT"})


@check(
    """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DECIMAL(10,2)) AS l_quantity,
              CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem"""
)
def alter_types(spark, folder):
    rows = spark.sql(
        """SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS DECIMAL(10,1)) AS STRING) AS l_quantity,
                  date_format(l_shipdate, 'yyyyMMdd') AS l_shipdate FROM {lineitem}""",
        lineitem=spark.read.parquet(f"{folder}/lineitem.parquet"),
    )
    return cv.alter_types(rows, {"l_quantity": "NUMERIC(10,2)", "l_shipdate": "DATE"})


@check(from_raw(f"sequencia, {VALUE_SQL['dt_inter']} AS dt_inter, CAST(trim(dt_inter) = '' AS BOOLEAN) AS blank"))
def parse_dates(spark, folder):
    raw = raw_orders(spark, folder)
    return raw.select("sequencia", parse_date(F.col("dt_inter")).alias("dt_inter"), (F.trim("dt_inter") == "").alias("blank"))


@check(
    from_raw(
        """sequencia,
        CASE trim(homonimo) WHEN '1' THEN true WHEN '0' THEN false END AS mapped,
        trim(homonimo) NOT IN ('0', 'false', 'f') AS truthy,
        CASE trim(homonimo) WHEN '1' THEN true WHEN '0' THEN false END AS casted"""
    )
)
def boolean_maps(spark, folder):
    c = F.col("homonimo")
    return raw_orders(spark, folder).select(
        "sequencia",
        to_boolean(c, "map").alias("mapped"),
        to_boolean(c, "truthy").alias("truthy"),
        to_boolean(c, "cast").alias("casted"),
    )


@check(
    " UNION ALL ".join(
        f"SELECT * FROM ({from_raw(f'''
            'new_{c}_error' AS error_column, CAST(count(*) FILTER (WHERE {FAILS_SQL[c]}) AS BIGINT) AS n_errors''')})"
        for c in VALUE_SQL
    )
)
def error_counts(spark, folder):
    return cv.error_counts(cv.convert_with_errors(raw_orders(spark, folder), RAW_TYPES))


@check(
    from_raw(
        ", ".join(
            f"{VALUE_SQL[c]} AS {c}"
            + (", " + _ERROR.format(fails=FAILS_SQL[c], c=c) if RAW_TYPES[c] != "TEXT" and c != "sequencia" else "")
            for c in VALUE_SQL
        )
    )
)
def drop_empty_error_columns(spark, folder):
    return sc.drop_empty_columns(cv.convert_with_errors(raw_orders(spark, folder), RAW_TYPES))


@check(
    " UNION ALL ".join(
        f"SELECT * FROM ({from_raw(f'''
            '{c}' AS column_name,
            CAST(count(*) FILTER (WHERE {FAILS_SQL[c]} AND {strict}) AS BIGINT) AS n_silent''')})"
        for c, strict in [
            ("val_tot", "NOT regexp_matches(trim(val_tot), '[^0-9]')"),
            ("dt_inter", "false"),
            ("qt_diarias", "false"),
        ]
    )
)
def silent_nulls(spark, folder):
    raw = raw_orders(spark, folder).select("val_tot", "dt_inter", "qt_diarias")
    return cv.silent_nulls(raw, RAW_TYPES, strict_digits=True)


@check(
    from_raw(
        "sequencia, trim(val_tot) AS val_tot, trim(espec) AS espec, trim(val_tot) AS new_val_tot"
    )
)
def keep_originals(spark, folder):
    raw = trim_text(raw_orders(spark, folder).select("sequencia", "val_tot", "espec"))
    return sc.keep_originals(raw, {"val_tot": "NUMERIC(15,2)"})


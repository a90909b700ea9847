"""Profiles, quality rules, type suggestions."""

from __future__ import annotations

from pyspark.sql import functions as F

from censa.operators import profile as pf
from censa.operators import quality as ql
from checks import check, table
from checks.raw import from_raw, raw_orders

# column -> (text expression, Spark type, is text)
_CUSTOMER = {
    "c_custkey": ("CAST(c_custkey AS VARCHAR)", "bigint", False),
    "c_name": ("c_name", "string", True),
    "c_nationkey": ("CAST(c_nationkey AS VARCHAR)", "int", False),
    "c_acctbal": ("CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS VARCHAR)", "decimal(15,2)", False),
    "c_mktsegment": ("c_mktsegment", "string", True),
}
_KIND = "CASE WHEN trim(v) ~ '^-?[0-9]+$' THEN 'i' WHEN trim(v) ~ '^-?[0-9]+\\.[0-9]+$' THEN 'f' ELSE 's' END"


def profile_sql(source: str, columns: dict[str, tuple[str, str, bool]]) -> str:
    """Profile of each column, spelled out with one grouped query per column."""
    parts = []
    for i, (name, (text, kind, is_text)) in enumerate(columns.items()):
        parts.append(
            f"""SELECT {i} AS position, '{name}' AS column_name, '{kind}' AS data_type, count(*) AS n_rows,
            count(DISTINCT v) AS n_distinct, count(*) - count(v) AS n_null,
            coalesce(array_to_string(list_sort(list(DISTINCT v) FILTER (WHERE v IS NOT NULL))[1:10], '|'), '') AS sample,
            CAST({'coalesce(max(length(v)) FILTER (WHERE length(v) > 0), 0)' if is_text else '0'} AS INTEGER) AS max_length,
            CAST({'coalesce(min(length(v)) FILTER (WHERE length(v) > 0), 0)' if is_text else '0'} AS INTEGER) AS min_length,
            {"coalesce(bool_or(v ~ '^0[0-9]+$'), false)" if is_text else 'false'} AS leading_zeros,
            {"coalesce(bool_or(regexp_matches(v, '[^\\p{L}\\p{N}_\\s]')), false)" if is_text else 'false'} AS special_chars,
            {f"coalesce(count(DISTINCT CASE WHEN v IS NOT NULL THEN {_KIND} END) > 1, false)" if is_text else 'false'} AS mixed_types
            FROM (SELECT {text} AS v FROM {source})"""
        )
    return " UNION ALL ".join(parts)


_METRICS = ["position", "column_name", "data_type", "n_rows", "n_distinct", "n_null", "sample", "max_length",
            "min_length", "leading_zeros", "special_chars", "mixed_types"]


def _readable(profile):
    return profile.select(*_METRICS).withColumn("sample", F.array_join("sample", "|"))


def _customer_profile(spark, folder):
    """All columns; amounts as decimals, whose text both engines write alike."""
    customers = table(spark, folder, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(15,2)"))
    return pf.column_profile(customers, list(_CUSTOMER))


@check(profile_sql("customer", _CUSTOMER))
def column_profile(spark, folder):
    return _readable(_customer_profile(spark, folder))


_RAW = {"sequencia": ("CAST(sequencia AS VARCHAR)", "bigint", False)}
_RAW |= {c: (c, "string", True) for c in ("cnes", "val_tot", "dt_inter", "qt_diarias", "munic_res", "homonimo", "espec")}


@check(profile_sql("({})".format(from_raw("*")), _RAW))
def raw_profile(spark, folder):
    return _readable(pf.column_profile(raw_orders(spark, folder), list(_RAW)))


@check(
    """SELECT o_orderpriority, max(length(v)) AS max_length, min(length(v)) AS min_length,
              bool_or(v LIKE '0%' AND length(v) > 1) AS leading_zeros,
              bool_or(NOT v ~ '^[a-zA-Z0-9]+$' AND NOT v ~ '^\\s+$') AS special_chars,
              bool_or(v ~ '^[0-9]+$') AND bool_or(NOT v ~ '^[0-9]+$') AS mixed_types
       FROM (SELECT o_orderpriority, unnest([lpad(CAST(o_custkey AS VARCHAR), 4, '0'), o_orderstatus]) AS v FROM orders)
       GROUP BY 1"""
)
def list_metrics(spark, folder):
    """Metrics of each order's value list, combined per priority."""
    lists = table(spark, folder, "orders").select(
        "o_orderpriority", F.array(F.lpad(F.col("o_custkey").cast("string"), 4, "0"), "o_orderstatus").alias("values")
    )
    measured = pf.list_metrics(lists, "values")
    return measured.groupBy("o_orderpriority").agg(
        F.max("max_length").alias("max_length"),
        F.min("min_length").alias("min_length"),
        F.bool_or("leading_zeros").alias("leading_zeros"),
        F.bool_or("special_chars").alias("special_chars"),
        F.bool_or("mixed_types").alias("mixed_types"),
    )


_LABELLED = """SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


@check(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null,
        round((count(*) - count({c})) / count(*), 8) AS ratio FROM ({_LABELLED})""" for c in ("doc_id", "quality", "toxic")
    )
)
def null_ratio(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id")
    joined = documents.join(table(spark, folder, "labels"), "doc_id", "left")
    return pf.null_ratio(joined, ["doc_id", "quality", "toxic"]).withColumn("ratio", F.round("ratio", 8))


def _describe(c: str, source: str) -> str:
    return f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 3) AS mean, round(stddev_samp({c}), 3) AS std,
        CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 4) AS q1, round(quantile_cont({c}, 0.5), 4) AS median,
        round(quantile_cont({c}, 0.75), 4) AS q3, CAST(max({c}) AS DOUBLE) AS max FROM {source}"""


_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@check(" UNION ALL ".join(_describe(c, "lineitem") for c in _NUMBERS))
def describe_numeric(spark, folder):
    """Every numeric column of the table."""
    described = pf.describe_numeric(table(spark, folder, "lineitem"), _NUMBERS)
    rounded = {c: F.round(c, 3) for c in ("mean", "std")} | {c: F.round(c, 4) for c in ("q1", "median", "q3")}
    return described.withColumns(rounded)


def _top(c: str, k: int) -> str:
    return f"""SELECT '{c}' AS column_name, (SELECT count(DISTINCT {c}) FROM events) AS n_distinct,
        CAST(row_number() OVER (ORDER BY n DESC, value) AS INTEGER) AS rank, value, n AS n_rows
        FROM (SELECT CAST({c} AS VARCHAR) AS value, count(*) AS n FROM events WHERE {c} IS NOT NULL GROUP BY 1)
        QUALIFY rank <= {k}"""


@check(" UNION ALL ".join(f"SELECT * FROM ({_top(c, 5)})" for c in ("event_type", "user_id", "props", "event_id")))
def top_values(spark, folder):
    return pf.top_values(table(spark, folder, "events"), ["event_type", "user_id", "props", "event_id"])


@check(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, count(DISTINCT {c}) AS n_distinct,
        (SELECT {c} FROM events GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
        (SELECT count(*) FROM events GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS freq FROM events"""
        for c in ("event_type", "props")
    )
)
def describe_text(spark, folder):
    return pf.describe_text(table(spark, folder, "events"), ["event_type", "props"])


@check(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(coalesce(max(length({c})), 0) AS INTEGER) AS max_length FROM documents"
        for c in ("text", "lang", "source")
    )
)
def max_length(spark, folder):
    return pf.max_lengths(table(spark, folder, "documents"), ["text", "lang", "source"])


@check(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) = count(*) AS is_unique FROM orders"
        for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    )
)
def unique_columns(spark, folder):
    """Every column of the table."""
    return pf.unique_columns(table(spark, folder, "orders"))


@check(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER (WHERE regexp_matches({c}, '[^\\x00-\\x7F]')) AS n_non_ascii,
        CAST(coalesce(max(length({c})), 0) AS INTEGER) AS max_length, coalesce(max(length({c})), 0) > 255 AS too_long
        FROM documents""" for c in ("text", "lang", "source")
    )
)
def non_ascii_count(spark, folder):
    return ql.text_violations(table(spark, folder, "documents"))


_DATED = """SELECT replace(substr(CAST(o_orderdate AS STRING), 1, 10), '-', '') AS compact,
    substr(CAST(o_orderdate AS STRING), 1, 10) AS iso FROM orders"""


@check(
    f"""SELECT 'compact' AS column_name, bool_and(try_strptime(compact, '%Y%m%d') IS NOT NULL) AS is_date_format FROM ({_DATED})
        UNION ALL SELECT 'iso', bool_and(try_strptime(iso, '%Y%m%d') IS NOT NULL) FROM ({_DATED})"""
)
def date_format_ok(spark, folder):
    rows = spark.sql(_DATED.replace("FROM orders", "FROM {orders}"), orders=table(spark, folder, "orders"))
    return ql.date_format_ok(rows, ["compact", "iso"])


@check(
    " UNION ALL ".join(
        f"""SELECT column_name, array_to_string(list_filter([CASE WHEN n_distinct > 10 THEN 'n_distinct' END, CASE WHEN shortest < 10 THEN 'min_length' END],
                lambda x: x IS NOT NULL), ',') AS missing
            FROM (SELECT '{c}' AS column_name, {"min(length(" + c + "))" if c in ("c_name", "c_mktsegment") else "0"} AS shortest, count(DISTINCT {c}) AS n_distinct FROM customer)
            WHERE shortest < 10 OR n_distinct > 10"""
        for c in _CUSTOMER
    )
)
def profile_check(spark, folder):
    """Profiles from which metrics are taken away by what the columns hold, checked for completeness."""
    profile = _customer_profile(spark, folder)
    broken = profile.withColumns({"min_length": F.when(F.col("min_length") >= 10, F.col("min_length")), "n_distinct": F.when(F.col("n_distinct") <= 10, F.col("n_distinct"))})
    return ql.profile_problems(broken).withColumn("missing", F.array_join("missing", ","))


@check(
    """SELECT 'o_orderkey' AS column_name, 'o_orderkey' AS target_name,
          CASE WHEN max(o_orderkey) <= 32767 THEN 'SMALLINT' WHEN max(o_orderkey) <= 2147483647 THEN 'INTEGER' ELSE 'BIGINT' END
          AS suggested_type FROM orders
       UNION ALL SELECT 'o_orderstatus', 'o_orderstatus', concat('CHAR(', CAST(max(length(o_orderstatus)) AS VARCHAR), ')') FROM orders
       UNION ALL SELECT 'o_orderpriority', 'o_orderpriority', concat('VARCHAR(', CAST(max(length(o_orderpriority)) AS VARCHAR), ')') FROM orders
       UNION ALL SELECT 'Valor Médio', 'valor_medio', CASE WHEN count(o_totalprice) > 0 THEN 'NUMERIC' END FROM orders
       UNION ALL SELECT 'code', 'code', CASE WHEN bool_or(CAST(o_custkey AS VARCHAR) <> '') THEN 'TEXT' END FROM orders
       UNION ALL SELECT 'flag', 'flag', CASE WHEN count(*) > 0 THEN 'BOOLEAN' END FROM orders
       UNION ALL SELECT 'day', 'day', CASE WHEN count(*) > 0 THEN 'DATE' END FROM orders
       UNION ALL SELECT 'nothing', 'nothing', CASE WHEN count(*) > 0 THEN 'TEXT' END FROM orders"""
)
def suggest_types(spark, folder):
    rows = table(spark, folder, "orders").selectExpr(
        "o_orderkey",
        "o_orderstatus",
        "o_orderpriority",
        "o_totalprice AS `Valor Médio`",
        "lpad(CAST(o_custkey AS STRING), 7, '0') AS code",
        "CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'no' END AS flag",
        "substr(CAST(o_orderdate AS STRING), 1, 10) AS day",
        "CAST(NULL AS STRING) AS nothing",
    )
    return ql.suggest_types(pf.column_profile(rows))

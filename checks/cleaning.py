"""Cleaning and column sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from censa.functions.text import normalize_name as normalized_text
from censa.operators import cleaning as cl
from censa.operators import schema as sc
from censa.registry.types import spark_ddl, struct_of, types_of
from censa.session import scratch_path
from censa.sinks import tables as sinks
from checks import check, table
from checks.raw import RAW_TYPES, from_raw, raw_orders


@check(from_raw("sequencia, val_tot, espec"))
def normalize_columns(spark, folder):
    raw = raw_orders(spark, folder).select("sequencia", "val_tot", "espec").toDF("SEQUENCIA ", "Val_Tot", "ESPEC")
    return sc.lower_names(raw)


@check("SELECT c_custkey, c_name, CAST(NULL AS DECIMAL(15,2)) AS val_tot, CAST(NULL AS DATE) AS nasc FROM customer")
def add_missing(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    return sc.add_missing(customers, {"c_custkey": "BIGINT", "val_tot": "NUMERIC(15,2)", "nasc": "DATE"})


@check("SELECT c_name, CAST(NULL AS SMALLINT) AS idade, c_custkey FROM customer")
def align_schema(spark, folder):
    customers = sc.drop_present(table(spark, folder, "customer"), ["id", "uf", "c_acctbal"])
    return sc.align(customers, {"c_name": "TEXT", "idade": "SMALLINT", "c_custkey": "BIGINT"})


@check(from_raw("sequencia, cnes AS facility, val_tot AS \"valorTotal\""))
def rename_columns(spark, folder):
    raw = raw_orders(spark, folder).select("sequencia", "cnes", "val_tot")
    return sc.rename_present(raw, {"val_tot": "valorTotal", "cnes": "facility", "absent": "other"})


@check(
    """SELECT c_custkey AS code, c_nationkey AS nation, NULL AS balance FROM customer
       UNION ALL SELECT s_suppkey, s_nationkey, CAST(s_acctbal AS DECIMAL(15,2)) FROM supplier"""
)
def evolve_union(spark, folder):
    target = table(spark, folder, "customer").selectExpr("c_custkey AS code", "c_nationkey AS nation")
    incoming = table(spark, folder, "supplier").selectExpr(
        "s_suppkey AS code", "s_nationkey AS nation", "CAST(s_acctbal AS DECIMAL(15,2)) AS balance"
    )
    return sc.evolve(target, incoming)


# Names with accents, built from the order priorities and the customer segment.
_NAMED = """SELECT DISTINCT concat(' Ação ', o_orderpriority, ' -- É/Ü ', CAST(o_custkey AS STRING), '. ') AS name FROM orders"""
_PLAIN = "lower(replace(replace(replace(replace(name, 'ç', 'c'), 'ã', 'a'), 'É', 'e'), 'Ü', 'u'))"


@check(
    f"""SELECT name, trim(regexp_replace({_PLAIN}, '[^a-z0-9_]+', '_', 'g'), '_') AS by_run,
        trim(regexp_replace({_PLAIN}, '[^a-z0-9_]', '_', 'g'), '_') AS by_character FROM ({_NAMED})"""
)
def normalize_name(spark, folder):
    names = spark.sql(_NAMED.replace("FROM orders", "FROM {orders}"), orders=table(spark, folder, "orders"))
    name = F.col("name")
    return names.select(
        "name", normalized_text(name).alias("by_run"), normalized_text(name, per_character=True).alias("by_character")
    )


@check(
    """SELECT CAST(c_acctbal AS DECIMAL(15,2)) AS balance, c_custkey, c_name, CAST(NULL AS BIGINT) AS id,
              CAST(NULL AS VARCHAR) AS id_log, CAST(NULL AS VARCHAR) AS uf FROM customer"""
)
def sorted_columns(spark, folder):
    customers = table(spark, folder, "customer").selectExpr(
        "c_name", "c_custkey", "CAST(c_acctbal AS DECIMAL(15,2)) AS balance"
    )
    return sc.sorted_columns(customers)


@check(
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_totalprice > 400000 THEN 'ERRO_TIPO' END AS new_price_error FROM orders"""
)
def drop_empty_columns(spark, folder):
    orders = table(spark, folder, "orders").selectExpr(
        "o_orderkey",
        "o_orderstatus",
        "CASE WHEN o_totalprice > 400000 THEN 'ERRO_TIPO' END AS new_price_error",
        "CASE WHEN o_totalprice < 0 THEN 'ERRO_TIPO' END AS new_status_error",
    )
    return sc.drop_empty_columns(orders)


@check(from_raw("sequencia, trim(cnes) AS cnes, trim(val_tot) AS val_tot, trim(dt_inter) AS dt_inter, trim(espec) AS espec"))
def trim_text(spark, folder):
    return cl.trim_text(raw_orders(spark, folder).select("sequencia", "cnes", "val_tot", "dt_inter", "espec"))


_BLANK = "CASE WHEN trim({c}) NOT IN ('', 'NaN', 'None') THEN trim({c}) END AS {c}"


@check(from_raw("sequencia, " + ", ".join(_BLANK.format(c=c) for c in ("val_tot", "dt_inter", "munic_res"))))
def blank_to_null(spark, folder):
    return cl.blanks_to_null(raw_orders(spark, folder).select("sequencia", "val_tot", "dt_inter", "munic_res"))


@check(
    """SELECT d.doc_id, trim(coalesce(CASE WHEN quality = 1 THEN concat(' ', lang) END, '')) AS lang,
              coalesce(toxic, 0) AS toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
)
def fill_nulls(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang")
    joined = documents.join(table(spark, folder, "labels"), "doc_id", "left").selectExpr(
        "doc_id", "CASE WHEN quality = 1 THEN concat(' ', lang) END AS lang", "toxic"
    )
    return cl.fill_nulls(joined)


@check(
    from_raw(
        "sequencia, "
        + ", ".join(_BLANK.format(c=c) for c in ("val_tot", "munic_res"))
        + ", CAST(try_strptime(trim(dt_inter), '%Y%m%d') AS DATE) AS dt_inter"
    )
)
def clean_frame(spark, folder):
    return cl.clean_frame(raw_orders(spark, folder).select("sequencia", "val_tot", "munic_res", "dt_inter"))


_PREPARED = """SELECT o_orderkey, concat(' ', replace(substr(CAST(o_orderdate AS STRING), 1, 10), '-', '')) AS padded,
    replace(substr(CAST(o_orderdate AS STRING), 1, 10), '-', '') AS ordered,
    CASE WHEN o_orderstatus = 'F' THEN NULL ELSE concat(o_orderpriority, '  ') END AS priority,
    CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_custkey END AS customer FROM orders"""


@check(
    f"""SELECT o_orderkey, trim(padded) AS padded, CAST(try_strptime(ordered, '%Y%m%d') AS DATE) AS ordered,
        trim(coalesce(priority, '')) AS priority, coalesce(customer, 0) AS customer FROM ({_PREPARED})"""
)
def preprocess(spark, folder):
    orders = table(spark, folder, "orders")
    return cl.preprocess(spark.sql(_PREPARED.replace("FROM orders", "FROM {orders}"), orders=orders))


@check(
    f"""SELECT 'padded' AS column_name, count(padded) AS n_present, CAST(0 AS BIGINT) AS n_dates, false AS is_date FROM ({_PREPARED})
        UNION ALL SELECT 'ordered', count(ordered), count(try_strptime(ordered, '%Y%m%d')), true FROM ({_PREPARED})
        UNION ALL SELECT 'priority', count(priority), 0, false FROM ({_PREPARED})"""
)
def date_likeness(spark, folder):
    rows = spark.sql(_PREPARED.replace("FROM orders", "FROM {orders}"), orders=table(spark, folder, "orders"))
    return cl.date_likeness(rows, ["padded", "ordered", "priority"])


@check(
    """SELECT * FROM (VALUES (0, 'o_orderkey', 'bigint', 'BIGINT'), (1, 'o_custkey', 'bigint', 'BIGINT'),
          (2, 'o_orderstatus', 'string', 'TEXT'), (3, 'o_totalprice', 'double', 'DOUBLE PRECISION'),
          (4, 'o_orderdate', 'timestamp_ntz', 'TIMESTAMP'), (5, 'o_orderpriority', 'string', 'TEXT'))
          t(position, column_name, spark_type, sql_type), (SELECT count(*) AS n_present FROM orders)"""
)
def describe_table(spark, folder):
    return sc.describe_columns(table(spark, folder, "orders"))


@check("SELECT l_orderkey, l_linenumber, l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem")
def type_map(spark, folder):
    """The frame's type map, changed by name and put back on the rows."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate")
    types = {**types_of(lines), "l_shipdate": "DATE"}
    typed = sinks.typed(lines, types)
    assert typed.schema.simpleString() == struct_of(types).simpleString()
    return typed


@check("SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def schema_ddl(spark, folder):
    """A table created from a type map, then filled."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    types = types_of(customers)
    name = sinks.fresh_name("ddl")
    sinks.create_from_types(spark, name, types, scratch_path(spark, name))
    assert spark_ddl(types) == ", ".join(f"`{c}` {t}" for c, t in spark.table(name).dtypes)
    sinks.append(customers, name)
    return spark.table(name)


@check(from_raw("sequencia, cnes, CAST(cnes ~ '^[0-9]{7}$' AS BOOLEAN) AS cnes_ok, "
                "coalesce(val_tot ~ '^[0-9]{7}$', false) AS val_ok"))
def valid_code_rule(spark, folder):
    from censa.operators.quality import valid_facility

    return raw_orders(spark, folder).select(
        "sequencia",
        "cnes",
        valid_facility(F.col("cnes")).alias("cnes_ok"),
        valid_facility(F.col("val_tot")).alias("val_ok"),
    )


@check("SELECT count(*) AS n_matching FROM orders")
def declared_types_match(spark, folder):
    """Rows of a table whose schema agrees with its declared types."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    wrong = {**RAW_TYPES, "o_orderkey": "SMALLINT"}
    matching = sc.matches_types(orders, types_of(orders)) and not sc.matches_types(orders, wrong)
    return orders.filter(F.lit(matching)).agg(F.count(F.lit(1)).alias("n_matching"))

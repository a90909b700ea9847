"""Filters, key joins, lookups, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from censa.functions.text import zero_fill
from censa.operators import joins, sets
from censa.operators.lookup import is_declared, table_of
from censa.operators.filters import keep_facilities, project, require, text_statistics
from censa.operators.cleaning import trim_text
from censa.plans.infer import build_registry
from censa.plans.load import loaded_files
from censa.sources.files import file_id
from censa.streaming.ledger import KEY, not_processed, progress_key
from checks import check, table
from checks.raw import from_raw, raw_orders
from checks.scans import LINEAGE

CODES = ["0000007", "0000042", "0000730", "0001111"]


@check(from_raw("val_tot, dt_inter, cnes") + " WHERE cnes IN ('0000007', '0000042', '0000730', '0001111')")
def entity_filter(spark, folder):
    raw = raw_orders(spark, folder)
    return project(keep_facilities(raw, "cnes", CODES), ["val_tot", "dt_inter"], "cnes")


@check(
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"""
)
def semi_entities(spark, folder):
    wanted = table(spark, folder, "customer").filter("c_mktsegment = 'BUILDING'")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return joins.semi_join(orders, wanted.select(F.col("c_custkey").alias("o_custkey")), "o_custkey")


@check(from_raw("""CAST(count(*) AS BIGINT) AS total_rows,
    CAST(count(*) FILTER (WHERE length(trim(val_tot)) > 0 OR length(trim(dt_inter)) > 0) AS BIGINT) AS rows_with_text"""))
def nonempty_stats(spark, folder):
    return text_statistics(trim_text(raw_orders(spark, folder).select("val_tot", "dt_inter")))


_LOADED = f"""SELECT id_log FROM ({LINEAGE}) WHERE id_log < 'RDSP98'"""


@check(
    f"""SELECT o_orderkey, id_arquivo FROM (
          SELECT o_orderkey, regexp_extract(id_log, '^(.*)_[0-9]+$', 1) AS id_arquivo FROM ({LINEAGE}))
        WHERE id_arquivo NOT IN (SELECT regexp_extract(id_log, '^(.*)_[0-9]+$', 1) FROM ({_LOADED}))"""
)
def anti_loaded(spark, folder):
    orders = table(spark, folder, "orders")
    rows = spark.sql(LINEAGE.replace("FROM orders", "FROM {orders}"), orders=orders)
    loaded = loaded_files(rows.filter("id_log < 'RDSP98'").select("id_log"))
    incoming = rows.select("o_orderkey", file_id(F.col("id_log")).alias("id_arquivo"))
    return joins.anti_join(incoming, loaded, "id_arquivo")


@check(
    """SELECT c_custkey, n_name AS state FROM customer
       JOIN nation ON lpad(CAST(c_nationkey AS VARCHAR), 2, '0') = lpad(CAST(n_nationkey AS VARCHAR), 2, '0')
       WHERE n_nationkey < 20"""
)
def state_decode(spark, folder):
    lookup = table(spark, folder, "nation").filter("n_nationkey < 20")
    states = lookup.select(zero_fill(F.col("n_nationkey").cast("string"), 2).alias("code"), F.col("n_name").alias("state"))
    customers = table(spark, folder, "customer").select(
        "c_custkey", zero_fill(F.col("c_nationkey").cast("string"), 2).alias("code")
    )
    return require(joins.decode(customers, states, "code"), ["state"]).select("c_custkey", "state")


@check("SELECT DISTINCT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS code FROM customer WHERE c_nationkey >= 20")
def unmapped_codes(spark, folder):
    lookup = table(spark, folder, "nation").filter("n_nationkey < 20")
    states = lookup.select(zero_fill(F.col("n_nationkey").cast("string"), 2).alias("code"))
    customers = table(spark, folder, "customer").select(zero_fill(F.col("c_nationkey").cast("string"), 2).alias("code"))
    return joins.unmapped(customers, states, "code")


# Part names play the tables, words the group descriptions; brands are the columns.
_WORDS = [("ring", "RG"), ("bolt", "BT"), ("red", "RD"), ("g", "GG")]


@check(
    """SELECT group_code, min(name) AS table_name, array_to_string(list_sort(list(DISTINCT p_brand)), ',') AS columns FROM (
         SELECT replace(p_name, ' ', '_') AS name, p_brand,
                CASE WHEN p_name LIKE '%ring%' THEN 'RG' WHEN p_name LIKE '%bolt%' THEN 'BT'
                     WHEN p_name LIKE '%red%' THEN 'RD' WHEN p_name LIKE '%g%' THEN 'GG' END AS group_code FROM part)
       WHERE group_code IS NOT NULL GROUP BY 1"""
)
def registry_match(spark, folder):
    parts = table(spark, folder, "part").select(
        F.col("p_name").alias("table_name"), F.col("p_brand").alias("column_name")
    )
    registry = build_registry(parts.distinct(), _WORDS)
    return registry.withColumn("columns", F.array_join("columns", ","))


@check(
    """SELECT doc_id, min_by(b.item_id, b.item_id) AS item_id FROM documents d
       JOIN (SELECT item_id, substr(text, 1, 40) AS start FROM benchmark WHERE text <> '') b ON contains(d.text, b.start) GROUP BY doc_id"""
)
def first_passage(spark, folder):
    """The first benchmark item whose opening words a document contains."""
    items = table(spark, folder, "benchmark").filter("text <> ''")
    patterns = items.select(F.substring("text", 1, 40).alias("text"), F.col("item_id").alias("code"), F.col("item_id").alias("position"))
    return joins.first_contained_in(table(spark, folder, "documents"), "text", patterns, "item_id").select("doc_id", "item_id")


@check(
    """SELECT DISTINCT concat_ws('-', o_orderpriority, CAST(year(o_orderdate) AS VARCHAR), CAST(month(o_orderdate) AS VARCHAR))
              AS progress_key FROM orders
       WHERE concat_ws('-', o_orderpriority, CAST(year(o_orderdate) AS VARCHAR), CAST(month(o_orderdate) AS VARCHAR)) NOT IN
         (SELECT concat_ws('-', o_orderpriority, CAST(year(o_orderdate) AS VARCHAR), CAST(month(o_orderdate) AS VARCHAR))
          FROM orders WHERE o_totalprice > 450000)"""
)
def progress_keys(spark, folder):
    keys = table(spark, folder, "orders").select(
        progress_key(F.col("o_orderpriority"), F.year("o_orderdate"), F.month("o_orderdate")).alias(KEY), "o_totalprice"
    )
    return not_processed(keys, keys.filter("o_totalprice > 450000"))


_A = "SELECT o_custkey AS code, o_orderstatus AS status FROM orders WHERE o_orderdate < DATE '1998-06-01'"
_B = "SELECT o_custkey AS code, o_orderstatus AS status, o_orderpriority FROM orders WHERE o_orderdate >= DATE '1998-06-01'"


def _versions(spark, folder):
    orders = table(spark, folder, "orders")
    return [spark.sql(q.replace("FROM orders", "FROM {orders}"), orders=orders) for q in (_A, _B)]


@check(f"SELECT code, status FROM ({_A}) INTERSECT SELECT code, status FROM ({_B})")
def intersect_tables(spark, folder):
    return sets.in_both(*_versions(spark, folder))


@check(f"SELECT code, status FROM ({_A}) UNION SELECT code, status FROM ({_B})")
def merge_distinct(spark, folder):
    return sets.merge_distinct(*_versions(spark, folder))


@check(f"SELECT code, status FROM ({_A}) EXCEPT SELECT code, status FROM ({_B})")
def except_tables(spark, folder):
    return sets.only_in_first(*_versions(spark, folder))


_CODES = """CASE o_orderpriority WHEN '1-URGENT' THEN 'rd' WHEN '2-HIGH' THEN 'AT' WHEN '3-MEDIUM' THEN ' AM '
    WHEN '4-NOT SPECIFIED' THEN 'A' ELSE 'ZZ' END"""


@check(
    f"""SELECT o_orderkey, CASE code WHEN 'rd' THEN 'sih_aih_reduzida' WHEN 'AT' THEN 'sia_apac_tratamento_dialitico'
          WHEN ' AM ' THEN 'sia_apac_medicamentos' WHEN 'A' THEN 'sia_apac_cirurgia_bariatrica' END AS table_name
        FROM (SELECT o_orderkey, {_CODES} AS code FROM orders)"""
)
def schema_lookup(spark, folder):
    """Table of each order's group code: the exact group, else the first one the code starts."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.expr(_CODES).alias("code"))
    return orders.select("o_orderkey", table_of(F.col("code")).alias("table_name"))


_FIELDS = "CASE o_orderpriority WHEN '1-URGENT' THEN 'CNES' WHEN '2-HIGH' THEN 'val_tot' WHEN '3-MEDIUM' THEN 'Dt_Inter ' ELSE o_orderstatus END"


@check(f"SELECT o_orderkey, lower(trim({_FIELDS})) IN ('cnes', 'val_tot', 'dt_inter') AS declared FROM orders")
def valid_columns(spark, folder):
    """Whether each order's column name is one of the hospital group's."""
    return table(spark, folder, "orders").select("o_orderkey", is_declared(F.expr(_FIELDS), "RD").alias("declared"))

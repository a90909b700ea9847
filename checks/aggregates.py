"""Counts, reports, numbering."""

from __future__ import annotations

from pyspark.sql import functions as F

from censa.operators import ordering, reports
from checks import check, table


@check("SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark, folder):
    return reports.row_count(table(spark, folder, "lineitem"))


@check("SELECT CAST(max(l_shipdate) AS DATE) AS last_date FROM lineitem")
def last_date(spark, folder):
    return reports.last_date(table(spark, folder, "lineitem"), "l_shipdate")


_LINES = """SELECT year(l_shipdate) AS ano, month(l_shipdate) AS mes, l_suppkey AS hospital,
    lpad(CAST(l_partkey AS STRING), 10, '0') AS proc FROM lineitem"""
_MONTHS = ", ".join(f"count(*) FILTER (WHERE mes = {m}) AS m{m:02d}" for m in range(1, 13))
_CROSSTAB = f"""SELECT CAST(ano AS INTEGER) AS year, hospital, proc AS procedure, {_MONTHS},
    count(*) FILTER (WHERE mes BETWEEN 1 AND 12) AS total, substr(proc, 1, 2) AS procedure_group
    FROM ({_LINES}) GROUP BY ano, hospital, proc"""


def _crosstab(spark, folder):
    lines = spark.sql(_LINES.replace("FROM lineitem", "FROM {lines}"), lines=table(spark, folder, "lineitem"))
    return reports.monthly_crosstab(lines, "ano", "hospital", "proc", "mes")


@check(_CROSSTAB)
def monthly_crosstab(spark, folder):
    return reports.sorted_report(_crosstab(spark, folder))


@check(
    f"""SELECT year, hospital, count(*) AS n_procedures, count(DISTINCT procedure_group) AS n_groups,
        CAST(sum(total) AS BIGINT) AS grand_total FROM ({_CROSSTAB}) GROUP BY 1, 2"""
)
def report_totals(spark, folder):
    return reports.report_totals(_crosstab(spark, folder))


@check(
    """SELECT l_returnflag, l_linestatus, count(*) AS n_rows, CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(25,2)) AS sum_price
       FROM lineitem GROUP BY 1, 2"""
)
def group_fields(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_returnflag", "l_linestatus", F.col("l_extendedprice").cast("decimal(15,2)").alias("price")
    )
    return reports.group_fields(lines, ["l_returnflag", "l_linestatus"], ["price"])


@check("SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem")
def surrogate_id(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return ordering.ensure_id(lines, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@check("SELECT count(*) AS n_rows, count(*) AS n_ids FROM orders")
def sparse_ids(spark, folder):
    ids = ordering.sparse_ids(table(spark, folder, "orders").select("o_orderkey"))
    repeated = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return repeated.agg(F.sum("n").alias("n_rows"), F.count("id").alias("n_ids"))


@check(
    """SELECT o_orderkey, o_custkey FROM orders
       ORDER BY md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), '1')), o_orderkey, o_custkey LIMIT 100"""
)
def seeded_sample(spark, folder):
    return ordering.seeded_sample(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), 100)


@check("SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders")
def distinct_values(spark, folder):
    return table(spark, folder, "orders").select("o_orderpriority", "o_orderstatus").distinct()

"""Table and file sinks: written in full, read back, compared with the source rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from censa.operators.cleaning import trim_text
from censa.operators.conversion import convert_with_errors, error_columns
from censa.operators.joins import decode
from censa.operators.reports import monthly_crosstab
from censa.session import scratch_path
from censa.sinks import files as fs
from censa.sinks import tables as ts
from checks import check, table
from checks.aggregates import _CROSSTAB, _LINES
from checks.profiles import _CUSTOMER, _customer_profile, _readable, profile_sql
from checks.raw import FAILS_SQL, RAW_TYPES, VALUE_SQL, from_raw, raw_orders


@check(
    from_raw(
        f"""sequencia, {VALUE_SQL['cnes']} AS cnes, {VALUE_SQL['val_tot']} AS val_tot,
        CASE WHEN {FAILS_SQL['val_tot']} THEN 'ERRO_TIPO' END AS new_val_tot_error"""
    )
)
def publish_table(spark, folder):
    raw = trim_text(raw_orders(spark, folder).select("sequencia", "cnes", "val_tot"))
    converted = convert_with_errors(raw, RAW_TYPES)
    return ts.publish(
        converted, ts.fresh_name("published"), scratch_path(spark, "publish"), optional=error_columns(converted)
    ).table


@check("SELECT c_custkey AS code, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def append_table(spark, folder):
    name = ts.fresh_name("appended")
    customers = table(spark, folder, "customer").selectExpr("c_custkey AS code", "c_name AS name")
    ts.create_or_append(customers, name, scratch_path(spark, name))
    ts.create_or_append(table(spark, folder, "supplier").selectExpr("s_name AS name", "s_suppkey AS code"), name)
    return spark.table(name)


@check("SELECT o_orderkey, o_orderstatus FROM orders")
def empty_like(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    name = ts.fresh_name("empty")
    empty = ts.empty_like(orders, name, scratch_path(spark, name))
    ts.reconcile(0, empty.count())
    ts.append(orders, name)
    return spark.table(name)


@check(
    """SELECT c_custkey AS code, CAST(NULL AS INTEGER) AS nation FROM customer
       UNION ALL SELECT s_suppkey, s_nationkey FROM supplier"""
)
def evolve_table(spark, folder):
    name = ts.fresh_name("evolved")
    ts.create_or_append(table(spark, folder, "customer").selectExpr("c_custkey AS code"), name, scratch_path(spark, name))
    incoming = table(spark, folder, "supplier").selectExpr("s_nationkey AS nation", "s_suppkey AS code")
    ts.evolve_and_append(incoming, name)
    return spark.table(name)


@check("SELECT s_suppkey, s_name FROM supplier")
def swap_table(spark, folder):
    current, new = ts.fresh_name("current"), ts.fresh_name("new")
    customers = table(spark, folder, "customer").selectExpr("c_custkey AS s_suppkey", "c_name AS s_name")
    ts.create_or_append(customers, current, scratch_path(spark, current))
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    ts.create_or_append(suppliers, new, scratch_path(spark, new))
    ts.swap(spark, new, current)
    return spark.table(current)


@check("SELECT count(*) AS n_rows FROM lineitem")
def reconcile(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    published = ts.publish(lines, ts.fresh_name("lines"), scratch_path(spark, "lines"))
    rows = ts.reconcile(lines.count(), published.n_rows)
    return published.table.agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") == rows)


@check("SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def export_csv(spark, folder):
    path = scratch_path(spark, "csv")
    fs.export_csv(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), path)
    return spark.read.option("header", True).schema(
        "o_orderkey bigint, o_orderstatus string, o_orderpriority string"
    ).csv(path)


_LINES_IN_ORDER = """SELECT (row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1) // 7000 AS chunk,
    l_shipdate, l_orderkey FROM lineitem"""


@check(
    f"""SELECT CAST(chunk AS INTEGER) AS chunk, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_files, CAST(min(l_shipdate) AS DATE) AS first, CAST(max(l_shipdate) AS DATE) AS last
        FROM ({_LINES_IN_ORDER}) GROUP BY 1"""
)
def export_chunks(spark, folder):
    """Chunks of exactly 7000 lines in the order of the frame, one file each."""
    path = scratch_path(spark, "chunks")
    lines = table(spark, folder, "lineitem").orderBy("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    fs.export_chunks(lines.select("l_orderkey", F.col("l_shipdate").cast("date").alias("l_shipdate")), path, 7000)
    written = spark.read.option("header", True).schema("l_orderkey bigint, l_shipdate date, chunk int").csv(path)
    per_file = written.groupBy("chunk", F.col("_metadata.file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last")
    )
    return per_file.groupBy("chunk").agg(F.sum("n").alias("n_rows"), F.count("file").alias("n_files"), F.min("first").alias("first"), F.max("last").alias("last"))


@check(profile_sql("customer", _CUSTOMER))
def export_profile(spark, folder):
    """The profile as it reads back from the JSON file."""
    path = scratch_path(spark, "profile")
    profile = _customer_profile(spark, folder)
    fs.export_profile(profile, path)
    return _readable(spark.read.schema(profile.schema).json(path))


@check(
    """SELECT l_returnflag AS uf, count(*) AS n_rows, CAST(sum(l_linenumber) AS BIGINT) AS n_sum, count(*) AS n_in_folder
       FROM lineitem GROUP BY 1"""
)
def partition_by_state(spark, folder):
    path = scratch_path(spark, "states")
    lines = table(spark, folder, "lineitem").selectExpr("l_returnflag AS uf", "l_orderkey", "l_linenumber")
    fs.write_partitioned(lines, path, ["uf"])
    in_folder = F.col("_metadata.file_path").contains(F.concat(F.lit("/uf="), "uf", F.lit("/")))
    return spark.read.parquet(path).withColumn("in_folder", in_folder).groupBy("uf").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("l_linenumber").alias("n_sum"), F.count_if("in_folder").alias("n_in_folder")
    )


@check("SELECT c_custkey AS code, c_nationkey AS nation FROM customer UNION ALL SELECT s_suppkey, s_nationkey FROM supplier")
def compact_files(spark, folder):
    parts, path = scratch_path(spark, "parts"), scratch_path(spark, "compact")
    table(spark, folder, "customer").selectExpr("c_custkey AS code", "c_nationkey AS nation").write.parquet(f"{parts}/a")
    table(spark, folder, "supplier").selectExpr("s_nationkey AS nation", "s_suppkey AS code").write.parquet(f"{parts}/b")
    fs.compact(spark.read.option("mergeSchema", True).parquet(f"{parts}/a", f"{parts}/b"), path)
    return spark.read.parquet(path)


@check(
    f"""SELECT year, s_nationkey AS hospital, procedure, CAST(sum(m01) AS BIGINT) AS m01, CAST(sum(m12) AS BIGINT) AS m12,
        CAST(sum(total) AS BIGINT) AS total FROM ({_CROSSTAB}) JOIN supplier ON s_suppkey = hospital GROUP BY 1, 2, 3"""
)
def report_files(spark, folder):
    """One folder per year and hospital; the supplier's nation plays the hospital."""
    path = scratch_path(spark, "report")
    lines = spark.sql(_LINES.replace("FROM lineitem", "FROM {lines}"), lines=table(spark, folder, "lineitem"))
    places = table(spark, folder, "supplier").selectExpr("s_suppkey AS hospital", "s_nationkey")
    placed = decode(lines, places, "hospital")
    fs.export_report(monthly_crosstab(placed, "ano", "s_nationkey", "proc", "mes"), path)
    months = ", ".join(f"m{m:02d} long" for m in range(1, 13))
    schema = f"procedure string, {months}, total long, procedure_group string, year int, hospital int"
    written = spark.read.option("header", True).schema(schema).csv(path)
    return written.select("year", "hospital", "procedure", "m01", "m12", "total")

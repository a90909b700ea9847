"""Scans, lineage and names."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from censa.functions.dates import month_of, period_start
from censa.operators.filters import in_months
from censa.operators.grid import absent, counted_on, expected_folders, month_grid
from censa.operators.joins import semi_join
from censa.operators.schema import union_all
from censa.registry.types import types_of
from censa.session import scratch_path
from censa.sources import files
from censa.sources.tables import run_query
from checks import check, table
from checks.raw import from_raw

FIRST, LAST = date(1996, 3, 1), date(1997, 2, 1)
GRID = date(1992, 1, 1), date(1998, 12, 1)


@check(
    """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date FROM orders
       WHERE o_orderdate >= DATE '1996-03-01' AND o_orderdate < DATE '1997-03-01'"""
)
def scan_period(spark, folder):
    orders = table(spark, folder, "orders").filter(in_months("o_orderdate", FIRST, LAST))
    return orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_date"))


@check(
    """SELECT c_custkey, c_nationkey FROM customer
       WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_name IN ('NATION_1', 'NATION_7', 'NATION_12'))"""
)
def scan_states(spark, folder):
    wanted = table(spark, folder, "nation").filter(F.col("n_name").isin("NATION_1", "NATION_7", "NATION_12"))
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return semi_join(customers, wanted.select(F.col("n_nationkey").alias("c_nationkey")), "c_nationkey")


@check(
    from_raw("CASE homonimo WHEN '1' THEN 'SP' WHEN '0' THEN 'RJ' ELSE 'MG' END AS uf, count(*) AS n_rows, CAST(2 AS BIGINT) AS n_folders") + " GROUP BY 1"
)
def discover_files(spark, folder):
    """Files of one group below a root that holds another group's and plain files too, with the rows they hold."""
    from checks.jobs import raw_folders

    root = raw_folders(spark, folder, scratch_path(spark, "raw"))
    supplier = table(spark, folder, "supplier")
    for name in ("SIH/RJ/RJSP9703.parquet", "SIH/RD/notes.parquet", "RDXX9703.parquet"):
        supplier.write.parquet(f"{root}/{name}")
    listed = files.discover_files(spark, root, "RD").select("id_arquivo", "uf", "folder")
    rows = files.with_lineage(spark.read.schema("SEQUENCIA string").option("recursiveFileLookup", True).parquet(root), columns=["id_arquivo"])
    counts = rows.groupBy("id_arquivo").agg(F.count(F.lit(1)).alias("n")).join(listed, "id_arquivo")
    by_folder = counts.groupBy("uf", "folder").agg(F.sum("n").alias("n"))
    return by_folder.groupBy("uf").agg(F.sum("n").alias("n_rows"), F.count("folder").alias("n_folders"))


@check("SELECT o_orderstatus, count(*) AS n_rows FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders) GROUP BY 1")
def read_concat(spark, folder):
    both = files.read_concat(spark, f"{folder}/orders.parquet", f"{folder}/orders.parquet")
    return both.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"))


@check(
    """SELECT CAST(i AS BIGINT) AS batch_no, CAST(least(n - i * 5000, 5000) AS BIGINT) AS n_rows
       FROM (SELECT n, unnest(range(0, CAST(ceil(n / 5000.0) AS BIGINT))) AS i
             FROM (SELECT count(*) AS n FROM lineitem))"""
)
def batch_sizes(spark, folder):
    sizes = files.batch_sizes(table(spark, folder, "lineitem"), 5000)
    return sizes.select("batch_no", "n_rows")


@check(
    """SELECT row_number() OVER () - 1 AS row_index, o_orderkey,
              CAST(floor((row_number() OVER () - 1) / 10000) AS BIGINT) AS batch_no FROM orders"""
)
def batch_no(spark, folder):
    numbered = files.row_batches(table(spark, folder, "orders"))
    return numbered.select(F.col("_metadata.row_index").alias("row_index"), "o_orderkey", "batch_no")


@check(
    """SELECT o_orderkey, concat('orders.parquet_', CAST(row_number() OVER () - 1 AS VARCHAR)) AS id_log,
              'orders.parquet' AS id_arquivo FROM orders"""
)
def row_lineage(spark, folder):
    """Lineage key of each order, without the name of the data folder."""
    rows = files.with_lineage(table(spark, folder, "orders"), columns=["id_log"])
    name = folder.rstrip("/").split("/")[-1] + "_"
    own = F.substr("id_log", F.lit(len(name) + 1))
    return rows.select("o_orderkey", own.alias("id_log"), files.file_id(own).alias("id_arquivo"))


@check(
    """SELECT column_name, count(*) AS n_present FROM (
         SELECT 'c_custkey' AS column_name FROM customer UNION ALL SELECT 'c_nationkey' FROM customer
         UNION ALL SELECT 's_suppkey' FROM supplier UNION ALL SELECT 's_nationkey' FROM supplier) GROUP BY 1"""
)
def merged_schema(spark, folder):
    """Two files of different schemas read as one; values present per merged column."""
    root = scratch_path(spark, "merged")
    table(spark, folder, "customer").select("c_custkey", "c_nationkey").write.parquet(f"{root}/a.parquet")
    table(spark, folder, "supplier").select("s_suppkey", "s_nationkey").write.parquet(f"{root}/b.parquet")
    paths = [f"{root}/a.parquet", f"{root}/b.parquet"]
    columns = files.merged_columns(spark, *paths)
    merged = files.read_concat(spark, *paths, merge_schema=True)
    counts = merged.agg(*[F.count(c).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "n_present")


@check("SELECT s_suppkey, s_nationkey FROM supplier")
def valid_files(spark, folder):
    """Of two files, only the one with the declared columns is read."""
    suppliers = table(spark, folder, "supplier")
    types = types_of(suppliers)
    paths = [f"{folder}/supplier.parquet", f"{folder}/nation.parquet"]
    return files.read_valid(spark, paths, types).select("s_suppkey", "s_nationkey")


@check(
    """SELECT c_custkey AS code, c_nationkey AS nation, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_nationkey, NULL FROM supplier"""
)
def union_sources(spark, folder):
    customers = table(spark, folder, "customer").selectExpr(
        "c_custkey AS code", "c_nationkey AS nation", "c_mktsegment AS segment"
    )
    suppliers = table(spark, folder, "supplier").selectExpr("s_suppkey AS code", "s_nationkey AS nation")
    return union_all([customers, suppliers])


@check("SELECT o_orderpriority, count(*) AS n_rows FROM orders WHERE o_totalprice > 250000 GROUP BY 1")
def param_sql(spark, folder):
    return run_query(
        spark,
        "SELECT o_orderpriority, count(*) AS n_rows FROM {orders} WHERE o_totalprice > :least GROUP BY 1",
        {"least": 250000},
        orders=table(spark, folder, "orders"),
    )


@check(
    """WITH seen AS (SELECT c_nationkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n
                     FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
            months AS (SELECT CAST(unnest(generate_series(DATE '1992-01-01', DATE '1998-12-01', INTERVAL 1 MONTH)) AS DATE) AS month)
       SELECT n_nationkey, months.month, coalesce(n, 0) AS n_orders
       FROM nation CROSS JOIN months LEFT JOIN seen ON c_nationkey = n_nationkey AND seen.month = months.month"""
)
def expected_grid(spark, folder):
    """Every state and month of a period with its rows, zero where there are none."""
    orders = table(spark, folder, "orders").select("o_custkey", month_of(F.col("o_orderdate")).alias("month"))
    # Orders are combined per customer and month before the join with the customers.
    per_customer = orders.groupBy(F.col("o_custkey").alias("c_custkey"), "month").agg(F.count(F.lit(1)).alias("n"))
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    seen = (
        per_customer.join(customers, "c_custkey")
        .groupBy(F.col("c_nationkey").alias("n_nationkey"), "month")
        .agg(F.sum("n").alias("n_orders"))
    )
    grid = month_grid(table(spark, folder, "nation").select("n_nationkey"), *GRID)
    return counted_on(grid, seen, ["n_nationkey", "month"], ["n_orders"])


@check(
    """WITH months AS (SELECT CAST(unnest(generate_series(DATE '1992-01-01', DATE '1998-12-01', INTERVAL 1 MONTH)) AS DATE) AS month),
            seen AS (SELECT DISTINCT CASE o_orderstatus WHEN 'F' THEN 'SP' WHEN 'O' THEN 'RJ' ELSE 'MG' END AS state,
                     CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders)
       SELECT 'RD' AS "group", state, month, concat('RD', state, strftime(month, '%y%m'), '.parquet') AS name
       FROM (VALUES ('SP'), ('RJ'), ('MG'), ('AC')) s(state) CROSS JOIN months
       WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.state = s.state AND seen.month = months.month)"""
)
def absent_files(spark, folder):
    """Expected folders of a group, states and period that no order belongs to."""
    state = F.expr("CASE o_orderstatus WHEN 'F' THEN 'SP' WHEN 'O' THEN 'RJ' ELSE 'MG' END")
    seen = table(spark, folder, "orders").select(state.alias("state"), month_of(F.col("o_orderdate")).alias("month"))
    return absent(expected_folders(spark, "RD", ["SP", "RJ", "MG", "AC"], *GRID), seen, ["state", "month"])


# Names of monthly files derived from the orders: one per state and month.
_NAMES = """SELECT DISTINCT concat('BI', CASE o_orderstatus WHEN 'F' THEN 'SP' WHEN 'O' THEN 'RJ' ELSE 'mg' END,
    substr(CAST(o_orderdate AS STRING), 3, 2), substr(CAST(o_orderdate AS STRING), 6, 2), {suffix}, '.parquet') AS name
    FROM orders"""
_SUFFIX = "CASE WHEN o_orderpriority = '1-URGENT' THEN '_1' ELSE '' END"


def _names(spark, folder):
    return spark.sql(
        _NAMES.format(suffix=_SUFFIX).replace("FROM orders", "FROM {orders}"),
        orders=table(spark, folder, "orders"),
    )


@check(
    f"""SELECT name, CASE WHEN upper(substr(name, 1, 2)) = 'BI' THEN upper(substr(name, 3, 2)) END AS uf,
        upper(substr(name, 3, 2)) AS named_uf, substr(name, 5, 4) AS yymm FROM ({_NAMES.format(suffix=_SUFFIX)})"""
)
def extract_state(spark, folder):
    name = F.col("name")
    return _names(spark, folder).select(
        "name",
        files.extract_state(name, "BI").alias("uf"),
        files.name_part(name, None, 2).alias("named_uf"),
        files.name_part(name, "BI", 3).alias("yymm"),
    )


@check(
    f"""SELECT name, CAST(CASE WHEN y >= 90 THEN 1900 + y ELSE 2000 + y END AS INTEGER) AS year,
        make_date(CASE WHEN y >= 90 THEN 1900 + y ELSE 2000 + y END, CAST(substr(name, 7, 2) AS INTEGER), 1) AS month
        FROM (SELECT name, CAST(substr(name, 5, 2) AS INTEGER) AS y FROM ({_NAMES.format(suffix=_SUFFIX)}))"""
)
def period_from_name(spark, folder):
    yymm = files.name_part(F.col("name"), "BI", 3)
    return _names(spark, folder).select(
        "name", files.year_of_name(yymm).alias("year"), period_start(yymm).alias("month")
    )


# Lineage keys of order lines: one file per order month, numbered rows.
LINEAGE = """SELECT concat('RDSP', substr(CAST(o_orderdate AS STRING), 3, 2), substr(CAST(o_orderdate AS STRING), 6, 2),
    '.parquet_part_', CAST(o_custkey % 3 AS STRING), '.parquet_', CAST(o_orderkey AS STRING)) AS id_log, o_orderkey
    FROM orders"""


@check(f"SELECT DISTINCT regexp_extract(id_log, '^(.*)_[0-9]+$', 1) AS id_arquivo FROM ({LINEAGE})")
def distinct_files(spark, folder):
    rows = spark.sql(LINEAGE.replace("FROM orders", "FROM {orders}"), orders=table(spark, folder, "orders"))
    return rows.select(files.file_id(F.col("id_log")).alias("id_arquivo")).distinct()

"""Whole jobs over group folders that hold all order lines in the raw layout."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from censa.plans import consolidate as consolidation
from censa.plans import extract, infer, load, merge, monthly, report, upload
from censa.registry.groups import Request
from censa.session import scratch_path
from censa.sinks import tables as ts
from censa.sources.files import scan_request
from censa.streaming.incremental import load_new_files, stream_group
from checks import check, table
from checks.raw import FAILS_SQL, RAW_TYPES, VALUE_SQL, from_raw, raw_orders

# The order status plays the state, the order date's half of the period the month.
_FOLDERS = [
    ("SP", "9703", "homonimo = '1' AND sequencia_half = 0"),
    ("RJ", "9703", "homonimo = '0' AND sequencia_half = 0"),
    ("MG", "9703", "homonimo = '2' AND sequencia_half = 0"),
    ("SP", "9811", "homonimo = '1' AND sequencia_half = 1"),
    ("RJ", "9811", "homonimo = '0' AND sequencia_half = 1"),
    ("MG", "9811", "homonimo = '2' AND sequencia_half = 1"),
]
_STATE = "CASE homonimo WHEN '1' THEN 'SP' WHEN '0' THEN 'RJ' ELSE 'MG' END"
# Raw dates that parse and lie after 1998-05 go to the second month.
_HALF = "CASE WHEN substr(dt_inter, 1, 6) > '199805' THEN 1 ELSE 0 END"
_MONTH = f"CASE WHEN {_HALF} = 1 THEN DATE '1998-11-01' ELSE DATE '1997-03-01' END"
_RD_COLUMNS = ["sequencia", "cnes", "val_tot", "dt_inter", "qt_diarias", "munic_res", "homonimo", "espec"]

# The bulk load declares the facility code as a number.
_LOADED_SQL = {**VALUE_SQL, "cnes": f"TRY_CAST({VALUE_SQL['cnes']} AS INTEGER)"}


def raw_folders(spark, folder, root: str, months: tuple[str, ...] = ("9703", "9811")) -> str:
    """Write all raw records as RD folders below ``root`` and return it."""
    raw = raw_orders(spark, folder).withColumn("sequencia", F.col("sequencia").cast("string"))
    raw = raw.withColumn("sequencia_half", F.expr(_HALF))
    for state, month, rule in _FOLDERS:
        if month in months:
            rows = raw.filter(rule).drop("sequencia_half")
            rows.toDF(*[c.upper() for c in rows.columns]).write.parquet(f"{root}/SIH/RD/RD{state}{month}.parquet")
    return root


def _request(**changes) -> Request:
    arguments = {
        "base": "SIH",
        "group": "RD",
        "facilities": ["*"],
        "fields": ["SEQUENCIA", "VAL_TOT", "DT_INTER"],
        "period_start": "01/1997",
        "period_end": "12/1998",
        "table_name": ts.fresh_name("rd"),
    }
    return Request(**{**arguments, **changes})


@check(from_raw(f"{_STATE} AS uf, {_MONTH} AS competencia, CAST(count(*) AS BIGINT) AS n_rows") + " WHERE homonimo <> '2' GROUP BY 1, 2")
def folder_scan(spark, folder):
    """Folders selected by state and month; a month without folders adds nothing."""
    root = raw_folders(spark, folder, scratch_path(spark, "raw"))
    raw = scan_request(spark, root, _request(states=["SP", "RJ", "AC"]))
    from censa.sources.files import with_lineage

    return with_lineage(raw, "RD").groupBy("uf", "competencia").agg(F.count(F.lit(1)).alias("n_rows"))


@check(
    from_raw(
        f"""sequencia AS "SEQUENCIA", {VALUE_SQL['val_tot']} AS "VAL_TOT",
        CASE WHEN {FAILS_SQL['val_tot']} THEN 'ERRO_TIPO' END AS "new_VAL_TOT_error",
        {VALUE_SQL['dt_inter']} AS "DT_INTER", CASE WHEN {FAILS_SQL['dt_inter']} THEN 'ERRO_TIPO' END AS "new_DT_INTER_error",
        cnes AS "CNES\""""
    )
    + " WHERE cnes IN ('0000007', '0000042', '0000730')"
)
def extract_request(spark, folder):
    """Scan, filter, trim, convert, drop empty error columns, publish."""
    root = raw_folders(spark, folder, scratch_path(spark, "raw"))
    request = _request(facilities=["0000007", "0000042", "0000730"])
    return extract.extract_to_table(spark, root, request, scratch_path(spark, "out")).table


@check(
    from_raw(
        f"{_STATE} AS uf, {_MONTH} AS competencia, "
        + ", ".join(f"{_LOADED_SQL[c]} AS {c}" for c in _RD_COLUMNS)
        + ", CAST(NULL AS VARCHAR) AS diag_princ, true AS lineage_ok"
    )
)
def load_files(spark, folder):
    """Raw folders loaded in two steps; the second load takes only the new month."""
    root, target = scratch_path(spark, "raw"), scratch_path(spark, "loaded")
    raw_folders(spark, folder, root, ("9703",))
    load.load_group(spark, root, "RD", target)
    raw_folders(spark, folder, root, ("9811",))
    load.load_group(spark, root, "RD", target)
    if load.load_group(spark, root, "RD", target):
        raise AssertionError("a loaded file was loaded again")
    loaded = load.loaded(spark, target)
    own = F.col("id_log").rlike("^RD[A-Z]{2}[0-9]{4}[.]parquet_.+[.]parquet_[0-9]+$")
    return loaded.select("uf", "competencia", *_RD_COLUMNS, "diag_princ", own.alias("lineage_ok"))


@check(
    from_raw(
        f"""{_STATE} AS uf, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_keys,
        CAST(2 AS BIGINT) AS n_files"""
    )
    + " GROUP BY 1"
)
def incremental_load(spark, folder):
    """Stream of new files, run three times: first month, second month, nothing."""
    root, target, state = (scratch_path(spark, n) for n in ("raw", "stream", "state"))
    schema = T.StructType([T.StructField(c.upper(), T.StringType()) for c in _RD_COLUMNS])

    def typed(batch):
        from censa.operators.conversion import convert_loader
        from censa.operators.schema import lower_names

        return convert_loader(lower_names(batch), RAW_TYPES)

    for months in (("9703",), ("9811",), ()):
        raw_folders(spark, folder, root, months)
        load_new_files(spark, root, schema, target, state, typed)
    loaded = spark.read.parquet(target)
    folders = F.regexp_extract("id_log", "^(RD[A-Z]{2}[0-9]{4})", 1)
    # Keys are counted by grouping first, so no task holds a state's keys.
    keys = loaded.groupBy("uf", folders.alias("name"), "id_log").agg(F.count(F.lit(1)).alias("n"))
    names = keys.groupBy("uf", "name").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("keys"))
    return names.groupBy("uf").agg(
        F.sum("n").alias("n_rows"), F.sum("keys").alias("n_keys"), F.count(F.lit(1)).alias("n_files")
    )


@check(
    """SELECT c_custkey AS code, c_name AS nome, CAST(NULL AS INTEGER) AS nation FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier"""
)
def upload_files(spark, folder):
    """Two uploads into one table; the second brings a new column."""
    root = scratch_path(spark, "up")
    table(spark, folder, "customer").selectExpr("c_custkey AS Code", "c_name AS Nome").write.parquet(f"{root}/a")
    table(spark, folder, "supplier").selectExpr(
        "s_suppkey AS Code", "s_name AS Nome", "s_nationkey AS Nation"
    ).write.parquet(f"{root}/b")
    name = ts.fresh_name("uploaded")
    ts.empty_like(table(spark, folder, "customer").selectExpr("c_custkey AS code", "c_name AS nome"), name,
                  scratch_path(spark, name))
    upload.upload(spark, [f"{root}/a"], name)
    return upload.upload(spark, [f"{root}/b"], name)


_OLD = """SELECT o_custkey AS code, o_orderstatus AS uf, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING) AS valor,
    replace(substr(CAST(o_orderdate AS STRING), 1, 10), '-', '') AS dia FROM orders WHERE o_orderdate < DATE '1999-01-01'"""
_NEW = _OLD.replace("FROM orders", ", o_orderpriority AS extra FROM orders").replace(
    "o_orderdate < DATE '1999-01-01'", "o_orderdate >= DATE '1998-01-01'"
)


@check(
    f"""SELECT DISTINCT code, uf, CAST(valor AS DECIMAL(10,2)) AS valor, CAST(strptime(dia, '%Y%m%d') AS DATE) AS dia
        FROM (SELECT code, uf, valor, dia FROM ({_OLD}) UNION ALL SELECT code, uf, valor, dia FROM ({_NEW}))"""
)
def merge_tables(spark, folder):
    """Two overlapping versions merged, typed and laid out by state, in place of the old one."""
    orders = table(spark, folder, "orders")
    names = []
    for label, query in (("old", _OLD), ("new", _NEW)):
        names.append(ts.fresh_name(label))
        rows = spark.sql(query.replace("FROM orders", "FROM {orders}"), orders=orders)
        ts.create_or_append(rows, names[-1], scratch_path(spark, label))
    types = {"valor": "NUMERIC(10,2)", "dia": "DATE"}
    return merge.merge_and_partition(spark, *names, names[1], scratch_path(spark, "merged"), types, "uf")


@check(
    """SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, CAST(NULL AS BIGINT) AS id,
              CAST(NULL AS VARCHAR) AS id_log, CAST(NULL AS VARCHAR) AS uf FROM
       (SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderstatus, o_orderpriority,
               CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DECIMAL(38,10)) AS o_totalprice FROM orders)"""
)
def infer_table(spark, folder):
    """Types inferred from the rows, a table made from them, the rows put in."""
    orders = table(spark, folder, "orders").selectExpr(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice"
    )
    types = infer.infer_types(orders)
    name = ts.fresh_name("inferred")
    ts.create_from_types(spark, name, types, scratch_path(spark, name))
    ts.append(orders, name)
    return spark.table(name).withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


_PROCEDURES = """SELECT lpad(CAST(l_partkey AS STRING), 10, '0') AS `Sp Procrea`, month(l_shipdate) AS `Sp Mm`,
    year(l_shipdate) AS `Sp Aa`, CAST(l_suppkey AS STRING) AS `Sp Cnes` FROM {lines}"""


@check(
    """SELECT year, hospital, count(*) AS n_procedures, count(DISTINCT substr(proc, 1, 2)) AS n_groups,
              CAST(sum(n) AS BIGINT) AS grand_total
       FROM (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(l_suppkey AS VARCHAR) AS hospital,
                    lpad(CAST(l_partkey AS VARCHAR), 10, '0') AS proc, count(*) AS n FROM lineitem GROUP BY 1, 2, 3)
       GROUP BY 1, 2"""
)
def report_job(spark, folder):
    """Report written per year; totals taken from the written files."""
    lines = spark.sql(_PROCEDURES, lines=table(spark, folder, "lineitem"))
    return report.write_report(lines, scratch_path(spark, "report"), per_hospital=False)


@check(
    from_raw(
        f"""CAST({_MONTH} AS VARCHAR) AS month, CAST(count(*) AS BIGINT) AS n_rows,
        CAST(count({VALUE_SQL['dt_inter']}) AS BIGINT) AS n_dates,
        CAST(count(CASE WHEN trim(val_tot) <> '' THEN 1 END) AS BIGINT) AS n_values"""
    )
    + " GROUP BY 1"
)
def monthly_export(spark, folder):
    """Clean, rename, date and export as CSV per month."""
    root = raw_folders(spark, folder, scratch_path(spark, "raw"))
    path = scratch_path(spark, "monthly")
    raw = scan_request(spark, root, _request(states=["SP", "RJ", "MG"]))
    monthly.export_monthly(raw, "RD", path)
    written = spark.read.option("header", True).csv(path)
    return written.groupBy(F.col("dataCompetencia").cast("string").alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("DT_INTER").alias("n_dates"),
        F.count("valorTotal").alias("n_values"),
    )


@check(
    from_raw(f"'RD' AS \"group\", {_STATE} AS uf, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(cnes) AS BIGINT) AS n_cnes")
    + " WHERE homonimo IN ('0', '1') GROUP BY 2"
)
def consolidate(spark, folder):
    """Two groups and years of two states in one table; the group without folders adds nothing."""
    root, name = raw_folders(spark, folder, scratch_path(spark, "raw")), ts.fresh_name("both")
    path = scratch_path(spark, "both")
    for years in ([1997], [1998]):
        if not consolidation.consolidate(spark, name, root, "SIH", years, [3, 11], ["RD", "ER"], ["SP", "RJ"], path=path):
            raise AssertionError("no folder was found")
    if consolidation.consolidate(spark, name, root, "SIH", [1996], [3], ["RD"], ["SP"], path=path):
        raise AssertionError("a folder was found that is not there")
    # As many rows of a state as the raw records have; states stand in the order of the flag.
    rows = spark.table(name).withColumn("uf", F.when(F.col("HOMONIMO") == "1", "SP").otherwise("RJ"))
    return rows.groupBy("group", "uf").agg(F.count(F.lit(1)).alias("n_rows"), F.count("CNES").alias("n_cnes"))


@check(
    from_raw(
        f"""CAST(sequencia AS VARCHAR) AS sequencia, homonimo, CASE WHEN {_HALF} = 1 AND trim(munic_res) IN ('None', '12.5') THEN NULL
            WHEN {_HALF} = 1 THEN CAST(CAST(munic_res AS INTEGER) AS VARCHAR) ELSE munic_res END AS munic_res, {_MONTH} AS competencia"""
    )
)
def drifting_types(spark, folder):
    """Months that hold the same columns as text and as numbers, in one scan request."""
    from censa.sources.files import with_lineage

    root = raw_folders(spark, folder, scratch_path(spark, "raw"), ("9703",))
    raw = raw_orders(spark, folder).withColumn("sequencia_half", F.expr(_HALF))
    for state, month, rule in _FOLDERS:
        if month == "9811":
            rows = raw.filter(rule).selectExpr("sequencia AS SEQUENCIA", "try_cast(homonimo AS int) AS HOMONIMO", "CASE WHEN munic_res NOT LIKE '%.%' THEN try_cast(munic_res AS int) END AS MUNIC_RES")
            rows.write.parquet(f"{root}/SIH/RD/RD{state}{month}.parquet")
    found = scan_request(spark, root, _request(states=["SP", "RJ", "MG"]), each=lambda scan: with_lineage(scan, "RD", ["competencia"]))
    return found.selectExpr("SEQUENCIA AS sequencia", "HOMONIMO AS homonimo", "MUNIC_RES AS munic_res", "competencia")


_KNOWN_STATES = ", ".join(str(int(code)) for code in load.STATE_CODES)


@check(
    f"""SELECT code, 'unknown' AS kind, count(*) AS n_rows FROM (SELECT CAST(c_nationkey AS VARCHAR) AS code FROM customer
          WHERE c_nationkey NOT IN ({_KNOWN_STATES}) UNION ALL SELECT CAST(s_nationkey AS VARCHAR) FROM supplier WHERE s_nationkey NOT IN ({_KNOWN_STATES}))
        GROUP BY 1
        UNION ALL SELECT CAST(c_nationkey AS VARCHAR), 'loaded', count(*) FROM (SELECT c_nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier)
        WHERE c_nationkey IN ({_KNOWN_STATES}) GROUP BY 1"""
)
def stream_unknown_states(spark, folder):
    """Two batches of a stream; the nation key plays the state code, and codes of no state are counted aside."""
    root, target, state = (scratch_path(spark, n) for n in ("raw", "stream", "state"))
    for name, key, month in (("customer", "c_nationkey", "9703"), ("supplier", "s_nationkey", "9811")):
        raw = table(spark, folder, name).selectExpr(f"CAST({key} AS STRING) AS SP_UF", f"CAST({key} AS STRING) AS SP_NAIH")
        raw.write.parquet(f"{root}/SPSP{month}.parquet")
        stream_group(spark, root, "SP", target, state)
    unknown = spark.read.parquet(f"{target}/{load.UNKNOWN_STATES}").groupBy("code").agg(F.sum("n_rows").alias("n_rows"))
    loaded = spark.read.parquet(target).groupBy(F.col("sp_naih").cast("string").alias("code")).agg(F.count(F.lit(1)).alias("n_rows"))
    return unknown.withColumn("kind", F.lit("unknown")).unionByName(loaded.withColumn("kind", F.lit("loaded")))


@check(
    f"""SELECT DISTINCT code, uf, CAST(valor AS DECIMAL(10,2)) AS valor, CAST(strptime(dia, '%Y%m%d') AS DATE) AS dia
        FROM (SELECT code, uf, valor, dia FROM ({_OLD}) UNION ALL SELECT code, uf, valor, dia FROM ({_NEW}) WHERE uf = 'F')"""
)
def merge_changed_states(spark, folder):
    """A version that is new for one state only: that state is merged and written, the others keep their folders."""
    orders = table(spark, folder, "orders")
    old = spark.sql(_OLD.replace("FROM orders", "FROM {orders}"), orders=orders)
    new = spark.sql(_NEW.replace("FROM orders", "FROM {orders}"), orders=orders).filter("uf = 'F'").drop("extra")
    first, version, target = (ts.fresh_name(n) for n in ("old", "version", "target"))
    types = {"valor": "NUMERIC(10,2)", "dia": "DATE"}
    ts.create_or_append(old, first, scratch_path(spark, "old"))
    merge.merge_and_partition(spark, first, first, target, scratch_path(spark, "merged"), types, "uf")
    rest = spark.table(target).filter("uf <> 'F'").selectExpr("code", "uf", "CAST(valor AS STRING) AS valor", "date_format(dia, 'yyyyMMdd') AS dia")
    ts.create_or_append(rest.unionByName(new), version, scratch_path(spark, "version"))
    written = merge.merge_changed(spark, target, version, scratch_path(spark, "changed"), types, "uf")
    if written != ["F"]:
        raise AssertionError(f"states {written} were written")
    return spark.table(target)

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from censa.operators import profile
from censa.session import scratch_path, shared_folder
from censa.sinks import files as fs
from censa.sinks import tables as ts
from censa.sources.tables import run_query, table_or_none
from conftest import rows


def test_scratch_lies_below_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named and scratch_path(spark, "x").startswith(f"{named}/x-")


def test_publish_applies_declared_types(spark, tmp_path):
    df = spark.createDataFrame([("1", "2.5", None)], "A string, b string, new_b_error string")
    out = ts.publish(df, "typed", str(tmp_path), {"a": "SMALLINT", "b": "NUMERIC(5,1)"}, ["new_b_error"])
    assert len(list(tmp_path.glob("typed-*"))) == 1
    for _ in range(3):
        out = ts.publish(df, "typed", str(tmp_path), {"a": "SMALLINT", "b": "NUMERIC(5,1)"}, ["new_b_error"])
        assert len(list(tmp_path.glob("typed-*"))) == 2  # the last replaced folder stays, older ones are gone
    assert out.n_rows == 1 and out.values == {"new_b_error": 0}
    assert out.table.dtypes == [("A", "smallint"), ("b", "decimal(5,1)")]


def test_append_orders_and_fills_columns(spark, tmp_path):
    ts.create_from_types(spark, "target", {"a": "INTEGER", "b": "TEXT"}, str(tmp_path / "t"))
    ts.append(spark.createDataFrame([("x", 1)], "B string, A long"), "target")
    ts.append(spark.createDataFrame([(2,)], "a int"), "target")
    assert rows(spark.table("target")) == [(1, "x"), (2, None)]
    assert ts.add_table_columns("target", spark.createDataFrame([], "A int, c date")) == ["c"]
    assert spark.table("target").dtypes == [("a", "int"), ("b", "string"), ("c", "date")]
    assert ts.empty_like(spark.table("target"), "like", str(tmp_path / "l")).dtypes == spark.table("target").dtypes


@pytest.mark.parametrize(("rows_", "lines"), [(25, 10), (100, 30), (30, 30), (0, 5), (7, 100)])
def test_csv_chunks_are_exact_and_in_order(spark, tmp_path, rows_, lines):
    df = spark.range(rows_).repartition(6).orderBy(F.desc("id")).selectExpr("id", "id * 2 AS chunks")
    fs.export_chunks(df, str(tmp_path / "c"), lines)
    want = list(range(rows_ - 1, -1, -1))
    folders = sorted((tmp_path / "c").glob("chunk=*"), key=lambda p: int(p.name.split("=")[1]))
    assert [p.name for p in folders] == [f"chunk={k}" for k in range(-(-rows_ // lines))]
    for k, folder in enumerate(folders):
        (written,) = folder.glob("*.csv")
        header, *body = written.read_text().splitlines()
        assert header == "id,chunks"
        assert [int(x.split(",")[0]) for x in body] == want[k * lines : (k + 1) * lines]
    assert not list(Path(scratch_path(spark, "x")).parent.glob("chunks-*"))


def test_partitioned_writes_make_few_files(spark, tmp_path):
    df = spark.range(0, 10000, numPartitions=16).selectExpr("CASE WHEN id % 3 = 0 THEN 'SP' ELSE 'RJ' END AS uf", "id")
    fs.write_partitioned(df, str(tmp_path / "p"))
    assert len(list((tmp_path / "p").glob("uf=*/*.parquet"))) <= 4
    back = spark.read.parquet(str(tmp_path / "p"))
    assert back.count() == 10000
    plan = back.filter("uf = 'SP'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(uf" in plan


def test_compact_keeps_all_rows(spark, tmp_path):
    df = spark.range(0, 1000, numPartitions=20)
    fs.compact(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1000
    assert len(list((tmp_path / "p").glob("*.parquet"))) == 1


def test_profile_json(spark, tmp_path):
    fs.export_profile(profile.column_profile(spark.createDataFrame([("x",)], "a string")), str(tmp_path / "j"))
    (part,) = (tmp_path / "j").glob("*.json")
    assert json.loads(part.read_text())["sample"] == ["x"]


def test_swap(spark, tmp_path):
    ts.create_or_append(spark.range(1), "now", str(tmp_path / "a"))
    ts.create_or_append(spark.range(2), "next", str(tmp_path / "b"))
    ts.swap(spark, "next", "now")
    assert spark.table("now").count() == 2 and table_or_none(spark, "next") is None


def test_query_parameters_are_values(spark):
    frame = spark.createDataFrame([("a",), ("' OR 1=1 --",)], "v string")
    got = run_query(spark, "SELECT v FROM {rows} WHERE v = :v", {"v": "' OR 1=1 --"}, rows=frame)
    assert rows(got) == [("' OR 1=1 --",)]


def test_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())

"""Replacing tables without a gap, whatever fails on the way."""

import pytest
from pyspark.sql import SparkSession

from censa.plans import merge
from censa.sinks import generations
from censa.sinks import tables as ts
from conftest import rows


class Broken(Exception):
    pass


def held(spark, name):
    return rows(spark.table(name).select("v"))


@pytest.fixture
def calls(spark, monkeypatch):
    """Catalog calls made by ``SparkSession.sql``; ``calls.fail`` breaks after that many, ``calls.look`` runs around each."""

    class Calls:
        n, fail, look = 0, None, staticmethod(lambda: None)

    sql, looking = SparkSession.sql, []

    def counted(self, text, *args, **kwargs):
        if looking:
            return sql(self, text, *args, **kwargs)
        looking.append(1)
        try:
            Calls.look()
            if Calls.fail is not None and Calls.n >= Calls.fail:
                raise Broken(text)
            Calls.n += 1
            out = sql(self, text, *args, **kwargs)
            Calls.look()
            return out
        finally:
            looking.clear()

    monkeypatch.setattr(type(spark), "sql", counted)
    return Calls


def replace_by_publish(spark, name, data, root):
    ts.publish(spark.createDataFrame(data, "v string, w int"), name, root)


def replace_by_swap(spark, name, data, root):
    other = ts.fresh_name("other")
    spark.createDataFrame(data, "v string").write.saveAsTable(other)
    ts.swap(spark, other, name)


def replace_by_swap_of_published(spark, name, data, root):
    other = ts.fresh_name("other")
    ts.create_or_append(spark.createDataFrame(data, "v string"), other)
    ts.swap(spark, other, name)


def replace_by_merge(spark, name, data, root):
    a, b = ts.fresh_name("a"), ts.fresh_name("b")
    for table in (a, b):
        ts.create_or_append(spark.createDataFrame([(v, "SP") for v, *_ in data], "v string, uf string"), table)
    merge.merge_and_partition(spark, a, b, name, f"{root}/{ts.fresh_name('merged')}", {}, "uf")


def replace_by_empty(spark, name, data, root):
    ts.empty_like(spark.createDataFrame(data, "v string"), name, f"{root}/empty")


WAYS = [replace_by_publish, replace_by_swap, replace_by_swap_of_published, replace_by_merge, replace_by_empty]


@pytest.mark.parametrize("way", WAYS)
def test_readers_find_old_or_new_rows_at_every_moment(spark, tmp_path, calls, way):
    name = ts.fresh_name("seen")
    ts.publish(spark.createDataFrame([("old", 1)], "v string, w int"), name, str(tmp_path))
    new = [] if way is replace_by_empty else [("new",), ("newer",)]
    found = []
    calls.look = lambda: found.append(held(spark, name))
    way(spark, name, [("new", 2), ("newer", 2)] if way is replace_by_publish else [("new",), ("newer",)], str(tmp_path))
    calls.look = lambda: None
    assert held(spark, name) == new and [("old",)] in found and all(x in ([("old",)], new) for x in found)
    # Once new rows were seen, the old ones do not come back.
    first = found.index(new) if new in found else len(found)
    assert all(x == new for x in found[first:])


@pytest.mark.parametrize("way", WAYS)
def test_a_failure_after_any_catalog_call_leaves_old_or_new_rows(spark, tmp_path, calls, way):
    name = ts.fresh_name("kept")
    ts.publish(spark.createDataFrame([("old", 1)], "v string, w int"), name, str(tmp_path))
    new = [] if way is replace_by_empty else [("new",), ("newer",)]
    data = [("new", 2), ("newer", 2)] if way is replace_by_publish else [("new",), ("newer",)]
    fails, shown = 0, False
    while True:
        calls.n, calls.fail = 0, fails
        try:
            way(spark, name, data, str(tmp_path))
            break
        except Broken as broken:
            calls.fail = None
            now = held(spark, name)
            shown = shown or now == new
            # The one call that shows the new rows did not run yet, or it did.
            assert now == (new if shown else [("old",)]), str(broken)
            if shown:  # the next round begins from old rows again
                ts.publish(spark.createDataFrame([("old", 1)], "v string, w int"), name, str(tmp_path))
                shown = False
        finally:
            calls.fail = None
        fails += 1
    assert fails >= 3 and held(spark, name) == new


def test_a_failing_write_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    name = ts.fresh_name("written")
    ts.publish(spark.createDataFrame([("old", 1)], "v string, w int"), name, str(tmp_path))
    monkeypatch.setattr(ts, "reconcile", lambda a, b: (_ for _ in ()).throw(ts.CountMismatch("x")))
    with pytest.raises(ts.CountMismatch):
        replace_by_publish(spark, name, [("new", 1)], str(tmp_path))
    assert held(spark, name) == [("old",)]


def test_the_replaced_rows_stay_for_running_queries(spark, tmp_path):
    name = ts.fresh_name("running")
    replace_by_publish(spark, name, [("1", 1)], str(tmp_path))
    began = spark.table(name)
    replace_by_publish(spark, name, [("2", 1)], str(tmp_path))
    assert rows(began) == [("1", 1)] and held(spark, name) == [("2",)]
    replace_by_publish(spark, name, [("3", 1)], str(tmp_path))
    assert len(list(tmp_path.glob(f"{name}-*"))) == 2
    shown = generations.generation(spark, name)
    generations.remove(spark, name, str(tmp_path))
    assert not spark.catalog.tableExists(name) and not spark.catalog.tableExists(shown) and not list(tmp_path.glob(f"{name}-*"))


def test_a_plain_table_becomes_a_published_one(spark, tmp_path):
    name = ts.fresh_name("plain")
    spark.createDataFrame([("old",)], "v string").write.saveAsTable(name)
    assert generations.generation(spark, name) is None and generations.location(spark, name)
    replace_by_swap(spark, name, [("new",)], None)
    assert held(spark, name) == [("new",)] and generations.generation(spark, name)
    ts.append(spark.createDataFrame([("more",)], "v string"), name)
    assert ts.add_table_columns(name, spark.createDataFrame([], "v string, x int")) == ["x"]
    ts.append(spark.createDataFrame([("last", 5)], "v string, x int"), name)
    assert rows(spark.table(name)) == [("last", 5), ("more", None), ("new", None)]


def folder_of(spark, name, state):
    found = spark.table(generations.generation(spark, name)).filter(f"uf = '{state}'").selectExpr("_metadata.file_path AS p").distinct().collect()
    return {r.p.rsplit("/", 2)[0] for r in found}


def test_merge_writes_changed_states_only(spark, tmp_path, monkeypatch):
    schema = "uf string, n string, d string"
    old = [("SP", "1", "20200101"), ("RJ", "2", "20200102"), ("MG", "3", "20200103"), (None, "4", "20200104"), ("D'A", "5", None)]
    a, b, target = (ts.fresh_name(x) for x in ("a", "b", "merged"))
    for name in (a, b):
        ts.create_or_append(spark.createDataFrame(old, schema), name)
    types = {"n": "INTEGER", "d": "DATE"}
    merge.merge_and_partition(spark, a, b, target, str(tmp_path / "1"), types, "uf")
    before = {s: folder_of(spark, target, s) for s in ("SP", "RJ", "MG")}
    written = []
    write = merge.write_partitioned
    monkeypatch.setattr(merge, "write_partitioned", lambda df, *args, **more: written.append({r.uf for r in df.select("uf").distinct().collect()}) or write(df, *args, **more))
    version = ts.fresh_name("version")
    # MG is absent, RJ has one more row (twice), SP, null and the quoted state are as they were, AC is new.
    new = [("SP", "1", "20200101"), ("RJ", "2", "20200102"), ("RJ", "7", None), ("RJ", "7", None), (None, "4", "20200104"), ("D'A", "5", None), ("AC", "9", None)]
    ts.create_or_append(spark.createDataFrame(new, schema).selectExpr("d", "n", "uf", "'x' AS more"), version)
    want = rows(merge.merge_versions(spark.table(target), merge.alter_types(spark.table(version), types), {}).merged.select("uf", "n", "d"))
    assert sorted(merge.merge_changed(spark, target, version, str(tmp_path / "2"), types, "uf")) == ["AC", "RJ"]
    assert written == [{"AC", "RJ"}] and rows(spark.table(target).select("uf", "n", "d")) == want
    after = {s: folder_of(spark, target, s) for s in ("SP", "RJ", "MG")}
    assert after["SP"] == before["SP"] and after["MG"] == before["MG"] and after["RJ"] != before["RJ"]
    # Nothing new, then only the null state.
    assert merge.merge_changed(spark, target, version, str(tmp_path / "3"), types, "uf") in ([], ["RJ"])
    ts.append(spark.createDataFrame([(None, "8")], "uf string, n string"), version)
    assert None in merge.merge_changed(spark, target, version, str(tmp_path / "4"), types, "uf")
    assert rows(spark.table(target).filter("uf IS NULL").select("n")) == [(4,), (8,)] and spark.table(target).count() == 8
    assert folder_of(spark, target, "SP") == before["SP"]

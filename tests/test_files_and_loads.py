import datetime as dt
import shutil

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from censa.operators.conversion import convert_loader
from censa.operators.schema import lower_names
from censa.operators.grid import absent, expected_folders
from censa.plans.consolidate import consolidated
from censa.plans import extract, infer, load, merge, monthly, report, upload
from censa.registry.groups import Request, group_types
from censa.sinks import generations
from censa.sinks import tables as ts
from censa.sources import drift, files
from censa.streaming import ledger
from censa.streaming.incremental import WITHOUT_STATE, load_new_files, stream_group
from conftest import rows

RD = "CNES string, N_AIH string, VAL_TOT string, DT_INTER string, ESPEC string"


def rd_rows(month, n=3):
    """Padded hospital records; every third has a broken value and a blank date."""
    return [
        (f"{2077480 + i}", f"{month}{i}  ", "     x" if i % 3 == 2 else f"   {i}.50", "        " if i % 3 == 2 else "20230115", " 03")
        for i in range(n)
    ]


def write(spark, path, data, schema=RD):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(path))


@pytest.fixture
def folders(spark, tmp_path):
    root = tmp_path / "parquet_files"
    write(spark, root / "SIH/RD/RDSP2301.parquet", rd_rows("a"))
    write(spark, root / "SIH/RD/RDSP2302.parquet", rd_rows("b", 4))
    write(spark, root / "SIH/RD/RDRJ2301.parquet", rd_rows("c", 2))
    write(spark, root / "SIH/RD/RDRJ9712.parquet", rd_rows("d", 1))
    write(spark, root / "SIH/RD/RDSP2301_1.parquet", rd_rows("e", 5))
    write(spark, root / "SIH/RJ/RJSP2301.parquet", rd_rows("f", 6))
    return root


def request(**changes):
    base = {"base": "SIH", "group": "RD", "facilities": ["*"], "fields": ["VAL_TOT"], "period_start": "01/2023", "period_end": "02/2023"}
    return Request(**{**base, **changes})


def per_folder(df):
    return dict(rows(files.with_lineage(df, "RD").groupBy(F.concat_ws(" ", "uf", "competencia")).count()))


def test_scan_takes_states_months_and_parts(spark, folders):
    assert per_folder(files.scan_request(spark, str(folders), request())) == {
        "SP 2023-01-01": 8, "SP 2023-02-01": 4, "RJ 2023-01-01": 2,
    }
    only = request(states=["RJ", "AC"], period_start="12/1997", period_end="01/2023")
    assert per_folder(files.scan_request(spark, str(folders), only)) == {"RJ 2023-01-01": 2, "RJ 1997-12-01": 1}


def test_scan_columns_and_empty_result(spark, folders):
    assert files.scan_request(spark, str(folders), request(), columns=["CNES"]).columns == ["CNES"]
    none = files.scan_request(
        spark, str(folders), request(states=["TO"]), types={"CNES": "TEXT", "VAL_TOT": "NUMERIC(15,2)"}
    )
    assert none.count() == 0 and none.columns == ["CNES", "VAL_TOT"]


def test_months_may_differ_in_columns(spark, folders):
    write(spark, folders / "SIH/RD/RDSP2212.parquet", [("2077480", "new")], "CNES string, EXTRA string")
    df = files.scan_request(spark, str(folders), request(period_start="12/2022", states=["SP"]))
    assert "EXTRA" in df.columns and df.filter("EXTRA = 'new'").count() == 1 and df.count() == 13
    assert files.scan_request(spark, str(folders), request(states=["AC"]), columns=["CNES"]).count() == 0


def test_scan_skips_corrupt_files(spark, folders):
    (folders / "SIH/RD/RDSP2302.parquet/part-bad.parquet").write_bytes(b"PAR1 this is no parquet file PAR1")
    df = files.scan_folders(
        spark, str(folders), "SIH", "RD", [dt.date(2023, 1, 1), dt.date(2023, 2, 1)], skip_corrupt=True
    )
    assert df.count() == 14


def test_discovery_and_state_names(spark, folders):
    found = files.discover_files(spark, str(folders / "SIH"), "RD")
    assert dict(rows(found.groupBy("uf").count())) == {"SP": 3, "RJ": 2}
    assert files.discover_files(spark, str(folders / "SIH")).count() == 6
    names = spark.createDataFrame([("rdsp2301.parquet",), ("RJSP2301",), ("RD2301",), ("ABOSP2303_1.parquet",)], "n string")
    got = names.select(
        files.extract_state(F.col("n"), "RD"), files.name_part(F.col("n"), None, 2), files.name_part(F.col("n"), None, 3)
    ).collect()
    assert [tuple(r) for r in got] == [("SP", "SP", "2301"), (None, None, None), (None, None, None), (None, "SP", "2303")]


def test_groups_with_codes_that_start_alike(spark, tmp_path):
    write(spark, tmp_path / "ABSP1610.parquet", [("1",)], "a string")
    write(spark, tmp_path / "ABOSP2303.parquet", [("1",), ("2",)], "a string")
    found = {g: files.discover_files(spark, str(tmp_path), g).select("folder", "uf") for g in ("AB", "ABO")}
    assert rows(found["AB"]) == [("ABSP1610.parquet", "SP")]
    assert rows(found["ABO"]) == [("ABOSP2303.parquet", "SP")]
    both = files.with_lineage(spark.read.parquet(str(tmp_path / "*.parquet"))).groupBy("uf").count()
    assert rows(both) == [("SP", 3)]


def test_state_from_a_name_without_a_month(spark, tmp_path):
    write(spark, tmp_path / "PARJ_total.parquet", [("1",)], "a string")
    got = files.with_lineage(spark.read.parquet(str(tmp_path / "PARJ_total.parquet")), "PA").first()
    assert (got.uf, got.competencia) == ("RJ", None)


def test_lineage_is_unique_and_names_the_file(spark, folders):
    rowset = files.with_lineage(files.scan_request(spark, str(folders), request()), "RD")
    assert rowset.select("id_log").distinct().count() == 14
    back = rowset.filter(files.file_id(F.col("id_log")) != F.col("id_arquivo")).count()
    assert back == 0
    first = rowset.filter("uf = 'RJ'").orderBy("id_log").first()
    assert first.id_log.startswith("RDRJ2301.parquet_part-") and first.id_log.endswith(".parquet_0")


def test_batches_and_valid_files(spark, folders):
    path = str(folders / "SIH/RD/RDSP2301_1.parquet")
    assert [r.n_rows for r in files.batch_sizes(spark.read.parquet(path), 2).orderBy("batch_no").collect()] == [2, 2, 1]
    bad = folders / "bad.parquet"
    bad.write_bytes(b"nothing")
    (valid,) = files.valid_paths(spark, [path, str(bad)], {"cnes": "TEXT", "VAL_TOT": "TEXT"})
    assert valid.startswith(f"file:{path}/part-")
    assert files.valid_paths(spark, [path], {"cnes": "TEXT", "absent": "TEXT"}) == []
    assert files.read_valid(spark, [path, str(bad)], {"cnes": "TEXT"}).count() == 5
    assert files.read_valid(spark, [str(bad)], {"cnes": "TEXT"}).count() == 0
    reasons = {r.path.rsplit("/", 1)[1]: r.reason for r in files.checked_files(spark, [path, str(bad)], {"absent": "TEXT"}).collect()}
    assert "absent" in reasons.pop(next(n for n in reasons if n.startswith("part-"))) and "Parquet" in reasons["bad.parquet"]


def test_a_valid_file_with_a_damaged_page_is_an_error(spark, tmp_path):
    for name in ("a", "b"):
        write(spark, tmp_path / name, [(f"{name}{i}",) for i in range(50)], "x string")
    (tmp_path / "a/no_parquet.parquet").write_bytes(b"nothing")
    paths, types = [str(tmp_path / "a"), str(tmp_path / "b")], {"x": "TEXT"}
    assert files.read_valid(spark, paths, types).count() == 100
    (part,) = (tmp_path / "b").glob("part-*.parquet")
    data = bytearray(part.read_bytes())
    data[4:64] = b"\xff" * 60
    part.write_bytes(data)
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    assert len(files.valid_paths(spark, paths, types)) == 2
    with pytest.raises(Exception, match="FAILED_READ_FILE|Could not read|decode|page"):
        files.read_valid(spark, paths, types).collect()


def test_a_store_that_cannot_be_reached_is_no_invalid_file(spark, folders, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    seen = {}
    monkeypatch.setattr(DataFrame, "mapInPandas", lambda self, run, schema: seen.setdefault("run", run) and self)
    files.file_columns(spark, str(folders))
    for path, kind in (("s4a://bucket/a.parquet", ValueError), ("file:/no/such/file.parquet", OSError)):
        with pytest.raises(kind):
            list(seen["run"]([pd.DataFrame({"path": [path]})]))


def test_merged_columns(spark, tmp_path):
    write(spark, tmp_path / "a", [("1", "2")], "x string, y string")
    write(spark, tmp_path / "b", [("3", "4")], "y string, z string")
    assert sorted(files.merged_columns(spark, str(tmp_path / "a"), str(tmp_path / "b"))) == ["x", "y", "z"]


def test_extract_publishes_once_and_drops_unused_flags(spark, folders, tmp_path):
    ask = request(facilities=["2077480", "2077482"], fields=["N_AIH", "VAL_TOT", "DT_INTER"], table_name="rd_out")
    done = extract.extract_to_table(spark, str(folders), ask, str(tmp_path / "out"))
    assert (done.n_rows, done.n_with_text) == (7, 7)
    assert done.errors == {
        "new_N_AIH_error": 0, "new_VAL_TOT_error": 3, "new_DT_INTER_error": 0, "new_CNES_error": 0,
    }
    out = done.table
    # Only VAL_TOT has errors; a blank date is no error.
    assert out.columns == ["N_AIH", "VAL_TOT", "new_VAL_TOT_error", "DT_INTER", "CNES"]
    assert out.filter("new_VAL_TOT_error = 'ERRO_TIPO'").count() == 3
    assert out.count() == 7 and {r.CNES for r in out.select("CNES").collect()} == {"2077480", "2077482"}
    again = extract.extract_to_table(spark, str(folders), ask, str(tmp_path / "out"))
    assert again.table.count() == 7


def test_extract_of_nothing_keeps_the_old_table(spark, folders, tmp_path):
    ask = request(fields=["N_AIH"], table_name="rd_held")
    held = extract.extract_to_table(spark, str(folders), ask, str(tmp_path / "out")).n_rows
    with pytest.raises(FileNotFoundError):
        extract.extract_to_table(spark, str(tmp_path / "elsewhere"), ask, str(tmp_path / "out"))
    assert spark.table("rd_held").count() == held > 0
    assert extract.extract_to_table(spark, str(tmp_path / "elsewhere"), ask, str(tmp_path / "out"), allow_missing=True).n_rows == 0


def test_extract_of_long_facility_list(spark, folders):
    codes = [f"{2077480 + i:07d}" for i in range(2000)]
    ask = request(facilities=codes)
    assert extract.extract(spark, str(folders), ask).count() == 14


def test_extract_grouped(spark, folders, tmp_path):
    ask = request(fields=["DT_INTER"], table_name="rd_grouped")
    out = extract.extract_to_table(spark, str(folders), ask, str(tmp_path / "out"), grouped=True).table
    assert rows(out) == [(None, 3), (dt.date(2023, 1, 15), 11)]


def test_load_is_incremental_and_typed(spark, folders, tmp_path):
    target = str(tmp_path / "target")
    assert load.load_group(spark, str(folders / "SIH/RD"), "RD", target) == 5
    assert load.load_group(spark, str(folders / "SIH/RD"), "RD", target) == 0
    write(spark, folders / "SIH/RD/RDMG2303.parquet", rd_rows("g", 2))
    write(spark, folders / "SIH/RD/RDSP2302.parquet", rd_rows("h", 1))  # a new part of a known folder
    assert load.load_group(spark, str(folders / "SIH/RD"), "RD", target) == 2
    loaded = load.loaded(spark, target)
    assert loaded.count() == 18 and loaded.select("id_log").distinct().count() == 18
    declared = {c: t.simpleString() for c, t in ((f.name, f.dataType) for f in loaded.schema.fields)}
    assert declared["val_tot"] == "decimal(14,2)" and declared["dt_inter"] == "date" and declared["n_aih"] == "bigint"
    assert set(group_types("RD")) <= set(loaded.columns)
    assert loaded.filter("uf = 'SP' AND cnes = 2077480 AND espec = '03'").count() >= 1


def test_loaded_files_from_lineage_alone(spark):
    df = spark.createDataFrame([("RDSP2301.parquet_x.parquet_0",), ("RDSP2301.parquet_x.parquet_12",)], "id_log string")
    assert rows(load.loaded_files(df)) == [("RDSP2301.parquet_x.parquet",)]


class Broken(Exception):
    pass


@pytest.fixture
def writes(monkeypatch):
    """Parquet writes of a load; ``writes.fail`` breaks after that many (the write itself is done)."""
    from pyspark.sql.readwriter import DataFrameWriter

    class Writes:
        n, fail = 0, None

    parquet = DataFrameWriter.parquet

    def counted(self, *args, **kwargs):
        parquet(self, *args, **kwargs)
        Writes.n += 1
        if Writes.fail is not None and Writes.n > Writes.fail:
            raise Broken

    monkeypatch.setattr(DataFrameWriter, "parquet", counted)
    return Writes


def test_a_load_that_fails_anywhere_and_is_repeated_loads_once(spark, tmp_path, writes):
    schema, source = "SP_UF string, SP_AA string, SP_DTINTER string", str(tmp_path / "src")
    write(spark, tmp_path / "src/SPSP1801.parquet", [("35", "2018", "20180122"), (" 12", "2018", "bad"), ("99", "2018", "x")], schema)
    target = str(tmp_path / "whole")
    load.load_group(spark, source, "SP", target)
    write(spark, tmp_path / "src/SPRJ1801.parquet", [("33", "2018", "20180122"), ("98", "2018", "x")], schema)
    write(spark, tmp_path / "src/SPSP1801.parquet", [("35", "2019", None), ("99", "2018", "x")], schema)
    for k in range(4):
        shutil.copytree(target, tmp_path / f"part{k}")
    assert load.load_group(spark, source, "SP", target) == 2

    def tables(path):
        found = [load.loaded(spark, path), *(load.committed(spark, path, part) for part in (load.TAKEN, load.UNKNOWN_STATES))]
        return [sorted(map(str, f.select(sorted(f.columns)).collect())) for f in found]

    want, before = tables(target), tables(str(tmp_path / "part0"))
    assert [len(x) for x in want] == [4, 3, 3] and [len(x) for x in before] == [2, 1, 1]
    for k in range(4):
        path = str(tmp_path / f"part{k}")
        writes.n, writes.fail = 0, k
        with pytest.raises(Broken):
            load.load_group(spark, source, "SP", path)
        writes.fail = None
        # Only the last write, the manifest, makes the load count.
        assert tables(path) == (want if k == 3 else before)
        assert load.load_group(spark, source, "SP", path) == (0 if k == 3 else 2)
        assert tables(path) == want
        assert len(list((tmp_path / f"part{k}").glob("load=*"))) == 2 and len(list((tmp_path / f"part{k}/_taken").glob("load=*"))) == 2


def test_a_load_hands_folders_and_not_files_to_the_reader(spark, tmp_path, monkeypatch):
    source = tmp_path / "src"
    for _ in range(6):
        write(spark, source / "RDSP2301.parquet", rd_rows("a"))
    write(spark, source / "RDRJ2301.parquet", rd_rows("b"))
    seen, plans = [], []
    read, prepare = load.read_drifting, load.prepare
    monkeypatch.setattr(load, "read_drifting", lambda spark, paths, *more: seen.append(paths) or read(spark, paths, *more))
    monkeypatch.setattr(load, "prepare", lambda raw, *more: plans.append(raw._jdf.queryExecution().optimizedPlan().toString()) or prepare(raw, *more))
    assert load.load_group(spark, str(source), "RD", str(tmp_path / "t")) == 7
    assert [p.rsplit("/", 1)[1] for p in seen[0]] == ["RDRJ2301.parquet", "RDSP2301.parquet"]
    assert "Join LeftSemi" in plans[0] and "part-0" not in plans[0] and "LocalRelation" not in plans[0]
    assert load.loaded(spark, str(tmp_path / "t")).count() == 21


def test_months_of_other_types_are_read_together(spark, tmp_path):
    root = tmp_path / "parquet_files"
    write(spark, root / "SIH/RD/RDSP2301.parquet", [("2077480", "1.50", "7"), ("2077481", "x", None)], "CNES string, VAL_TOT string, DIAS string")
    write(spark, root / "SIH/RD/RDRJ2301.parquet", [(2077482, 2.25, 8)], "CNES int, VAL_TOT double, DIAS bigint")
    write(spark, root / "SIH/RD/RDSP2302.parquet", [(2077483, 3.5)], "CNES int, VAL_TOT double")
    write(spark, root / "SIH/RD/RDSP2303.parquet", [(2077484, "a", 1)], "CNES int, EXTRA string, DIAS int")
    write(spark, root / "SIH/RD/RDSP2303.parquet", [("2077485", "4")], "CNES string, VAL_TOT string")
    ask = request(period_end="06/2023")
    got = files.scan_request(spark, str(root), ask, each=lambda scan: files.with_lineage(scan, "RD", ["uf"]))
    assert dict(got.dtypes) == {"CNES": "string", "VAL_TOT": "string", "DIAS": "string", "EXTRA": "string", "uf": "string"}
    assert rows(got.select("CNES", "VAL_TOT", "DIAS", "EXTRA", "uf")) == [
        ("2077480", "1.50", "7", None, "SP"), ("2077481", "x", None, None, "SP"), ("2077482", "2.25", "8", None, "RJ"),
        ("2077483", "3.5", None, None, "SP"), ("2077484", None, "1", "a", "SP"), ("2077485", "4", None, None, "SP"),
    ]
    groups = drift.compatible_groups(spark, [str(p) for p in sorted((root / "SIH/RD").iterdir())])
    # One scan for each kind of file: texts, numbers with long and with short days.
    assert len(groups) == 3
    kinds = extract.extract(spark, str(root), request(fields=["VAL_TOT"], period_end="06/2023"))
    assert kinds.filter("VAL_TOT IS NOT NULL").count() == 4 and kinds.filter("new_VAL_TOT_error IS NOT NULL").count() == 1
    assert load.load_group(spark, str(root / "SIH/RD"), "RD", str(tmp_path / "t")) == 5
    assert rows(load.loaded(spark, str(tmp_path / "t")).select("cnes", "uf"))[0] == (2077480, "SP")
    both = files.read_concat(spark, str(root / "SIH/RD/RDSP2301.parquet"), str(root / "SIH/RD/RDSP2302.parquet"), merge_schema=True)
    assert rows(both.select("CNES")) == [("2077480",), ("2077481",), ("2077483",)]


def test_the_widest_type(spark):
    cases = [
        ("int", "bigint", "bigint"), ("smallint", "string", "string"), ("int", "double", "double"), ("bigint", "double", "string"),
        ("decimal(10,2)", "int", "decimal(12,2)"), ("decimal(38,10)", "bigint", "decimal(38,10)"),
        ("decimal(5,0)", "decimal(6,4)", "decimal(9,4)"), ("date", "timestamp_ntz", "timestamp_ntz"), ("boolean", "int", "string"), ("void", "date", "date"),
    ]
    for a, b, want in cases:
        for x, y in ((a, b), (b, a)):
            frames = [spark.sql(f"SELECT CAST(NULL AS {x}) AS c, 1 AS d"), spark.sql(f"SELECT CAST(NULL AS {y}) AS C")]
            united = drift.union_widest(frames)
            assert united.dtypes == [("c", want), ("d", "int")], (x, y)
            assert united.count() == 2


def test_professional_services_decode_the_state(spark, tmp_path):
    schema = "SP_UF string, SP_AA string, SP_DTINTER string"
    write(spark, tmp_path / "src/SPSP1801.parquet", [("35", "2018", "20180122"), (" 12", "2018", "bad"), ("99", "2018", "x")], schema)
    load.load_group(spark, str(tmp_path / "src"), "SP", str(tmp_path / "target"))
    loaded = spark.read.parquet(str(tmp_path / "target"))
    assert rows(loaded.select("sp_uf", "sp_dtinter")) == [("AC", None), ("SP", dt.date(2018, 1, 22))]
    dropped = load.committed(spark, str(tmp_path / "target"), load.UNKNOWN_STATES)
    assert rows(dropped.select("code", "n_rows")) == [("99", 1)]


def test_names_without_a_month_and_files_without_rows_load_once(spark, tmp_path):
    schema, source, target = "PA_CODUNI string", str(tmp_path / "src"), str(tmp_path / "target")
    write(spark, tmp_path / "src/PARJ_total.parquet", [("0000001",)], schema)
    write(spark, tmp_path / "src/PASP2301.parquet", [("0000002",)], schema)
    write(spark, tmp_path / "src/PAMG2301.parquet", [], schema)
    assert load.load_group(spark, source, "PA", target) == 3
    assert load.load_group(spark, source, "PA", target) == 0
    assert rows(spark.read.parquet(target).select("pa_coduni", "uf")) == [("0000001", "RJ"), ("0000002", "SP")]


def test_the_longer_group_code_wins(spark, tmp_path):
    for name in ("AMPAL2301", "AMPA2301", "AMXX2301"):
        write(spark, tmp_path / f"{name}.parquet", [("1",)], "a string")
    found = {g: rows(files.discover_files(spark, str(tmp_path), g).select("folder", "uf")) for g in ("AM", "AMP")}
    assert found == {"AM": [("AMPA2301.parquet", "PA")], "AMP": [("AMPAL2301.parquet", "AL")]}


def test_expected_and_absent_folders(spark):
    grid = expected_folders(spark, "RD", ["SP", "RJ"], dt.date(2022, 12, 1), dt.date(2023, 1, 1))
    assert [r[3] for r in rows(grid)] == ["RDRJ2212.parquet", "RDRJ2301.parquet", "RDSP2212.parquet", "RDSP2301.parquet"]
    seen = spark.createDataFrame([("SP", dt.date(2023, 1, 1))], "state string, month date")
    assert absent(grid, seen, ["state", "month"]).count() == 3
    assert expected_folders(spark, "RD", ["SP"], dt.date(2023, 1, 1), dt.date(2022, 1, 1)).count() == 0
    with pytest.raises(ValueError):
        expected_folders(spark, "ZZ", ["SP"], dt.date(2023, 1, 1), dt.date(2023, 1, 1))


def test_consolidation_checks_groups_and_skips_empty_ones(spark, folders):
    with pytest.raises(ValueError):
        consolidated(spark, str(folders), "SIH", [2023], [1], ["RD", "XX"], ["SP"])
    assert consolidated(spark, str(folders), "SIH", [1999], [1], ["RD"], ["SP"]) is None
    found = consolidated(spark, str(folders), "SIH", [2022, 2023], range(1, 13), ["RD", "ER"], ["SP", "RJ", "MG"])
    assert {r.group for r in found.select("group").distinct().collect()} == {"RD"} and found.count() >= 14


def test_production_group_keeps_declared_columns(spark, tmp_path):
    write(spark, tmp_path / "src/PAES2301.parquet", [("0000001", "202301", "1", "  12.30")], "PA_CODUNI string, PA_MVM string, PA_OBITO string, PA_VALAPR string")
    load.load_group(spark, str(tmp_path / "src"), "PA", str(tmp_path / "target"))
    row = spark.read.parquet(str(tmp_path / "target")).first()
    assert row.uf == "ES" and row.pa_obito is True and str(row.pa_valapr) == "12.30" and row.pa_mvm is None


def test_stream_takes_each_file_once(spark, folders, tmp_path):
    schema = T._parse_datatype_string(RD)
    target, state = str(tmp_path / "target"), str(tmp_path / "state")

    def run(state=state):
        def typed(batch):
            return convert_loader(lower_names(batch), group_types("RD"))

        return load_new_files(spark, str(folders / "SIH/RD"), schema, target, state, typed, ["uf"])

    run()
    assert spark.read.parquet(target).count() == 15
    run()
    assert spark.read.parquet(target).count() == 15
    # The same state as if the next batch were written but its end not recorded.
    earlier = shutil.copytree(state, tmp_path / "earlier")
    write(spark, folders / "SIH/RD/RDMG2303.parquet", rd_rows("g", 2))
    for where in (state, str(earlier)):
        run(where)
        loaded = spark.read.parquet(target)
        assert loaded.count() == 17 and loaded.select("id_log").distinct().count() == 17


def test_group_stream_equals_the_batch_load(spark, folders, tmp_path):
    source = str(folders / "SIH/RD")
    load.load_group(spark, source, "RD", str(tmp_path / "batch"))
    stream_group(spark, source, "RD", str(tmp_path / "stream"), str(tmp_path / "state"))
    streamed = spark.read.parquet(str(tmp_path / "stream")).drop("batch")
    batch = spark.read.parquet(str(tmp_path / "batch")).select(*streamed.columns)
    assert rows(streamed) == rows(batch) and streamed.count() == 15


def test_a_stream_counts_what_it_leaves_out(spark, tmp_path):
    schema, source, target, state = "SP_UF string, SP_AA string", tmp_path / "src", str(tmp_path / "target"), str(tmp_path / "state")
    write(spark, source / "SPSP1801.parquet", [("35", "2018"), ("99", "2018"), ("99", "2018"), (None, "2018")], schema)
    write(spark, source / "services.parquet", [("35", "2018")], schema)

    def found(name):
        return rows(spark.read.parquet(f"{target}/{name}").drop("batch", "id_arquivo"))

    stream_group(spark, str(source), "SP", target, state)
    assert spark.read.parquet(target).count() == 1
    assert found(load.UNKNOWN_STATES) == [(None, 1), ("99", 2)] and found(WITHOUT_STATE) == [(1,)]
    earlier = shutil.copytree(state, tmp_path / "earlier")
    write(spark, source / "SPRJ1802.parquet", [("33", "2018"), ("98", "2018")], schema)
    for where in (state, str(earlier)):  # the second time as if the end of the batch had not been recorded
        stream_group(spark, str(source), "SP", target, where)
        assert spark.read.parquet(target).count() == 2
        assert found(load.UNKNOWN_STATES) == [(None, 1), ("98", 1), ("99", 2)] and found(WITHOUT_STATE) == [(1,)]


def test_ledger(spark, tmp_path):
    keys = spark.createDataFrame([("RD", 2023, 1), ("RD", 2023, 1), ("SP", 2023, 2)], "g string, y int, m int")
    named = keys.select(ledger.progress_key(F.col("g"), F.col("y"), F.col("m")).alias(ledger.KEY))
    path = str(tmp_path / "ledger")
    assert rows(ledger.record(spark, named, path)) == [("RD-2023-1",), ("SP-2023-2",)]
    more = named.unionAll(spark.createDataFrame([("ER-2023-3",)], named.schema))
    assert rows(ledger.not_processed(more, spark.read.parquet(path))) == [("ER-2023-3",)]
    assert ledger.record(spark, more, path).count() == 3


def test_upload_widens_the_table(spark, tmp_path):
    write(spark, tmp_path / "a", [("1", "SP")], "`Código` string, SP_UF string")
    write(spark, tmp_path / "b", [("2", "RJ", "x")], "`Código` string, SP_UF string, Novo string")
    upload.upload(spark, [str(tmp_path / "a")], "uploads")
    table = upload.upload(spark, [str(tmp_path / "b")], "uploads")
    assert rows(table.select("codigo", "sp_uf", "novo")) == [("1", "SP", None), ("2", "RJ", "x")]
    laid_out = upload.partition_table(spark, "uploads", str(tmp_path / "states"), "sp_uf")
    assert laid_out.count() == 2 and (tmp_path / "states/sp_uf=SP").is_dir()


def test_merge_replaces_the_target_by_state(spark, tmp_path):
    old = [("SP", "1.5", "20200101", "z"), ("RJ", "2", "20200102", "z")]
    new = [("20200101", "SP", "1.5"), ("20200103", "MG", "3"), ("20200103", "MG", "3")]
    spark.createDataFrame(old, "sp_uf string, sp_valato string, sp_dtinter string, extra string").write.saveAsTable("v_old")
    spark.createDataFrame(new, "SP_DTINTER string, SP_UF string, SP_VALATO string").write.saveAsTable("v_new")
    parts = merge.merge_versions(spark.table("v_old"), spark.table("v_new"), {})
    assert rows(parts.duplicates) == [("20200101", "SP", "1.5")]
    types = {"sp_valato": "NUMERIC(10,2)", "sp_dtinter": "DATE"}
    out = merge.merge_and_partition(spark, "v_old", "v_new", "v_new", str(tmp_path / "merged"), types, "sp_uf")
    assert out.count() == 3 and dict(out.dtypes)["sp_valato"] == "decimal(10,2)"
    assert spark.sql(f"SHOW PARTITIONS {generations.generation(spark, 'v_new')}").count() == 3
    assert out.filter("sp_uf = 'MG'").first().sp_dtinter == dt.date(2020, 1, 3)


def test_inferred_tables_and_registry(spark, tmp_path):
    write(spark, tmp_path / "t", [("0012", " x "), ("0013", "y")], "`Código` string, Nome string")
    tables = infer.infer_tables(spark, {"SIA APAC de Nefrologia": str(tmp_path / "t")})
    assert tables == {
        "sia_apac_de_nefrologia": {
            "codigo": "TEXT", "id": "SERIAL PRIMARY KEY", "id_log": "VARCHAR(255)", "nome": "VARCHAR(3)", "uf": "CHAR(2)",
        }
    }
    assert "CREATE TABLE IF NOT EXISTS sia_apac_de_nefrologia" in infer.table_definitions(tables)
    listed = spark.createDataFrame(
        [(t, c) for t, columns in tables.items() for c in columns] + [("APAC de Nefrologia 2", "extra"), ("other", "x")],
        "table_name string, column_name string",
    )
    assert rows(infer.build_registry(listed)) == [
        ("AN", "apac_de_nefrologia_2", ["codigo", "extra", "id_log", "nome", "uf"])
    ]


def test_report(spark, tmp_path):
    data = [("0303060190", 1, 2018, "A"), ("0303060190", 1, 2018, "A"), ("0202", 13, 2018, "A"), (None, 1, 2018, "A"), ("05", 2, None, "A"), ("05", 12, 2019, "B")]
    df = spark.createDataFrame(data, "`Sp Procrea` string, `Sp Mm` int, `Sp Aa` int, `Sp Cnes` string")
    built = report.build_report(df)
    assert rows(built.select("year", "hospital", "procedure", "m01", "m12", "total", "procedure_group")) == [
        (2018, "A", "0202", 0, 0, 0, "02"), (2018, "A", "0303060190", 2, 0, 2, "03"), (2019, "B", "05", 0, 1, 1, "05"),
    ]
    assert dict((r.column_name, r.n_null) for r in report.report_nulls(df).collect()) == {
        "Sp_Procrea": 1, "Sp_Mm": 0, "Sp_Aa": 1, "Sp_Cnes": 0,
    }
    assert rows(report.write_report(df, str(tmp_path / "report"))) == [(2018, "A", 2, 2, 2), (2019, "B", 1, 1, 1)]
    with pytest.raises(ValueError):
        report.build_report(df.drop("Sp Aa"))


def test_monthly_export(spark, folders, tmp_path):
    raw = files.scan_request(spark, str(folders), request())
    monthly.export_monthly(raw, "RD", str(tmp_path / "csv"))
    out = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert "valorTotal" in out.columns and "numeroAIH" in out.columns
    assert {(str(r.dataCompetencia), r["count"]) for r in out.groupBy("dataCompetencia").count().collect()} == {
        ("2023-01-01", 10), ("2023-02-01", 4),
    }


def test_failed_publish_keeps_the_old_table(spark, tmp_path):
    good = spark.createDataFrame([("1",)], "v string")
    ts.publish(good, "kept", str(tmp_path / "kept"))
    bad = spark.createDataFrame([("1",), ("x",)], "v string").select(F.col("v").cast("int").alias("v"))
    with pytest.raises(Exception):
        ts.publish(bad, "kept", str(tmp_path / "kept"))
    assert rows(spark.table("kept")) == [("1",)]
    with pytest.raises(ts.CountMismatch):
        ts.reconcile(2, 1)

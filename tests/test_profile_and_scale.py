import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from censa.operators import joins, ordering, profile, quality, reports, sets
from censa.session import SETTINGS
from censa.operators.filters import any_text, in_months, keep_facilities, project, text_statistics
from conftest import rows


def executed(df):
    """Text of the final plan after running the frame."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def skewed(spark):
    """A third of the rows are copies of one row."""
    return spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id"))).alias("v"),
    )


def test_set_operations_on_copies(spark, skewed):
    other = spark.createDataFrame([("hot", 7, 1), ("new", 1, 2)], "V string, K bigint, extra int")
    assert rows(sets.in_both(skewed, other)) == [(7, "hot")]
    assert sets.only_in_first(skewed, other).count() == skewed.distinct().count() - 1
    assert sets.merge_distinct(skewed, other).count() == skewed.distinct().count() + 1
    nulls = spark.createDataFrame([(None, "a"), (None, "a")], "k bigint, v string")
    assert rows(sets.in_both(nulls, nulls)) == [(None, "a")]


def test_set_operation_combines_before_its_only_shuffle(spark, skewed):
    plan = executed(sets.in_both(skewed, skewed))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_numbering_is_exact_with_copies(spark, skewed):
    numbered = ordering.number_rows(skewed, ["k", "v"])
    got = numbered.orderBy("id").collect()
    assert [r.id for r in got] == list(range(1, 9001))
    assert [(r.k, r.v) for r in got] == sorted((r.k, r.v) for r in skewed.collect())


def test_copies_are_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(ordering, "COPIES", 500)
    same = spark.range(0, 20000, numPartitions=8).select(F.lit(1).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = ordering.number_rows(same, ["k"])
        sizes = numbered.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 20000 / 4
        assert numbered.agg(F.min("id"), F.max("id"), F.count_distinct("id")).first() == (1, 20000, 20000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_hot_key_is_cut_into_ranges(spark):
    hot = spark.range(8000).select(F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    sizes = ordering.ranked(hot, ["k"]).groupBy("__range").count().collect()
    assert len(sizes) == 9 or len(sizes) == 8
    assert max(r["count"] for r in sizes) < 8000 / 3


@pytest.mark.parametrize("partitions", ["1", "3", "64"])
def test_numbers_follow_several_keys_with_nulls(spark, partitions):
    rng = random.Random(7)
    data = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b", "cc"]), rng.random() if k % 3 else None, [k % 2]) for k in range(700)]
    data += data[:300] + [data[0]] * 50
    df = spark.createDataFrame(data, "a int, b string, `c.d` double, e array<int>").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = ordering.number_rows(df, ["b", "a"], "n").orderBy("n").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert [r.n for r in got] == list(range(1, len(data) + 1))
    keys = [(r.b is not None, r.b or "", r.a is not None, r.a or 0) for r in got]
    assert keys == sorted(keys)
    assert sorted(map(str, ([*r][:4] for r in got))) == sorted(map(str, map(list, data)))


def test_numbering_starts_no_job_and_writes_nothing(spark, skewed):
    before = jobs(spark)
    numbered = ordering.number_rows(skewed, ["k", "v"])
    assert jobs(spark) == before
    assert "Checkpoint" not in executed(numbered) and "ExistingRDD" not in executed(numbered)


def test_ids(spark):
    unique = spark.createDataFrame([(5,), (9,)], "id long")
    assert rows(ordering.ensure_id(unique, ["id"])) == [(5,), (9,)]
    repeated = spark.createDataFrame([(5, "b"), (5, "a")], "id long, v string")
    assert rows(ordering.ensure_id(repeated, ["v"]).select("v", "id")) == [("a", 1), ("b", 2)]
    assert ordering.number_rows(spark.createDataFrame([], "v string"), ["v"]).count() == 0


def test_sample_is_repeatable(spark, skewed):
    a, b = ordering.seeded_sample(skewed, 50, 3), ordering.seeded_sample(skewed.repartition(5), 50, 3)
    assert rows(a) == rows(b) and a.count() == 50
    assert rows(a) != rows(ordering.seeded_sample(skewed, 50, 4))


@pytest.mark.parametrize("size", [1, 2, 3, 10, 1001])
def test_quantiles_equal_linear_interpolation(spark, size):
    rng = random.Random(size)
    data = [(float(rng.choice([1, 2, rng.random() * 100])), None if i % 5 == 4 else rng.randint(-9, 9)) for i in range(size)]
    df = spark.createDataFrame(data, "a double, b int")
    shares = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {(r.column_name, r.share): r.quantile for r in profile.exact_quantiles(df, ["a", "b"], shares).collect()}
    for i, c in enumerate("ab"):
        present = [row[i] for row in data if row[i] is not None]
        for share in shares:
            assert got[(c, share)] == pytest.approx(float(np.quantile(present, share)), abs=1e-9)


def test_quantiles_of_many_rows_from_narrow_brackets(spark):
    df = spark.range(300_000).selectExpr("cast(hash(id) % 100000 AS double) AS a", "cast(if(id % 3 = 0, 7, id) AS double) AS b")
    shares = [0.0, 0.1, 0.25, 0.5, 0.999, 1.0]
    got = {(r.column_name, r.share): r.quantile for r in profile.exact_quantiles(df, ["a", "b"], shares).collect()}
    data = df.toPandas()
    assert all(got[(c, s)] == pytest.approx(float(np.quantile(data[c], s)), abs=1e-9) for c in "ab" for s in shares)


@pytest.mark.parametrize("borders", [[], [-1e9], [1e9], [5.0, 5.0, 5.0], [-1.0, 3.0, 90.0], None])
def test_quantiles_do_not_depend_on_the_borders(spark, monkeypatch, borders):
    rng = random.Random(4)
    data = [(float(rng.choice([1, 2, rng.random() * 100])),) for _ in range(501)]
    df = spark.createDataFrame(data, "a double")
    falsified = spark.createDataFrame([("a", borders)], "column_name string, borders array<double>")
    monkeypatch.setattr(profile, "_borders", lambda *_: falsified)
    shares = [0.0, 0.1, 0.25, 0.5, 0.999, 1.0]
    got = {r.share: r.quantile for r in profile.exact_quantiles(df, ["a"], shares).collect()}
    assert got == {s: pytest.approx(float(np.quantile([x for x, in data], s)), abs=1e-9) for s in shares}


def jobs(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def test_describing_starts_no_job(spark, skewed):
    before = jobs(spark)
    described = profile.describe_numeric(skewed, ["k"])
    assert jobs(spark) == before
    assert described.first().n == 9000


def test_quantiles_of_nothing(spark):
    assert profile.exact_quantiles(spark.createDataFrame([], "a double"), ["a"], [0.5]).count() == 0
    described = profile.describe_numeric(spark.createDataFrame([], "a double"), ["a"]).first()
    assert (described.n, described.median) == (0, None)


def test_profile_flags(spark):
    data = [("0012", "1", "a_b", None, " 1", 5), ("13", "1.5", "é", None, "x", 5), ("", "-2", "c d", None, None, None)]
    df = spark.createDataFrame(data, "zeros string, mixed string, plain string, nothing string, odd string, n int")
    got = {r.column_name: r for r in profile.column_profile(df).collect()}
    assert [got[c].position for c in df.columns] == list(range(6))
    assert got["zeros"].leading_zeros and (got["zeros"].max_length, got["zeros"].min_length) == (4, 2)
    assert got["mixed"].mixed_types and got["mixed"].special_chars
    assert not got["plain"].special_chars and not got["plain"].mixed_types
    assert (got["nothing"].n_null, got["nothing"].n_distinct, got["nothing"].sample) == (3, 0, [])
    assert got["odd"].mixed_types and got["odd"].n_null == 1
    assert (got["n"].n_distinct, got["n"].max_length, got["n"].largest) == (1, 0, 5)


def test_profile_of_an_empty_frame(spark):
    got = profile.column_profile(spark.createDataFrame([], "a string, b int")).collect()
    assert [(r.n_rows, r.n_distinct, r.n_null, r.max_length, r.mixed_types) for r in got] == [(0, 0, 0, 0, False)] * 2


def test_wide_profile(spark):
    wide = spark.range(200).select(*[(F.col("id") % (i + 1)).cast("string").alias(f"c{i}") for i in range(113)])
    got = profile.column_profile(wide).collect()
    assert [r.n_distinct for r in sorted(got, key=lambda r: r.position)] == [min(i + 1, 200) for i in range(113)]


def test_profile_shuffles_once_and_keeps_few_rows_per_task(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b")).write.parquet(path)
    plan = executed(profile.column_profile(spark.read.parquet(path)))
    # One scan for the counts and flags, one for the distinct values.
    assert plan.count("FileScan") == 2 and "ReusedExchange" in plan and "WindowGroupLimit" in plan


def test_frequent_values_break_ties_by_value(spark):
    df = spark.createDataFrame([(v,) for v in "bbaaccdef"] + [(None,)], "v string")
    got = profile.top_values(df, k=4).orderBy("rank").collect()
    assert [(r.value, r.n_rows, r.n_distinct) for r in got] == [("a", 2, 6), ("b", 2, 6), ("c", 2, 6), ("d", 1, 6)]
    assert profile.describe_text(df, ["v"]).first() == ("v", 9, 6, "a", 2)


def test_unique_columns_count_null_as_a_value(spark):
    df = spark.createDataFrame([(1, 1, None), (2, 1, None), (None, 2, 3)], "a int, b int, c int")
    assert rows(profile.unique_columns(df)) == [("a", True), ("b", False), ("c", False)]


def test_list_metrics(spark):
    df = spark.createDataFrame([(["0a", "12"],), ([],), (["é", " "],), (None,)], "v array<string>")
    got = [tuple(r)[1:] for r in profile.list_metrics(df, "v").collect()]
    assert got == [(2, 2, True, False, True), (0, 0, False, False, False), (1, 1, False, False, False), (0, 0, False, False, False)]


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({"n_null": 3, "n_rows": 3}, "TEXT"),
        ({"leading_zeros": True}, "TEXT"),
        ({"sample": []}, "TEXT"),
        ({"sample": ["yes", "NO "]}, "BOOLEAN"),
        ({"sample": ["0", "1"]}, "BOOLEAN"),
        ({"sample": ["2020-01-05", "2020-1-6"]}, "DATE"),
        ({"sample": ["2020-13-05"]}, "CHAR(3)"),
        ({"sample": ["7", "32767"], "data_type": "int"}, "SMALLINT"),
        ({"sample": ["-32768"], "data_type": "int"}, "INTEGER"),
        ({"sample": ["2147483648"], "data_type": "bigint"}, "BIGINT"),
        ({"sample": ["1.5"], "data_type": "double"}, "NUMERIC"),
        ({"mixed_types": True}, "TEXT"),
        ({"max_length": 255, "min_length": 1}, "VARCHAR(255)"),
        ({"max_length": 256, "min_length": 1}, "TEXT"),
        ({"max_length": 400, "min_length": 400}, "CHAR(400)"),
        ({"sample": ["123"]}, "CHAR(3)"),
    ],
)
def test_suggested_types(spark, changes, expected):
    base = {
        "column_name": "c", "data_type": "string", "n_rows": 10, "n_distinct": 2, "n_null": 0, "sample": ["abc"],
        "max_length": 3, "min_length": 3, "leading_zeros": False, "special_chars": False, "mixed_types": False,
    }
    given = spark.createDataFrame(
        [tuple({**base, **changes}.values())],
        "column_name string, data_type string, n_rows long, n_distinct long, n_null long, sample array<string>, "
        "max_length int, min_length int, leading_zeros boolean, special_chars boolean, mixed_types boolean",
    )
    assert quality.suggest_types(given).first().suggested_type == expected


def test_sparse_profiles_are_completed(spark):
    given = spark.createDataFrame([("c", ["01", "2"])], "column_name string, sample array<string>")
    assert quality.profile_problems(given).first().missing == ["data_type", "n_distinct", "n_null", "max_length", "min_length"]
    assert quality.suggest_types(given).first().suggested_type == "TEXT"


def test_text_rules(spark):
    df = spark.createDataFrame([("ok", "é"), ("x" * 256, "é")], "a string, ERRO_B string")
    assert quality.text_violations(df).first() == ("a", 0, 256, True)
    with pytest.raises(ValueError, match="a"):
        quality.require_clean_text(df)
    clean = df.filter("length(a) < 10")
    assert quality.require_clean_text(clean) is clean


def test_date_rule_ignores_nulls(spark):
    df = spark.createDataFrame([("20200101", "2020", None), (None, "20200101", None)], "a string, b string, c string")
    assert rows(quality.date_format_ok(df, ["a", "b", "c"])) == [("a", True), ("b", False), ("c", True)]


def test_key_joins_with_and_without_a_broadcast(spark, skewed):
    keys = spark.createDataFrame([(7,), (7,), (8,), (None,)], "k long")
    lookup = spark.createDataFrame([(7, "seven")], "k long, name string")
    for hint in ("merge", "broadcast"):
        assert joins.semi_join(skewed, keys.hint(hint), "k").count() == skewed.filter("k IN (7, 8)").count()
        assert joins.anti_join(skewed, keys.hint(hint), "k").count() == skewed.filter("k NOT IN (7, 8)").count()
        assert joins.decode(skewed, lookup.hint(hint), "k").count() == skewed.filter("k = 7").count()


def test_key_joins_start_no_job(spark, skewed):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy joins", "")
    keys = skewed.select("k")
    joins.unmapped(joins.decode(joins.anti_join(joins.semi_join(skewed, keys, "k"), keys, "k"), keys, "k"), keys, "k")
    assert not tracker.getJobIdsForGroup("lazy joins")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_shuffles_start_wide_and_are_merged(spark):
    assert int(SETTINGS["spark.sql.shuffle.partitions"]) >= 2000
    grouped = spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", SETTINGS["spark.sql.shuffle.partitions"])
    try:
        assert grouped.groupBy("count").count().rdd.getNumPartitions() < 100
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_first_pattern_wins(spark):
    df = spark.createDataFrame([("aih_rejeitada_com_erro",), ("none",)], "t string")
    got = joins.first_contained(df, "t", [("aih_rejeitada", "RJ"), ("aih_rejeitada_com_erro", "ER")], "g")
    assert rows(got) == [("aih_rejeitada_com_erro", "RJ")]
    many = [(f"no such text {n}", "XX") for n in range(5000)] + [("none", "NO")]
    assert rows(joins.first_contained(df, "t", many, "g")) == [("none", "NO")]


def test_unmapped_codes_include_null(spark):
    codes = spark.createDataFrame([("35",), ("99",), (None,), ("99",)], "code string")
    lookup = spark.createDataFrame([("35", "SP")], "code string, state string")
    assert rows(joins.unmapped(codes, lookup, "code")) == [(None,), ("99",)]


def test_filters(spark):
    df = spark.createDataFrame([("a", " ", 1), ("", None, 2)], "x string, y string, n int")
    assert text_statistics(df).first() == (2, 1)
    assert text_statistics(df.select("n")).first() == (2, 0)
    assert df.filter(any_text(df.select("x"))).count() == 1
    assert keep_facilities(df, "x", ["*"]) is df
    with pytest.raises(KeyError):
        keep_facilities(df, "cnes", ["1"])
    for n in (3, 5000):
        held = keep_facilities(df, "y", [" ", *map(str, range(n))])
        assert held.columns == df.columns and held.count() == 1
    assert project(df, ["n"], "x").columns == ["n", "x"] and project(df, ["X", "n"], "x").columns == ["X", "n"]


def test_month_range_reaches_the_scan(spark, tmp_path):
    import datetime as dt

    path = str(tmp_path / "t")
    spark.sql("SELECT explode(sequence(date'2019-12-30', date'2021-02-02')) AS d, 1 AS other").write.parquet(path)
    df = spark.read.parquet(path).filter(in_months("d", dt.date(2020, 1, 1), dt.date(2020, 12, 1))).select("d")
    assert df.count() == 366
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d,2020-01-01)" in plan and "LessThan(d,2021-01-01)" in plan
    assert "ReadSchema: struct<d:date>" in plan


def test_crosstab_is_one_scan_and_one_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("2020 AS a", "'h' AS h", "CAST(id % 3 AS STRING) AS p", "id % 14 AS m").write.parquet(path)
    report = reports.monthly_crosstab(spark.read.parquet(path), "a", "h", "p", "m")
    plan = executed(report)
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert sum(r.total for r in report.collect()) == sum(1 for i in range(100) if 1 <= i % 14 <= 12)


def test_last_date_of_no_table(spark):
    assert reports.last_date(None, "d") is None
    assert reports.procedure_group(F.lit(None).cast("string")) is not None

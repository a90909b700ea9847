import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from censa.functions.convert import to_boolean, to_type
from censa.functions.dates import full_year, parse_date, period_start
from censa.operators import conversion as cv
from censa.operators.schema import drop_empty_columns
from censa.plans.quarantine import publish_quarantined

D = Decimal


def values(spark, texts, declared, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    out = df.select("i", to_type(F.col("c"), declared, **options).alias("v")).orderBy("i").collect()
    return [r.v for r in out]


EDGE_CASES = {
    "SMALLINT": [
        (" 12 ", 12), ("-7", -7), ("+7", 7), ("007", 7), ("32767", 32767), ("32768", None), ("-32768", -32768),
        ("-32769", None), ("40000", None), ("12.5", None), ("1e3", None), ("", None), ("NaN", None), ("None", None),
        (None, None), ("x", None), ("00000000000000000000012", 12),
    ],
    "INTEGER": [("2147483647", 2147483647), ("2147483648", None), ("12.0", None), ("- 1", None), ("350000", 350000)],
    "BIGINT": [
        ("9223372036854775807", 9223372036854775807), ("9223372036854775808", None), ("123456789012345678", 123456789012345678),
        ("99999999999999999999", None),
    ],
    "NUMERIC(10,2)": [
        ("       1605.13", D("1605.13")), ("1234.567", D("1234.57")), ("-0.005", D("-0.01")), ("12345678901", None),
        ("1,5", None), (".5", D("0.50")), ("5.", D("5.00")), ("1e2", D("100.00")), ("abc", None), ("   ", None),
    ],
    "NUMERIC(7,0)": [("2077485", D("2077485")), ("12345678", None)],
    "NUMERIC": [("1.5", D("1.5000000000"))],
    "DATE": [
        ("20221209", dt.date(2022, 12, 9)), ("20221221  ", dt.date(2022, 12, 21)), ("        ", None), ("20221301", None),
        ("20220230", None), ("20240229", dt.date(2024, 2, 29)), ("20230229", None), ("2018-01-22", dt.date(2018, 1, 22)),
        ("2018-1-22", None), ("2018012", None), ("201801222", None), ("00000000", None), ("abcdefgh", None), ("20220100", None),
    ],
    "BOOLEAN": [("1", True), ("0", False), ("True", True), ("False", False), ("2", None), ("true", None), ("", None)],
    "TEXT": [("  a b ", "a b"), ("  ", None), ("None", None), (None, None)],
    "CHAR(3)": [(" abcd ", "abcd")],
    "DOUBLE PRECISION": [("1.5", 1.5), ("x", None)],
}


@pytest.mark.parametrize("declared", EDGE_CASES)
def test_edge_values(spark, declared):
    texts, expected = zip(*EDGE_CASES[declared])
    assert values(spark, texts, declared) == list(expected)


def test_boolean_rules(spark):
    df = spark.createDataFrame([("0",), ("1",), ("2",), ("F",), ("false",), ("yes",), (None,)], "c string")
    got = df.select(
        *[to_boolean(F.col("c"), rule).alias(rule) for rule in ("map", "truthy", "cast")]
    ).collect()
    assert [r["map"] for r in got] == [False, True, None, None, None, None, None]
    assert [r["truthy"] for r in got] == [False, True, True, False, False, True, None]
    assert [r["cast"] for r in got] == [False, True, None, False, False, True, None]
    with pytest.raises(ValueError):
        to_boolean(F.col("c"), "other")


RAW = [("1", " 10.5 ", "20200101"), ("2", "x", "2020"), ("3", "   ", "        "), ("4", None, None), ("5", "-3", "19991399")]
TYPES = {"id": "INTEGER", "valor": "NUMERIC(10,2)", "dia": "DATE"}


def test_flags_only_on_lost_values(spark):
    raw = spark.createDataFrame(RAW, "id string, valor string, dia string")
    got = cv.convert_with_errors(raw, TYPES).orderBy("id").collect()
    assert [r.new_valor_error for r in got] == [None, "ERRO_TIPO", None, None, None]
    assert [r.new_dia_error for r in got] == [None, "ERRO_TIPO", None, None, "ERRO_TIPO"]
    assert [r.valor for r in got] == [D("10.50"), None, None, None, D("-3.00")]
    strict = cv.convert_with_errors(raw, TYPES, strict_digits=True).orderBy("id").collect()
    assert [r.new_valor_error for r in strict] == ["ERRO_TIPO", "ERRO_TIPO", None, None, "ERRO_TIPO"]


def test_unknown_columns_are_text_and_names_match_in_any_case(spark):
    raw = spark.createDataFrame([(" a ", "12")], "OTHER string, VALOR string")
    row = cv.convert_with_errors(raw, TYPES).first()
    assert (row.OTHER, row.VALOR, row.new_OTHER_error) == ("a", D("12.00"), None)


def test_error_counts_and_empty_error_columns(spark):
    converted = cv.convert_with_errors(spark.createDataFrame(RAW, "id string, valor string, dia string"), TYPES)
    counts = {r.error_column: r.n_errors for r in cv.error_counts(converted).collect()}
    assert counts == {"new_id_error": 0, "new_valor_error": 1, "new_dia_error": 2}
    assert drop_empty_columns(converted).columns == ["id", "valor", "new_valor_error", "dia", "new_dia_error"]


def test_quarantine_per_row_and_per_column(spark, tmp_path):
    raw = spark.createDataFrame(RAW, "id string, valor string, dia string")
    got = cv.convert_quarantine(raw, TYPES).orderBy("id").collect()
    assert [r.new_valor for r in got] == [None, "x", None, None, None]
    done = publish_quarantined(raw, TYPES, "set_aside", str(tmp_path))
    whole = done.table
    assert (done.n_rows, done.values) == (5, {"id": 0, "valor": 1, "dia": 2})
    plan = cv.both_forms(raw, TYPES, Observation("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1  # the rows are read once
    assert whole.columns == ["id", "valor", "dia", "new_valor", "new_dia"]
    first = whole.orderBy("id").first()
    assert (first.id, first.valor, first.new_valor, first.dia) == (1, None, " 10.5 ", None)


def test_strict_conversion_stops_on_the_first_bad_value(spark):
    good = spark.createDataFrame([("1", "2.5")], "id string, valor string")
    assert cv.convert_strict(good, TYPES).first() == (1, D("2.50"))
    bad = spark.createDataFrame([("1", "2.5"), ("2", "two")], "id string, valor string")
    with pytest.raises(Exception, match="valor is no NUMERIC"):
        cv.convert_strict(bad, TYPES).collect()


def test_silent_nulls_need_a_missing_flag(spark):
    raw = spark.createDataFrame([("99999999999",), ("x",), ("1",)], "valor string")
    assert cv.silent_nulls(raw, TYPES).first().n_silent == 0
    # Too many digits: lost, yet no non-digit to flag.
    assert cv.silent_nulls(raw, TYPES, strict_digits=True).first().n_silent == 1


def test_loader_keeps_undeclared_columns(spark):
    raw = spark.createDataFrame([(" 1 ", " x ")], "id string, other string")
    assert cv.convert_loader(raw, TYPES).first() == (1, " x ")


def test_periods_and_years(spark):
    df = spark.createDataFrame([("9708",), ("2303",), ("2313",), ("abcd",), (None,)], "c string")
    got = df.select(period_start(F.col("c")).alias("p")).collect()
    assert [r.p for r in got] == [dt.date(1997, 8, 1), dt.date(2023, 3, 1), None, None, None]
    years = spark.createDataFrame([(90,), (89,), (0,)], "y int").select(full_year(F.col("y")).alias("y")).collect()
    assert [r.y for r in years] == [1990, 2089, 2000]


def test_every_day_of_a_leap_cycle_parses(spark):
    days = spark.sql("SELECT explode(sequence(date'1999-12-25', date'2004-03-05', interval 1 day)) AS d")
    bad = days.filter(~parse_date(F.date_format("d", "yyyyMMdd")).eqNullSafe(F.col("d")))
    assert bad.count() == 0

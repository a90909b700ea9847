import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from censa.functions.text import blank_to_null, normalize_name, normalized, zero_fill
from censa.operators import cleaning as cl
from censa.operators import joins
from censa.operators import schema as sc
from censa.operators import windows
from censa.registry.types import create_table_text, spark_ddl, spark_type, sql_type, struct_of, text_length

NAMES = ["TIPPRE  ", "Sp Procrea", "Ação/Saúde (SUS)", "__x__", "ÀÉÎõü ç ñ", "a--b..c", "œuvre ½ ª º", "", "日本 x", "Café"]
NAMES += ["\u00bd dia", "O\ufb01cina"]


def expected(name, pattern):
    plain = unicodedata.normalize("NFKD", name.lower()).encode("ascii", "ignore").decode()
    return re.sub(pattern, "_", plain).strip("_")


@pytest.mark.parametrize("per_character, pattern", [(False, r"\W+"), (True, r"[^a-z0-9_]")])
def test_identifier_forms(spark, per_character, pattern):
    wanted = [expected(n, pattern) for n in NAMES]
    df = spark.createDataFrame([(n,) for n in NAMES], "n string")
    assert [r[0] for r in df.select(normalize_name(F.col("n"), per_character)).collect()] == wanted
    assert [normalized(n, per_character) for n in NAMES] == wanted


def test_zero_fill_never_cuts(spark):
    df = spark.createDataFrame([("1",), ("12",), ("123",), ("",), (None,)], "c string")
    assert [r[0] for r in df.select(zero_fill(F.col("c"), 2)).collect()] == ["01", "12", "123", "00", None]


def test_blanks(spark):
    df = spark.createDataFrame([("  ",), (" NaN ",), ("None",), ("nan",), (" x",), (None,)], "c string")
    assert [r[0] for r in df.select(blank_to_null(F.col("c"))).collect()] == [None, None, None, "nan", "x", None]


@pytest.mark.parametrize(
    "declared, simple",
    [
        ("SMALLINT", "smallint"), ("integer", "int"), ("BIGINT", "bigint"), ("NUMERIC(15,2)", "decimal(15,2)"),
        ("NUMERIC(7, 0)", "decimal(7,0)"), ("NUMERIC", "decimal(38,10)"), ("TEXT", "string"), ("VARCHAR(255)", "string"),
        ("CHAR(2)", "string"), ("DATE", "date"), ("BOOLEAN", "boolean"), ("TIMESTAMP", "timestamp"), ("FLOAT", "double"),
        ("DOUBLE  PRECISION", "double"), ("SERIAL PRIMARY KEY", "bigint"), ("SOMETHING", "string"), ("NUMERIC(5)", "decimal(5,0)"),
    ],
)
def test_type_names(declared, simple):
    assert spark_type(declared).simpleString() == simple
    assert spark_type(sql_type(spark_type(declared))) == spark_type(declared)


def test_lengths_travel_as_metadata():
    assert text_length("CHAR(13)") == 13 and text_length("TEXT") is None
    assert struct_of({"uf": "CHAR(2)"})["uf"].metadata == {"length": 2}


def test_ddl_texts():
    types = {"uf": "CHAR(2)", "valor": "NUMERIC(10,2)"}
    text = create_table_text("t", types)
    assert text == 'CREATE TABLE IF NOT EXISTS t (\n    "uf" CHAR(2),\n    "valor" NUMERIC(10,2)\n);\n'
    assert create_table_text("t", types, replace=True).startswith("DROP TABLE IF EXISTS t;")
    assert spark_ddl(types) == "`uf` string, `valor` decimal(10,2)"


def test_column_sets(spark):
    df = spark.createDataFrame([("1", "x", "y")], "`CNES ` string, Uf string, Extra string")
    low = sc.lower_names(df)
    assert low.columns == ["cnes", "uf", "extra"]
    assert sc.upper_names(df).columns == ["CNES", "UF", "EXTRA"]
    assert sc.normalize_names(df).columns == ["cnes", "uf", "extra"]
    aligned = sc.align(low, {"uf": "CHAR(2)", "idade": "SMALLINT", "cnes": "TEXT"})
    assert aligned.dtypes == [("uf", "string"), ("idade", "smallint"), ("cnes", "string")]
    assert sc.align(low, {"uf": "TEXT"}, extra=["extra"]).columns == ["uf", "extra"]
    assert sc.drop_present(low, ["id", "uf"]).columns == ["cnes", "extra"]
    assert sc.rename_present(low, {"cnes": "c", "absent": "b"}).columns == ["c", "uf", "extra"]
    assert sc.sorted_columns(low).columns == ["cnes", "extra", "id", "id_log", "uf"]
    assert sc.common_columns(low, spark.createDataFrame([], "UF string, x int")) == ["uf"]
    assert sc.keep_originals(low, {"CNES": "TEXT"}).columns == ["cnes", "uf", "extra", "new_cnes"]


def test_empty_frame_has_no_used_error_column(spark):
    df = spark.createDataFrame([], "a string, new_a_error string")
    assert sc.drop_empty_columns(df).columns == ["a"]


def test_frame_cleaning(spark):
    df = spark.createDataFrame(
        [(" a ", "20200102", 1), ("NaN", "bad", None), (None, None, 3)], "nome string, DT_X string, n int"
    )
    assert cl.date_columns_by_name(df) == ["DT_X"]
    cleaned = cl.clean_frame(df).collect()
    assert [r.nome for r in cleaned] == ["a", None, None] and cleaned[0].DT_X.isoformat() == "2020-01-02"
    assert [tuple(r) for r in cl.fill_nulls(df).collect()] == [("a", "20200102", 1), ("NaN", "bad", 0), ("", "", 3)]


def test_date_columns_by_content_need_more_than_four_fifths(spark):
    dates = ["20200101"] * 8
    df = spark.createDataFrame(
        [(a, b, n) for a, b, n in zip(dates + ["20200102", "x"], dates + ["x", "y"], [20200101] * 10)],
        "a string, b string, n int",
    )
    assert cl.date_columns_by_content(df) == ["a", "n"]
    assert dict(cl.preprocess(df).dtypes) == {"a": "date", "b": "string", "n": "date"}
    empty = spark.createDataFrame([], "a string")
    assert cl.date_columns_by_content(empty) == []


def test_the_first_of_very_many_patterns(spark):
    rng = random.Random(3)
    letters = "abcdé 日_"
    word = lambda low, high: "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))
    texts = [word(0, 200) for _ in range(60)] + [None, "", "abc", "abc", "x" * 50_000 + "needle"]
    known = [(word(5, 9), f"c{k}", k) for k in range(100_000)] + [("é 日", "short", 99_000), ("d", "one", 99_500), ("needle", "n", 7), (None, "null", 1)]
    patterns = spark.createDataFrame(known, "text string, code string, position int")
    frame = spark.createDataFrame(list(enumerate(texts)), "k int, name string").repartition(3)

    def brute(empty=None):
        out = {}
        for k, text in enumerate(texts):
            hits = [(p, t, c) for t, c, p in known if t is not None and text is not None and t in text] + ([empty] if empty and text is not None else [])
            if hits:
                out[k] = min(hits)[2]
        return out

    found = joins.first_contained_in(frame, "name", patterns, "label")
    assert found.columns == ["k", "name", "label"] and {r.k: r.label for r in found.collect()} == brute()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    every = patterns.unionByName(spark.createDataFrame([("", "empty", 50_000)], patterns.schema))
    assert {r.k: r.label for r in joins.first_contained_in(frame, "name", every, "label").collect()} == brute((50_000, "", "empty"))
    assert joins.first_contained_in(frame, "name", patterns.limit(0), "label").count() == 0


def test_patterns_of_all_lengths_in_texts_longer_than_a_step(spark):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("ab é日") for _ in range(n))
    long = word(90_000)
    texts = [word(rng.randint(0, 300)) for _ in range(80)] + [None, "", "a", "日", long, long[:40_000], "b" * 40]
    at = len(long.encode()[: windows.STEP].decode(errors="ignore"))
    cut = [long[at - k : at - k + 40] for k in (0, 1, 20, 33, 40)] + [long[:33], long[-33:], long[-1:], "b" * 39, "b" * 41]
    known = [(t[a : a + n], f"{t[:3]}{a}", rng.randint(0, 400)) for t in texts[:80] for n in (3, 8, 15, 31, 32, 33, 70) if len(t) > n for a in [rng.randrange(len(t) - n)]]
    # The ends of one text and the start of the next are no pattern of either.
    known += [(t[-9:] + u[:9], "both", 0) for t, u in zip(texts[:79], texts[1:80])] + [(t, f"cut{k}", 500 - k) for k, t in enumerate(cut)]
    known += [("日", "z", 450), ("日", "a", 450), ("日", "later", 451), (cut[2], "again", 3)]
    patterns = spark.createDataFrame(known, "text string, code string, position int").repartition(5)
    frame = spark.createDataFrame(list(enumerate(texts)), "k int, name string").repartition(3)
    wanted = {}
    for k, text in enumerate(texts):
        hits = [(p, t, c) for t, c, p in known if text is not None and t in text]
        if hits:
            wanted[k] = min(hits)[2]
    assert {r.k: r.label for r in joins.first_contained_in(frame, "name", patterns, "label").collect()} == wanted
    # Whatever lies at the border of two steps, the long text has all windows of what it holds.
    filed = windows.filed(spark.createDataFrame([(t,) for t in cut], "text string"), "text")
    held = windows.sifted(frame.filter("k = 84").selectExpr("'x' AS key", "name"), "key", "name", windows.sieve(filed)).first()
    assert held.name == long
    by_text = {t: {r["__gram"] for r in filed.collect() if r.text == t} for t in cut}
    assert all(by_text[t] and by_text[t] <= set(held["__grams"]) for t in cut if t in long)


def test_texts_without_a_pattern_make_no_rows(spark):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    known = [(word(40), f"c{k}", k) for k in range(50)]
    texts = [word(300) for _ in range(3000)] + [word(50) + known[k][0] + word(50) for k in range(5)]
    patterns = spark.createDataFrame(known, "text string, code string, position int")
    frame = spark.createDataFrame(list(enumerate(texts)), "k int, name string").repartition(3)
    found = joins.first_contained_in(frame, "name", patterns, "label")
    assert {r.k: r.label for r in found.collect()} == {3000 + k: f"c{k}" for k in range(5)}

    def nodes(plan):
        yield plan
        name = plan.nodeName()
        if name == "AdaptiveSparkPlan":
            yield from nodes(plan.executedPlan())
        elif name.endswith("QueryStage"):
            yield from nodes(plan.plan())
        else:
            for k in range(plan.children().size()):
                yield from nodes(plan.children().apply(k))

    # Formerly each text made a row for each of its runs of letters, found or not.
    made = [n.metrics().apply("numOutputRows").value() for n in nodes(found._jdf.queryExecution().executedPlan()) if n.nodeName() == "Generate"]
    assert made and sum(made) < 1000

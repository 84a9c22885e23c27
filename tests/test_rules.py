"""Value rules: tables of inputs and expected values, and random values against DuckDB."""

import datetime as dt
import random

import duckdb
from pyspark.sql import functions as F

from tableflow.functions import rules as R
from tableflow.plans import oracle as O

WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2007\u200a\u2028\u2029\u202f\u205f\u3000"


def duck(values, sql):
    """The oracle's SQL of a rule, run by DuckDB on the values."""
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, v VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    return [r[0] for r in con.execute(f"SELECT {sql} FROM t ORDER BY i").fetchall()]


def _eval(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_date_cases(spark):
    cases = {"85-05-12": dt.date(1985, 5, 12), "17-05-12": dt.date(2017, 5, 12), "68-01-01": dt.date(2068, 1, 1),
             "69-01-01": dt.date(1969, 1, 1), "31-12-99": dt.date(1999, 12, 31), "05-06-07": dt.date(2005, 6, 7),
             "1/2/2020": dt.date(2020, 2, 1), "1/1/1900": dt.date(1900, 1, 1), "01/01/1900": None,
             "0017-05-12": None, "2020-13-01": None, "12020-01-01": None, " 2020-01-05\t": dt.date(2020, 1, 5),
             "": None, "junk": None}
    got = _eval(spark, list(cases), R.clean_date)
    assert got == list(cases.values())


def test_int_and_code_cases(spark):
    cases = {"+5": 5, " 12 ": 12, "1_000": 1000, "12.0": None, "1e3": None, "5d": None, "--5": None, "1__0": None}
    assert [None if x is None else int(x) for x in _eval(spark, list(cases), R.clean_int)] == list(cases.values())
    codes = ["0", "00", "-0", "7", " 007 "]
    assert [None if x is None else int(x) for x in _eval(spark, codes, R.clean_code)] == [None, None, None, 7, 7]


def test_kind_cases(spark):
    ints, floats, strs = ["5", "-5", "--5"], ["+5", "1.5", ".5", "1e5", "nan", "1_0"], ["5d", "1e", "0x1"]
    got = _eval(spark, ints + floats + strs, R.value_kind)
    assert got == ["int"] * 3 + ["float"] * 6 + ["str"] * 3


def test_text_cases(spark):
    cases = {"  A\tB\r\nC ": "a b c", " x\u0085y\u001cz ": "x y z", "   ": None, "MiXeD  Case": "mixed case", "": None,
             "\u3000Ñandú\u2009 ÉL": "ñandú él", "one": "one"}
    assert _eval(spark, list(cases), R.clean_text) == list(cases.values())


def test_percent_half_even(spark):
    df = spark.createDataFrame([(1, 800), (1, 3), (0, 0)], "p long, t long")
    got = [r[0] for r in df.select(R.percent("p", "t")).collect()]
    assert got == [0.12, 33.33, 0.0]


def _random_values(seed, n=600):
    rnd = random.Random(seed)
    pieces = list("0123456789") + ["/", "-", "_", "+", ".", "e", " ", "\t", " ", "a", "1900", "2020", "99"]
    out = []
    for _ in range(n):
        k = rnd.randint(0, 8)
        out.append("".join(rnd.choice(pieces) for _ in range(k)))
    for _ in range(n):  # plausible dates
        d = dt.date(1890, 1, 1) + dt.timedelta(days=rnd.randint(0, 80000))
        fmt = rnd.choice(["%d/%m/%Y", "%Y-%m-%d", "%d-%m-%Y", "%y-%m-%d", "%d-%m-%y", "%m/%d/%Y"])
        out.append(rnd.choice(["", " ", "\t"]) + d.strftime(fmt) + rnd.choice(["", " "]))
    return out


def test_random_values_match_the_other_engine(spark):
    vals = _random_values(7)
    assert _eval(spark, vals, R.clean_date) == duck(vals, O.clean_date("v"))
    assert _eval(spark, vals, R.clean_int) == duck(vals, O.clean_int("v"))
    assert _eval(spark, vals, R.clean_text) == duck(vals, O.clean_text("v"))
    assert _eval(spark, vals, lambda c: R.value_kind(R.null_token(c))) == duck(vals, O.value_kind(O.null_token("v")))


def test_huge_integers_saturate(spark):
    big = "9" * 39
    cases = {big: int("9" * 38), "-" + big: -int("9" * 38), "0" * 50 + "7": 7, "9" * 38: int("9" * 38), "1_" + big: int("9" * 38)}
    assert [int(x) for x in _eval(spark, list(cases), R.clean_int)] == list(cases.values())
    assert [int(x) for x in duck(list(cases), O.clean_int("v"))] == list(cases.values())


def test_strip_takes_all_white_space(spark):
    assert _eval(spark, [WHITE + "a b" + WHITE, "x", WHITE, ""], R.strip) == ["a b", "x", "", ""]


def test_sql_functions_match_column_rules(spark):
    from tableflow.functions import sql as FS
    FS.register(spark)
    vals = _random_values(17, 200)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    df.createOrReplaceTempView("tf_vals")
    got = spark.sql("SELECT i, clean_date(v) d, clean_int(v) n, clean_code(v) c, clean_text(v) t, "
                    "value_kind(lower(strip_text(v))) k FROM tf_vals ORDER BY i").collect()
    want = df.select("i", R.clean_date("v").alias("d"), R.clean_int("v").alias("n"), R.clean_code("v").alias("c"),
                     R.clean_text("v").alias("t"), R.value_kind(F.lower(R.strip("v"))).alias("k")).orderBy("i").collect()
    assert got == want


def test_row_cap_reports_cut(spark):
    from tableflow.operators import profiling as PRF
    df = spark.range(10).withColumnRenamed("id", "o")
    capped, report = PRF.row_cap(df, 4, "o")
    assert capped.count() == 4 and report.first()["recortado"] is True
    assert PRF.row_cap(df, 40, "o")[1].first()["recortado"] is False


def test_staged_record_cleaner_matches_column_rules(spark):
    from tableflow import spec as S
    from tableflow.operators import records as REC
    vals = _random_values(23, 300)
    df = spark.createDataFrame([(i, v, v, v, v, v) for i, v in enumerate(vals)],
                               "i int, d string, t string, n string, c string, x string")
    spec = S.TableSpec("r", (S.ColumnRule("d", S.DATE, "date"), S.ColumnRule("t", S.DATE_TEXT),
                             S.ColumnRule("n", S.INT, "int"), S.ColumnRule("c", S.CODE, "int"),
                             S.ColumnRule("x", S.TEXT), S.ColumnRule("absent", S.DATE, "date")))
    got = REC.clean_record(df, spec, keep=["i"]).orderBy("i").collect()
    want = df.select("i", R.clean_date("d").alias("d"), R.clean_date_text("t").alias("t"), R.clean_int("n").alias("n"),
                     R.clean_code("c").alias("c"), R.clean_text("x").alias("x"),
                     F.lit(None).cast("date").alias("absent")).orderBy("i").collect()
    assert got == want

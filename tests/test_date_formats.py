"""Election of a column's date layout."""

import datetime as dt

from pyspark.sql import functions as F

from tableflow.operators import date_formats as DF


def test_layouts_are_elected_without_formats_in_the_spec(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(200)]
    rows = [(i, d.strftime("%d/%m/%Y"), d.strftime("%m-%d-%Y 10:20"), d.strftime("%Y%m%d"),
             d.strftime("%d.%m.%Y") if i % 3 else d.isoformat(), f"0{1 + i % 9}/05/2020", None) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "id int, a string, b string, c string, mixed string, either string, empty string")
    names = df.columns[1:]
    assert DF.elect_layouts(df, [*names, "absent", "id"]) == {"a": "dmy", "b": "mdy", "c": "ymd", "mixed": "dmy", "either": "mdy", "empty": "ymd"}
    for r in DF.coerce_elected(df, names).collect():
        day = dt.datetime.combine(days[r["id"]], dt.time())
        assert (r["a"], r["b"], r["c"]) == (day, day.replace(hour=10, minute=20), day)
        assert r["mixed"] == (day if r["id"] % 3 else None) and r["either"] == dt.datetime(2020, 1 + r["id"] % 9, 5)
    bad = DF.elected_problems(df, names)
    assert bad.count() == sum(i % 3 == 0 for i in range(200)) and bad.filter("mixed NOT LIKE '2024-%'").count() == 0


def test_one_bad_value_of_three(spark):
    df = spark.createDataFrame([(1, "1971-05-09"), (2, "sin fecha"), (3, "2004-08-17"), (4, None)], "id int, `f.n` string")
    assert DF.elected_problems(df, ["f.n"]).count() == 1
    typed = DF.coerce_elected(df, ["f.n"])
    assert typed.schema["f.n"].dataType.simpleString() == "timestamp_ntz" and typed.filter("`f.n` IS NOT NULL").count() == 2


def test_what_a_layout_reads(spark):
    cases = {("2024-02-30", "ymd"): None, ("29/02/2024", "dmy"): dt.datetime(2024, 2, 29), ("29/02/2023", "dmy"): None, ("1/2/2024", "mdy"): dt.datetime(2024, 1, 2),
             ("1/2-2024", "dmy"): None, ("01/02/24", "dmy"): None, ("2024/1/2T03:04:05.25", "ymd"): dt.datetime(2024, 1, 2, 3, 4, 5, 250000),
             ("20240102", "ymd"): dt.datetime(2024, 1, 2), ("20241302", "ymd"): None, ("2024-01-02 25:00", "ymd"): None, ("", "ymd"): None, (" 2024-01-02 ", "ymd"): dt.datetime(2024, 1, 2),
             ("99999999999-1-1", "ymd"): None, ("2024-01-02", "dmy"): None}
    df = spark.createDataFrame([(t,) for t, _ in cases], "t string").distinct()
    got = {(r["t"], x): r[x] for r in df.select("t", *[DF.read_date("t", x).alias(x) for x in DF.LAYOUTS]).collect() for x in DF.LAYOUTS}
    assert {k: got[k] for k in cases} == cases


def test_no_rows_and_no_columns(spark):
    df = spark.createDataFrame([], "a string")
    assert DF.elect_layouts(df, ["a"]) == {"a": "ymd"} and DF.coerce_elected(df, ["a"]).count() == 0
    assert DF.elect_layouts(df, []) == {} and DF.elected_problems(df, []).count() == 0
    assert df.select(F.lit(1)).count() == 0

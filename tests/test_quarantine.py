"""Cleaning and profiling cases, on Spark frames, plus invariants."""

import datetime as dt

from pyspark.sql import functions as F

from tableflow import spec as S
from tableflow.operators import profiling as PRF
from tableflow.operators import quarantine as Q
from tableflow.operators.records import strip_columns
from tableflow.plans import derived as DV

PAC = S.PERIOD_SPECS["PACIENTES"]


def test_strip_spaces(spark):
    df = spark.createDataFrame([("  Ada  ", " Lima"), ("Zoë ", "Quito  "), (" Otto", "Oslo")],
                               "NOMBRE string, CIUDAD string")
    rows = strip_columns(df).collect()
    assert rows[0]["NOMBRE"] == "Ada" and rows[0]["CIUDAD"] == "Lima" and rows[1]["NOMBRE"] == "Zoë"


def test_duplicates_found(spark):
    df = spark.createDataFrame([(1, "Ada"), (2, "Zoë"), (2, "Zoë"), (3, "Otto")], "PACIENTE_ID int, NOMBRE string")
    clean, dup = Q.split_duplicates(df)
    assert clean.count() == 3 and dup.count() == 1


def test_no_duplicates(spark):
    df = spark.createDataFrame([("Ada", "Lima"), ("Zoë", "Quito"), ("Otto", "Oslo")], "NOMBRE string, CIUDAD string")
    assert Q.split_duplicates(df)[1].count() == 0


def test_hot_duplicate_group_is_exact(spark):
    rows = [(1, "a")] * 5000 + [(2, "b")] * 3 + [(None, None)] * 4
    df = spark.createDataFrame(rows, "k int, v string").repartition(7)
    clean, dup = Q.split_duplicates(df, chunk=7)
    assert clean.count() == 3
    got = {(r["k"], r["v"]): r["count"] for r in dup.groupBy("k", "v").count().collect()}
    assert got == {(1, "a"): 4999, (2, "b"): 2, (None, None): 3}


def test_bad_dates_reported_and_typed(spark):
    df = spark.createDataFrame([(1, "1971-05-09"), (2, "sin fecha"), (3, "2004-08-17")],
                               "PACIENTE_ID int, FECHA_NACIMIENTO string")
    probs = Q.date_problems(df, ["FECHA_NACIMIENTO"])
    assert probs.count() == 1
    typed = Q.coerce_dates(df, ["FECHA_NACIMIENTO"])
    assert typed.schema["FECHA_NACIMIENTO"].dataType.simpleString() == "timestamp_ntz"
    assert typed.orderBy("PACIENTE_ID").first()[1] == dt.datetime(1971, 5, 9)


def _nulls_frame(spark):
    return spark.createDataFrame(
        [(1, "Ada", "1971-05-09", "2024-01-01"), (None, "Zoë", "1983-11-30", "2024-01-02"),
         (3, "Otto", "2004-08-17", "2024-01-03")],
        "PACIENTE_ID int, NOMBRE string, FECHA_NACIMIENTO string, CREATED_AT string")


def test_clean_table_required_nulls(spark):
    clean, probs = Q.clean_table(_nulls_frame(spark), PAC)
    assert clean.filter(F.col("PACIENTE_ID").isNull()).count() == 0
    assert probs.count() >= 1
    assert probs.first()[Q.PROBLEM] == "PACIENTE_ID: valor requerido nulo"


def test_clean_table_returns_frames(spark):
    res = Q.clean_table(_nulls_frame(spark), PAC)
    clean, probs = res
    assert hasattr(clean, "schema") and hasattr(probs, "schema")


def test_clean_table_perfect_data(spark):
    df = _nulls_frame(spark).fillna({"PACIENTE_ID": 2})
    clean, probs = Q.clean_table(df, PAC)
    assert clean.count() == 3 and probs.count() == 0


def test_clean_accounting_invariant(spark, sf):
    p = DV.patients(spark, sf)
    clean, probs = Q.clean_table(p, PAC)
    counts = {r[Q.PROBLEM]: r["filas"] for r in Q.problem_counts(probs).collect()}
    assert counts == {r[Q.PROBLEM]: r["filas"] for r in Q.count_problems(Q.tag_table(p, PAC), PAC).collect()}
    dates = sum(v for k, v in counts.items() if "fecha inválida" in k)
    assert clean.count() + sum(counts.values()) - dates == p.count()


def test_profile_shape_and_counts(spark):
    df = spark.createDataFrame([(1, "Ada", "1971-05-09"), (2, "Zoë", "1983-11-30"), (3, "Otto", "2004-08-17")],
                               "PACIENTE_ID int, NOMBRE string, FECHA_NACIMIENTO string")
    prof = PRF.profile_table(df, "PACIENTES")
    rows = prof.collect()
    assert {r["columna"] for r in rows} == {"PACIENTE_ID", "NOMBRE", "FECHA_NACIMIENTO"}
    assert all(r["total_filas"] == 3 and r["total_cols"] == 3 and r["tabla"] == "PACIENTES" for r in rows)


def test_profile_nulls_and_percent(spark):
    df = spark.createDataFrame([(1, "Ada", None), (None, "Zoë", "1983-11-30"), (3, None, "2004-08-17")],
                               "PACIENTE_ID int, NOMBRE string, FECHA_NACIMIENTO string")
    rows = {r["columna"]: r for r in PRF.profile_table(df, "X").collect()}
    for c in ("PACIENTE_ID", "NOMBRE", "FECHA_NACIMIENTO"):
        assert rows[c]["nulos"] == 1 and rows[c]["pct_nulos"] == 33.33


def test_profile_duplicates_count_null_as_value(spark):
    df = spark.createDataFrame([(1,), (None,), (None,), (1,)], "v int")
    r = PRF.profile_table(df, "X").first()
    assert r["duplicados"] == 2 and r["unicos"] == 1


def test_profile_empty_frame(spark):
    df = spark.createDataFrame([], "PACIENTE_ID int, NOMBRE string")
    rows = PRF.profile_table(df, "X").collect()
    assert len(rows) == 2 and all(r["total_filas"] == 0 and r["pct_nulos"] == 0.0 for r in rows)


def test_target_checks(spark):
    spec = S.TableSpec("t", (S.ColumnRule("n", S.INT, "smallint"), S.ColumnRule("s", S.TEXT, "string", 3)))
    df = spark.createDataFrame([(5, "ab"), (40000, "ab"), (5, "abcd")], "n long, s string")
    ok, bad = Q.conform_to_target(df, spec)
    assert ok.count() == 1
    assert sorted(r[Q.PROBLEM] for r in bad.collect()) == ["n: fuera de rango para smallint", "s: texto mayor a 3"]


def test_blank_required_passes_unless_blank_as_null(spark):
    df = spark.createDataFrame([(1, "   ", "1971-05-09")], "PACIENTE_ID int, NOMBRE string, FECHA_NACIMIENTO string")
    assert Q.clean_table(df, PAC).clean.count() == 1
    assert Q.clean_table(df, PAC, blank_as_null=True).problems.first()[Q.PROBLEM] == "NOMBRE: valor requerido nulo"


def test_first_n_threshold_path_is_exact(spark):
    import random
    rnd = random.Random(3)
    vals = rnd.sample(range(10_000_000), 20_000)
    df = spark.createDataFrame([(v, str(v)) for v in vals], "o long, s string").repartition(9)
    got = [r["o"] for r in PRF.first_n(df, 500, "o").collect()]
    assert sorted(got) == sorted(vals)[:500]
    assert PRF.first_n(df, 50_000, "o").count() == 20_000
    with_nulls = df.union(spark.createDataFrame([(None, "n")] * 3, "o long, s string"))
    got = PRF.first_n(with_nulls, 500, "o").collect()
    want = with_nulls.orderBy("o").limit(500).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)


def test_profile_long_values_grouped_exactly(spark):
    long_a, long_b = "x" * 500, "x" * 499 + "y"
    df = spark.createDataFrame([(long_a,), (long_a,), (long_b,), ("short",), (None,)], "v string")
    r = PRF.profile_table(df, "X").first()
    assert (r["unicos"], r["duplicados"], r["nulos"]) == (3, 1, 1)


def test_profile_of_floats(spark):
    """NaN is no value; 0.0 and -0.0 are one."""
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),)], "v double")
    r = PRF.profile_table(df, "X").first()
    assert (r["nulos"], r["unicos"], r["duplicados"]) == (1, 1, 1)


def test_huge_integers_are_rejected(spark):
    from tableflow.operators import ingest as ING
    spec = S.TableSpec("t", (S.ColumnRule("k", S.INT, "int"), S.ColumnRule("c", S.CODE, "int")))
    df = spark.createDataFrame([("1" * 39, "5", 1), ("7", "-" + "9" * 60, 2), ("7", "0", 3)], "k string, c string, n int")
    ok, bad = ING.prepare_load(df, spec, "n")
    assert [r["n"] for r in ok.collect()] == [3]
    assert {r["n"]: r[Q.PROBLEM] for r in bad.collect()} == {1: "k: fuera de rango para int", 2: "c: fuera de rango para int"}

"""Delimited scan, insert-ignore, bulk load, ledger and delivery."""

import tempfile

import pytest
from pyspark.sql import functions as F

from tableflow import spec as S
from tableflow.operators import delivery as DLV
from tableflow.operators import ingest as ING
from tableflow.operators import ledger as LED
from tableflow.session import scratch_path
from tableflow.sources import database as DB
from tableflow.sources import delimited as DL


def test_delimited_file_rules(spark):
    d = tempfile.mkdtemp(prefix="tf-file-")
    text = ' Id »"Name" » Extra\n1»á\n\n2»"q»z"\n3\n4»b»c»d\n5»"say ""hi"""\n'
    with open(f"{d}/f.txt", "w", encoding="latin-1") as fh:
        fh.write(text)
    rows = DL.read_delimited(spark, d).collect()
    cols = DL.read_delimited(spark, d).columns
    assert cols == ["id", "name", "extra"]
    assert [r[0] for r in rows] == ["1", "2", "3", "4", "5"]          # blank line skipped
    assert rows[0][1] == "á" and rows[1][1] == "q»z" and rows[2][1] is None   # latin-1, quoted », short row
    assert rows[3][1] == "b" and rows[3][2] == "c"                   # extra field dropped
    assert rows[4][1] == 'say "hi"'
    assert DL.read_delimited(spark, d, drop_quotes=True).columns == ["id", "name", "extra"]
    assert DL.line_count(spark, d).first()[0] == 6


def test_insert_ignore_null_safe_and_first_wins(spark):
    target = spark.createDataFrame([(1, None, "old")], "a int, b int, v string")
    inc = spark.createDataFrame([(1, None, "x", 2), (2, None, "late", 9), (2, None, "early", 1), (3, 3, "z", 5)],
                                "a int, b int, v string, o int")
    new = ING.insert_ignore(target, inc, ["a", "b"], ["o"]).drop("o")
    got = sorted((r["a"], r["b"], r["v"]) for r in new.collect())
    assert got == [(2, None, "early"), (3, 3, "z")]


def test_load_twice_equals_load_once(spark):
    spec = S.TableSpec("t", (S.ColumnRule("k", S.INT, "int"), S.ColumnRule("d", S.DATE, "date"),
                             S.ColumnRule("txt", S.TEXT, "string", 5)), key=("k", "d"), load_time_column="cargado_en")
    raw = spark.createDataFrame([("1", "01/02/2020", " A ", 1), ("1", "2020-02-01", "b", 2), ("", "", "c", 3),
                                 (" ", "junk", "d", 4), ("99999999999", "", "e", 5), ("2", "", "toolong", 6)],
                                "k string, d string, txt string, n int")
    target = scratch_path(spark, "t_load")
    ING.create_target(spark, spec, path=target)
    r1 = ING.bulk_load(spark, raw, spec, target, "n", load_time="2024-01-01 00:00:00")
    r2 = ING.bulk_load(spark, raw, spec, target, "n", load_time="2024-01-01 00:00:00")
    assert (r1.filas_procesadas, r1.enviadas, r1.insertadas, r1.rechazadas) == (6, 4, 2, 2)
    assert r1.enviadas == r1.insertadas + r1.conflictos
    assert r2.insertadas == 0 and r2.total_en_destino == r1.total_en_destino == 2
    got = sorted(((r["k"] or 0), r["txt"]) for r in spark.read.parquet(target).collect())
    assert got == [(0, "c"), (1, "a")]


def test_copy_lines(spark):
    from tableflow.operators.records import copy_text_lines
    df = spark.createDataFrame([("a\\b", "x\ty\nz\r", None)], "a string, b string, c string")
    assert copy_text_lines(df, ["a", "b", "c"]).first()[0] == "a\\\\b\tx y z \t\\N"


def test_ledger_latest_and_pending(spark):
    path = scratch_path(spark, "ledger")
    LED.append_run(spark, path, "A", "2024-01-01", "2024-01-31", 10, 10, "OK")
    LED.append_run(spark, path, "A", "2024-02-01", "2024-02-28", 10, 9, "ERROR", "DISCREPANCIA")
    LED.append_run(spark, path, "B", "2024-01-01", "2024-01-31", 5, 5, "OK")
    led = LED.read_ledger(spark, path)
    latest = {r["tabla"]: r["fecha_inicio"] for r in LED.latest_ok(led).collect()}
    assert latest == {"A": "2024-01-01", "B": "2024-01-01"}
    tables = spark.createDataFrame([("a",), ("B",), ("C",)], "tabla string")
    pend = {r[0] for r in LED.pending_extractions(tables, led, "2024-01-01", "2024-01-31").collect()}
    assert pend == {"C"}
    pend2 = {r[0] for r in LED.pending_extractions(tables, led, "2024-01-01", "2024-03-31").collect()}
    assert pend2 == {"a", "B", "C"}


def test_reconcile_mismatch_message(spark):
    s = spark.createDataFrame([("A", 10), ("B", 5)], "tabla string, filas long")
    e = spark.createDataFrame([("A", 10), ("B", 4)], "tabla string, filas long")
    rows = {r["tabla"]: r for r in LED.reconcile_counts(s, e).collect()}
    assert rows["A"]["estado"] == "OK" and rows["B"]["mensaje"] == "DISCREPANCIA: Oracle=5 | CSV=4"


def test_detect_keys_lowest_position_then_name(spark):
    tables = spark.createDataFrame([("t1",), ("t2",)], "table_name string")
    cons = spark.createDataFrame([("C1", "O", "P", "T1"), ("C2", "O", "U", "T2")],
                                 "constraint_name string, owner string, constraint_type string, table_name string")
    cols = spark.createDataFrame([("C1", "O", "ZETA", 1), ("C1", "O", "ALFA", 1), ("C1", "O", "B", 2)],
                                 "constraint_name string, owner string, column_name string, position int")
    got = {r[0]: r[1] for r in LED.detect_keys(tables, cons, cols).collect()}
    assert got == {"T1": "ALFA", "T2": "ROWID"}


def test_delivery_name_and_digest_layout_independent(spark):
    df = spark.createDataFrame([("pacientes",)], "t string")
    assert df.select(DLV.delivery_name(F.col("t"), "2024-01-01", "2024-03-31")).first()[0] == "PACIENTES_2024_01-03.csv"
    data = spark.range(0, 1000).withColumn("s", F.col("id").cast("string"))
    a = DLV.content_digest(data.repartition(3)).first()
    b = DLV.content_digest(data.repartition(7)).first()
    assert a == b


def test_range_predicates_cover_every_row_once(spark):
    df = spark.range(-5, 120).union(spark.createDataFrame([(None,)], "id long"))
    preds = DB.range_predicates("id", 0, 100, 7)
    assert DB.union_pages(df, preds).count() == df.count()
    opts = DB.jdbc_options("jdbc:x", "T", "ID", 0, 100, 7)
    assert opts["numPartitions"] == "7" and opts["fetchsize"] == "10000"


def test_insert_ignore_hot_key_is_exact(spark):
    rows = [(7, None, f"v{i}", i) for i in range(3000)] + [(i, 1, "x", i) for i in range(6000)]
    inc = spark.createDataFrame(rows, "a int, b int, v string, o int").repartition(6)
    target = spark.createDataFrame([(1, 1, "old")], "a int, b int, v string")
    new = ING.insert_ignore(target, inc, ["a", "b"], ["o"])
    assert new.count() == 6000                      # 5999 normal keys + the hot key (7, null)
    assert new.filter("a = 7 AND b IS NULL").first()["v"] == "v0"


def test_load_report_accounting(spark):
    spec = S.TableSpec("t", (S.ColumnRule("k", S.INT, "smallint"), S.ColumnRule("t", S.TEXT, "string", 3)), key=("k",))
    raw = spark.createDataFrame([(str(i % 50), "ab", i) for i in range(200)] + [("99999", "ab", 500), ("1", "long", 501)],
                                "k string, t string, n int")
    target = scratch_path(spark, "acct")
    ING.create_target(spark, spec, path=target)
    r = ING.bulk_load(spark, raw, spec, target, "n")
    assert r.segundos > 0 and r.filas_por_segundo == round(r.enviadas / r.segundos, 1)
    assert ING.LoadReport(1, 1, 1, 0, 0, 1).filas_por_segundo == 0.0
    assert r.filas_procesadas == r.enviadas + r.rechazadas == 202
    assert r.enviadas == r.insertadas + r.conflictos and r.insertadas == 50 and r.rechazadas == 2


def test_inspect_file(spark):
    from tableflow.operators import profiling as PRF
    d = tempfile.mkdtemp(prefix="tf-insp-")
    with open(f"{d}/f.txt", "w", encoding="latin-1") as fh:
        fh.write('A»"B"»C\n1»1.5»"x\ny"\n2»NULL»y\n--3»»\n4»2e3»z\n')
    out = PRF.inspect_file(spark, d)
    cols = {r["columna"]: (r["tipo_inferido"], r["porcentaje_nulos"], r["filas_analizadas"]) for r in out["columnas"].collect()}
    assert cols == {"a": ("int", 0.0, 4), "b": ("float", 50.0, 4), "c": ("str", 25.0, 4)}   # a quoted line break is no record
    assert tuple(out["lineas"].first()) == (5, 3) and out["extremos"].count() == 8
    ends = {r["a"]: r for r in out["extremos"].filter("lado = 'head'").collect()}
    assert ends["1"]["a_int"] == 1 and ends["1"]["b_float"] == 1.5 and ends["--3"]["a_int"] is None
    assert PRF.inspect_file(spark, d, sample_rows=2)["columnas"].first()["filas_analizadas"] == 2


def test_file_ordinal_follows_file_order(spark):
    path = scratch_path(spark, "ord")
    spark.range(5000).selectExpr("cast(id as string) AS n").coalesce(1).write.option("header", True).csv(path)
    df = spark.read.option("header", True).option("maxPartitionBytes", 4096).csv(path)
    rows = DL.with_file_ordinal(df).orderBy(DL.ORDINAL).select("n").collect()
    assert [int(r[0]) for r in rows] == list(range(5000))


def _spec():
    return S.TableSpec("t", (S.ColumnRule("k", S.INT, "int"), S.ColumnRule("d", S.DATE, "date"), S.ColumnRule("txt", S.TEXT)),
                       key=("k", "d"), load_time_column="cargado_en")


def test_targets_are_created_emptied_and_refused(spark):
    spec, raw = _spec(), spark.createDataFrame([("1", "2020-01-01", "a", 1)], "k string, d string, txt string, n int")
    path = scratch_path(spark, "refuse")
    with pytest.raises(ValueError, match="does not exist"):
        ING.bulk_load(spark, raw, spec, path, "n")
    ING.create_target(spark, spec, path=path)
    assert ING.read_target(spark, path, spec).schema.fieldNames() == ["k", "d", "txt", "cargado_en"]
    ING.bulk_load(spark, raw, spec, path, "n")
    ING.create_target(spark, spec, path=path)      # does nothing to a target that is there
    assert ING.read_target(spark, path, spec).count() == 1
    ING.truncate_target(spark, path, spec)
    assert ING.read_target(spark, path, spec).count() == 0
    other = scratch_path(spark, "shape")
    spark.createDataFrame([("1", "x")], "k string, txt string").write.parquet(other)
    with pytest.raises(ValueError, match="k is string, not int"):
        ING.bulk_load(spark, raw, spec, other, "n")


def test_bulk_load_into_a_bucketed_table(spark):
    spec, name = _spec(), "tf_bucketed_target"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    ING.create_target(spark, spec, table=name, bucket_by_key=4)
    raw = spark.createDataFrame([(str(i % 7), "2020-01-01" if i % 2 else "", "a", i) for i in range(40)], "k string, d string, txt string, n int")
    first, again = (ING.bulk_load(spark, raw, spec, name, "n") for _ in range(2))
    assert (first.insertadas, first.total_en_destino) == (14, 14) and (again.insertadas, again.total_en_destino) == (0, 14)
    inc = raw.selectExpr("CAST(k AS INT) AS k", "to_date(nullif(d, '')) AS d", "txt", "n").drop("txt")
    plan = ING.insert_ignore(ING.read_target(spark, name, spec), inc, spec.key, ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
    spark.sql(f"DROP TABLE {name}")


def test_split_file_keeps_records_and_their_order(spark):
    one, parts = scratch_path(spark, "one"), scratch_path(spark, "parts")
    rows = [(str(i), f"x{chr(10)}y»{i}" if i % 3 else None) for i in range(200)]
    DL.write_delimited(spark.createDataFrame(rows, "a string, b string").coalesce(1), one)
    DL.split_records(spark, one, parts, files=5)
    back = DL.read_delimited(spark, parts, multi_line=True)
    assert back.rdd.getNumPartitions() > 1
    got = sorted((int(r[DL.LINE]), r["a"], r["b"]) for r in back.collect())
    assert [(a, b) for _, a, b in got] == rows


def test_ragged_records_are_flagged(spark):
    d = tempfile.mkdtemp(prefix="tf-ragged-")
    with open(f"{d}/f.txt", "w", encoding="latin-1") as fh:
        fh.write("a»b\n1»2\n3\n4»5»6\n")
    rows = {r["a"]: r["malo"] for r in DL.read_delimited(spark, d, corrupt_column="malo").collect()}
    assert rows == {"1": None, "3": "3", "4": "4»5»6"}


def test_csv_null_tokens_before_types(spark):
    d = tempfile.mkdtemp(prefix="tf-na-")
    with open(f"{d}/f.csv", "w") as fh:
        fh.write("a,b,c,d,e\n1,NA,NaN,True,NONE\n2,N/A,1.5,False,none\n,#N/A,-2,nan,x\n")
    df = DL.read_csv_inferred(spark, d)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint", "string", "double", "boolean", "string"]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(
        [(1, None, None, True, "NONE"), (2, None, 1.5, False, "none"), (None, None, -2.0, None, "x")], key=str)


def test_digest_tells_rows_apart(spark):
    one = lambda a, b: DLV.content_digest(spark.createDataFrame([(a, b)], "a string, b string")).first()["digest"]
    assert len({one("a|b", "c"), one("a", "b|c"), one(None, "c"), one("\\N", "c"), one("-", "c"), one("", "c")}) == 6


def test_part_files_have_the_md5_of_their_bytes(spark):
    import glob
    import hashlib
    root = scratch_path(spark, "md5")
    DL.write_csv_by_table(spark.createDataFrame([("A", 1), ("A", 2), ("B", 3)], "tabla string, v int").coalesce(1), root, "tabla")
    rows = DLV.parts_by_table(DLV.part_file_md5(spark, f"{root}/tabla=*")).collect()
    got = {p["md5"] for r in rows for p in r["partes"]}
    want = {hashlib.md5(open(f, "rb").read()).hexdigest() for f in glob.glob(f"{root.removeprefix('file:')}/tabla=*/*.csv")}
    assert got == want and {r["tabla"] for r in rows} == {"A", "B"}


def test_key_catalogue_quotes_the_owner():
    assert "owner = 'O''X'" in DB.key_catalogue_queries("O'X")["constraints"]

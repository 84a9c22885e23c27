"""The whole period run on small derived tables: phases, ledger, resume, manifest."""

from pyspark.sql import functions as F

from tableflow import spec as S
from tableflow.operators import ledger as LED
from tableflow.plans import derived as DV
from tableflow.plans import period_run as PR
from tableflow.session import scratch_path
from tableflow.sources import database as DB


def test_run_period_end_to_end(spark, sf):
    events = DV.table(spark, sf, "events")
    specs = {
        "CLICKS": S.TableSpec("CLICKS", required=("event_id",), window_column="ts"),
        "NACIONES": S.TableSpec("NACIONES", required=("n_name",)),
    }
    readers = {"CLICKS": events.filter(F.col("event_type") == "click"), "NACIONES": DV.table(spark, sf, "nation")}
    root = scratch_path(spark, "run")
    res = PR.run_period(spark, readers.__getitem__, specs, "2024-01-10", "2024-01-15", root)
    assert res["extraccion"] and res["perfilado"] and res["limpieza"] and res["carga"]
    m = {r["tabla"]: r for r in spark.read.json(f"{root}/salida/periodo=2024-01-10_2024-01-15/manifiesto").collect()}
    assert m["NACIONES"]["filas_csv"] == 25 and m["NACIONES"]["filas_oracle"] == 25
    assert m["CLICKS"]["archivo"] == "CLICKS_2024_01-01.csv"
    led = LED.read_ledger(spark, f"{root}/control/ledger")
    assert led.filter(F.col("estado") == "OK").count() == 2
    PR.run_period(spark, readers.__getitem__, specs, "2024-01-10", "2024-01-15", root)   # resume: nothing new
    assert LED.read_ledger(spark, f"{root}/control/ledger").count() == 2


def _specs():
    return {"A": S.TableSpec("A", required=("k",)), "B": S.TableSpec("B", required=("k",), date_columns=("d",))}


def test_errors_reach_the_ledger_in_full(spark):
    root, long = scratch_path(spark, "run"), "x" * 5000

    def reader(name):
        raise ValueError(long)

    res = PR.run_period(spark, reader, _specs(), "2024-01-01", "2024-01-31", root)
    assert res["extraccion"] is False and "perfilado" not in res
    rows = LED.read_ledger(spark, f"{root}/control/ledger").collect()
    assert len(rows) == 1 and rows[0]["estado"] == "ERROR" and long in rows[0]["mensaje"]


def test_a_table_that_cannot_be_cleaned_is_noted(spark, monkeypatch):
    root = scratch_path(spark, "run")
    df = spark.createDataFrame([(1, "2020-01-01"), (1, "2020-01-01"), (None, "x")], "k int, d string")
    whole = PR.Q.tag_table
    monkeypatch.setattr(PR.Q, "tag_table", lambda d, spec, *a: whole(d, spec, *a) if spec.name == "B" else 1 / 0)
    res = PR.run_period(spark, lambda name: df, _specs(), "2024-01-01", "2024-01-31", root)
    assert res["limpieza"] is False and "carga" not in res
    errors = LED.read_ledger(spark, f"{root}/control/ledger").filter("estado = 'ERROR'").collect()
    assert [e["tabla"] for e in errors] == ["A"] and "division by zero" in errors[0]["mensaje"]
    stage = lambda s: spark.read.parquet(PR._stage_path(root, s, "B", "2024-01-01", "2024-01-31"))
    assert stage("limpios").count() == 1 and stage("problemas").count() == 2 and stage("etiquetados").count() == 2


def test_only_chosen_tables_are_delivered(spark):
    root = scratch_path(spark, "run")
    df = spark.createDataFrame([(1, "2020-01-01")], "k int, d string")
    PR.run_period(spark, lambda name: df, _specs(), "2024-01-01", "2024-01-31", root)
    PR.run_period(spark, lambda name: df, _specs(), "2024-01-01", "2024-01-31", root, tables=["b"])
    m = spark.read.json(f"{root}/salida/periodo=2024-01-01_2024-01-31/manifiesto").collect()
    assert [r["tabla"] for r in m] == ["B"] and len(m[0]["partes"][0]["md5"]) == 32 and m[0]["digest"]


def test_detected_keys_reach_the_reader(spark):
    cons = spark.createDataFrame([("C1", "O", "P", "A")], "constraint_name string, owner string, constraint_type string, table_name string")
    cols = spark.createDataFrame([("C1", "O", "k", 1)], "constraint_name string, owner string, column_name string, position int")
    asked = []

    def load(session, options):
        asked.append(options)
        if options["dbtable"].startswith("("):
            return session.createDataFrame([(3, 90)], "lo int, hi int")
        return session.createDataFrame([(3, "2020-01-01"), (90, None)], "k int, d string")

    reader = DB.jdbc_reader(spark, "jdbc:none", partitions=4, load=load)
    assert PR.extract_phase(spark, reader, _specs(), "2024-01-01", "2024-01-31", scratch_path(spark, "run"),
                            scratch_path(spark, "ledger"), catalogue=(cons, cols))
    ranges = {o["dbtable"]: (o.get("partitionColumn"), o.get("lowerBound"), o.get("upperBound"), o.get("numPartitions")) for o in asked
              if not o["dbtable"].startswith("(")}
    assert ranges == {"A": ("k", "3", "91", "4"), "B": (None, None, None, None)}

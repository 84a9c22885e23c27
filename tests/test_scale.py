"""Inputs of odd values, and work that is dealt out as the tables grow."""

import datetime as dt
import math

from tableflow.operators import ingest as ING
from tableflow.plans import derived as DV
from tableflow.plans import registry as REG
from tableflow.streaming import resumable as ST


def _write(df, root, name):
    df.write.parquet(f"{root}/{name}.parquet")
    return str(root)


def test_more_rows_land_as_more_files_in_as_many_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(REG, "STREAM_FILE_ROWS", 10)
    day = dt.datetime(2024, 1, 1)
    events = spark.createDataFrame([(i, day, i, "view", 1.0, None) for i in range(150)],
                                   "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    sf = _write(events, tmp_path, "events")
    assert REG._landing(spark, sf, "events") == (16, 8)
    cfg = REG._event_stream(spark, sf)
    assert len(spark.read.parquet(cfg.source).inputFiles()) == 32
    assert spark.read.parquet(cfg.metrics).count() == 4
    assert ST.read_target(spark, cfg).count() == 150


def test_a_run_without_time_is_the_fastest(spark, tmp_path):
    rows = [("a", 1, 2.0), ("b", 7, 0.0), ("c", 3, 0.0), ("d", 9, -0.0), ("e", 5, None)]
    sf = _write(spark.createDataFrame(rows, "event_type string, user_id long, value double"), tmp_path, "events")
    speeds = {r["metodo"]: r["filas_s"] for r in DV.run_results(spark, sf).collect()}
    assert speeds == {"a": 25000.0, "b": math.inf, "c": math.inf, "d": -math.inf, "e": None}
    known = DV.run_results(spark, sf).filter("metodo <> 'e'")
    best = {r["criterio"]: r["metodo"] for r in REG.LED.best_runs(known).collect()}
    assert best == {"menor_ram": "a", "mayor_velocidad": "c"}


def test_elected_dates_are_read_by_many_tasks(spark, tmp_path):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(i)) for i in range(40)]
    sf = _write(spark.createDataFrame(rows, "o_orderkey long, o_orderdate timestamp_ntz").coalesce(1), tmp_path, "orders")
    out = REG.q_elected_dates(spark, sf)
    assert out.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert {r["o_orderkey"]: r["latina"] for r in out.collect()} == dict(rows)


def test_rows_are_dealt_out_by_their_number(spark, tmp_path, monkeypatch):
    sf = _write(spark.range(95).coalesce(1), tmp_path, "ids")
    monkeypatch.setattr(DV, "SPREAD_ROWS", 10)
    assert DV.table(spark, sf, "ids", spread=True).rdd.getNumPartitions() == 10
    assert DV.table(spark, sf, "ids", spread=True).count() == 95


def test_first_rows_hold_a_column_once(spark):
    df = spark.createDataFrame([(1, 2, 5, "b"), (1, 2, 5, "a"), (None, 3, 1, "n"), (None, 3, 0, "m")], "k int, o int, p int, v string")
    firsts = ING.first_per_key(df, ("k",), ("k", "o", "p"))
    assert sorted(firsts.collect(), key=str) == sorted([(1, 2, 5, "a"), (None, 3, 0, "m")], key=str) and firsts.columns == df.columns

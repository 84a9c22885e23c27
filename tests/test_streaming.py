"""Resumable ingestion: batches, resume, crash after write."""

import pytest
from pyspark.sql import functions as F

from tableflow.session import scratch_path
from tableflow.streaming import resumable as ST


def _cfg(spark, src, schema, **kw):
    return ST.StreamIngest(source=src, schema=schema, target=scratch_path(spark, "t"),
                           checkpoint=scratch_path(spark, "ck"), key=("k",), order=("o",),
                           max_files_per_trigger=1, metrics=scratch_path(spark, "m"), **kw)


def _land(spark, src, rows):
    spark.createDataFrame(rows, "k int, o int, v string").coalesce(1).write.mode("append").parquet(src)


def test_stream_equals_batch_and_resumes(spark):
    src = scratch_path(spark, "src")
    _land(spark, src, [(1, 1, "a"), (2, 2, "b")])
    _land(spark, src, [(2, 3, "late"), (3, 4, "c")])
    cfg = _cfg(spark, src, "k int, o int, v string")
    ST.run_until_caught_up(spark, cfg)
    assert sorted(tuple(r) for r in ST.read_target(spark, cfg).select("k", "v").collect()) == [
        (1, "a"), (2, "b"), (3, "c")]
    _land(spark, src, [(4, 5, "d"), (1, 6, "dup")])
    ST.run_until_caught_up(spark, cfg)
    m = spark.read.parquet(cfg.metrics).orderBy(ST.BATCH).collect()
    assert [r["filas_leidas"] for r in m] == [2, 2, 2]     # the restart read only the new file
    assert [r["insertadas"] for r in m] == [2, 1, 1]
    assert ST.read_target(spark, cfg).count() == 4


def crash_once(monkeypatch, batch):
    """The first run of a batch fails after its write, before the checkpoint commits it."""
    whole, failed = ST._batch_writer, []

    def writer(cfg):
        run = whole(cfg)

        def then_fail(df, batch_id):
            run(df, batch_id)
            if batch_id == batch and not failed:
                failed.append(batch_id)
                raise RuntimeError("injected failure")
        return then_fail

    monkeypatch.setattr(ST, "_batch_writer", writer)


def test_crash_after_write_before_commit(spark, monkeypatch):
    src = scratch_path(spark, "src")
    for i in range(3):
        _land(spark, src, [(i, i, "x"), (i + 10, i, "y")])
    cfg = _cfg(spark, src, "k int, o int, v string")
    crash_once(monkeypatch, 1)
    try:
        ST.run_until_caught_up(spark, cfg)
        raise AssertionError("the injected failure should stop the stream")
    except RuntimeError:
        pass
    ST.run_until_caught_up(spark, cfg)         # restart: batch 1 is replayed
    t = ST.read_target(spark, cfg)
    assert t.count() == 6 and t.select("k").distinct().count() == 6
    assert spark.read.parquet(cfg.target).agg(F.max(ST.BATCH)).first()[0] == 2


def test_a_batch_reads_no_earlier_rows(spark):
    """What the target holds does not matter: with an empty folder in its place, known keys stay known."""
    src = scratch_path(spark, "src")
    _land(spark, src, [(i, i, "x") for i in range(50)] + [(None, 1, "null key")])
    cfg = _cfg(spark, src, "k int, o int, v string")
    ST.run_until_caught_up(spark, cfg)
    assert ST.read_target(spark, cfg).count() == 51
    cfg.target = scratch_path(spark, "other")
    _land(spark, src, [(i, 9, "y") for i in range(40, 60)] + [(None, 2, "null again")])
    ST.run_until_caught_up(spark, cfg)
    assert sorted(r["k"] for r in ST.read_target(spark, cfg).collect()) == list(range(50, 60))
    assert {k for k in ST.KEY_STORE if k in spark.conf.getAll} == set()     # the session is as it was


def test_first_of_a_batch_and_rejected_keys(spark):
    """The smallest order wins over files of a batch; a key that was only rejected is not taken for known."""
    src = scratch_path(spark, "src") + "/a [b] c%d"
    bad = F.when(F.col("v") == "bad", F.lit("bad"))
    cfg = _cfg(spark, src, "k int, o int, v string", prepare=lambda b: b.withColumn(ST.Q.PROBLEM, bad), rejects=scratch_path(spark, "r"))
    cfg.source, cfg.max_files_per_trigger = src.replace("[", "\\[").replace("]", "\\]"), 2
    _land(spark, src, [(1, 5, "late"), (2, 1, "bad")])
    _land(spark, src, [(1, 3, "first"), (1, 4, "bad")])
    ST.run_until_caught_up(spark, cfg)
    _land(spark, src, [(3, 1, "bad")])
    _land(spark, src, [(2, 2, "good"), (1, 1, "too late")])
    ST.run_until_caught_up(spark, cfg)
    assert sorted(tuple(r) for r in ST.read_target(spark, cfg).select("k", "v").collect()) == [(1, "first"), (2, "good")]
    m = spark.read.parquet(cfg.metrics).orderBy(ST.BATCH).drop(ST.BATCH).collect()
    assert [tuple(r) for r in m] == [(4, 2, 1, 1, 2), (3, 2, 1, 1, 1)]
    assert spark.read.parquet(cfg.rejects).count() == 3


def test_a_lost_checkpoint_is_refused(spark):
    src = scratch_path(spark, "src")
    _land(spark, src, [(1, 1, "a")])
    cfg = _cfg(spark, src, "k int, o int, v string")
    ST.run_until_caught_up(spark, cfg)
    cfg.checkpoint = scratch_path(spark, "ck")
    with pytest.raises(ValueError, match="checkpoint"):
        ST.run_until_caught_up(spark, cfg)

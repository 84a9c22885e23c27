"""Resumable insert-ignore ingestion with Structured Streaming.

The file source plus ``checkpointLocation`` replaces a "last committed row" file: a
restarted query reads only files it has not committed. ``maxFilesPerTrigger`` sizes
the batches (a file is never split across batches, so land big inputs as many files).

Which keys are stored already is state of the stream, not a question to the target: a
streaming aggregate holds, for each key, the first and the last batch that brought it (two
timestamps), in RocksDB below the checkpoint. A batch updates the keys it brings and gets
these back; a key whose first batch is its last is new. The rows of the new keys then come
from the batch's own files. So the work of a batch follows the batch, whatever the target
holds by then, and the earlier rows are never read again.

Replay safety: batch N is written to ``target/batch_id=N`` with overwrite, and a replayed
batch starts from the state that batch N - 1 committed, under the batch time that the
checkpoint keeps. If the job dies after the write but before the checkpoint commit, the
restarted query rewrites the same folder with the same rows, so every key is stored once.
"""

from __future__ import annotations

import re
from contextlib import contextmanager
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow import spec as S
from tableflow.operators import ingest as ING
from tableflow.operators import quarantine as Q
from tableflow.session import path_exists

BATCH = "batch_id"
_FILE, _AT, _FIRST, _LAST = "_tf_file", "_tf_at", "_tf_first_at", "_tf_last_at"
_GLOB = re.compile(r"([\[\]{}*?\\])")

METRICS_SCHEMA = T.StructType([
    T.StructField(BATCH, T.LongType()),
    T.StructField("filas_leidas", T.LongType()),
    T.StructField("enviadas", T.LongType()),
    T.StructField("insertadas", T.LongType()),
    T.StructField("conflictos", T.LongType()),
    T.StructField("rechazadas", T.LongType()),
])


@dataclass
class StreamIngest:
    """Where a resumable ingestion reads and writes."""
    source: str
    schema: T.StructType
    target: str
    checkpoint: str
    key: tuple
    order: tuple
    source_format: str = "parquet"
    max_files_per_trigger: int = 1
    rejects: str | None = None
    metrics: str | None = None
    options: dict = field(default_factory=dict)   # of the reader (header, sep, encoding, ...)
    prepare: object = None          # DataFrame -> rows tagged with the reason of a rejection (or null); row by row
    conform: object = None          # accepted rows -> rows of the target's types; row by row
    load_time_column: str | None = None


def _tagged(cfg: StreamIngest, raw: DataFrame) -> DataFrame:
    return cfg.prepare(raw) if cfg.prepare else raw.withColumn(Q.PROBLEM, F.lit(None).cast("string"))


def _conformed(cfg: StreamIngest, tagged: DataFrame) -> DataFrame:
    accepted = tagged.filter(F.col(Q.PROBLEM).isNull()).drop(Q.PROBLEM)
    return cfg.conform(accepted) if cfg.conform else accepted


def _seen_keys(cfg: StreamIngest, stream: DataFrame) -> DataFrame:
    """Per key that a batch brings: the time of the first and of the last batch that brought it; and the batch's files.

    Keys of rejected rows are not remembered. A file stands as a row of its own beside the
    keys (the branch reads no column), so that files without an accepted row are known too.
    Both are reduced in the tasks that read: a key holding a third of a batch sends one row
    a task.
    """
    names = ING.key_names(cfg.key)
    rows = _conformed(cfg, _tagged(cfg, stream))
    keys = rows.select(*ING.key_columns(rows, cfg.key), F.lit(None).cast("string").alias(_FILE))
    blank = [F.lit(None).cast(keys.schema[n].dataType).alias(n) for n in names]
    files = stream.select(*blank, F.col("_metadata.file_path").alias(_FILE))
    return (keys.union(files).withColumn(_AT, F.current_timestamp()).groupBy(*names, _FILE)
            .agg(F.min(_AT).alias(_FIRST), F.max(_AT).alias(_LAST)))


def _rows_of(spark: SparkSession, cfg: StreamIngest, files: list[str]) -> DataFrame:
    """The rows of some of the source's files, as the stream reads them."""
    reader = spark.read.schema(cfg.schema).format(cfg.source_format).options(**cfg.options)
    if not _GLOB.search(cfg.source):
        reader = reader.option("basePath", cfg.source)
    return reader.load([_GLOB.sub(r"\\\1", unquote(f)) for f in files])


def _batch_writer(cfg: StreamIngest):
    def run(touched: DataFrame, batch_id: int) -> None:
        spark, names = touched.sparkSession, ING.key_names(cfg.key)
        touched = touched.persist()     # the state is updated once
        # at most max_files_per_trigger paths
        files = [r[0] for r in touched.filter(F.col(_FILE).isNotNull()).select(_FILE).distinct().collect()]
        fresh = touched.filter(F.col(_FILE).isNull() & (F.col(_FIRST) == F.col(_LAST))).select(*names)
        # cleaned once: the persisted rows feed the rejects, the counts and the insert
        raw = _rows_of(spark, cfg, files) if files else spark.createDataFrame([], cfg.schema)
        tagged = _tagged(cfg, raw).persist()
        if cfg.rejects:
            (tagged.filter(F.col(Q.PROBLEM).isNotNull()).write.mode("overwrite")
             .parquet(f"{cfg.rejects}/{BATCH}={batch_id}"))
        accepted = _conformed(cfg, tagged)
        new = ING.insert_new(fresh, accepted, cfg.key, cfg.order)
        if cfg.load_time_column:
            new = ING.with_load_time(new, cfg.load_time_column)
        folder = f"{cfg.target}/{BATCH}={batch_id}"
        new.write.mode("overwrite").parquet(folder)
        if cfg.metrics:
            seen = tagged.agg(F.count(F.lit(1)).alias("n"), F.count(Q.PROBLEM).alias("bad")).first()
            inserted = spark.read.schema(new.schema).parquet(folder).count()   # of file footers
            submitted = seen["n"] - seen["bad"]
            row = [(batch_id, seen["n"], submitted, inserted, submitted - inserted, seen["bad"])]
            spark.createDataFrame(row, METRICS_SCHEMA).write.mode("overwrite").parquet(
                f"{cfg.metrics}/{BATCH}={batch_id}")
        tagged.unpersist()
        touched.unpersist()
    return run


#: state in RocksDB on the executors' disks; a commit uploads the batch's changes, not the store. The rules of a
#: wide record make a method that HotSpot, by its limit of 8000 bytes, would leave to its interpreter; beyond it
#: each projection is compiled by itself.
KEY_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


@contextmanager
def settings(spark: SparkSession):
    """A query that starts inside keeps its state and compiles its rules by ``KEY_STORE``, where the session says nothing else.

    A query takes the session's settings as they are when it starts; they are put back.
    """
    unset = [k for k in KEY_STORE if k not in spark.conf.getAll]
    for k in unset:
        spark.conf.set(k, KEY_STORE[k])
    try:
        yield
    finally:
        for k in unset:
            spark.conf.unset(k)


def start(spark: SparkSession, cfg: StreamIngest, available_now: bool = True):
    """Start (or resume) the ingestion; with ``available_now`` it stops when caught up.

    The keys stored so far are known from the checkpoint alone, so a target that has rows
    and no checkpoint is refused.
    """
    if path_exists(spark, cfg.target) and not path_exists(spark, cfg.checkpoint):
        raise ValueError(f"target {cfg.target} has rows, but its checkpoint {cfg.checkpoint} is gone")
    stream = (spark.readStream.schema(cfg.schema).format(cfg.source_format).options(**cfg.options)
              .option("maxFilesPerTrigger", cfg.max_files_per_trigger).load(cfg.source))
    writer = (_seen_keys(cfg, stream).writeStream.outputMode("update").foreachBatch(_batch_writer(cfg))
              .option("checkpointLocation", cfg.checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    with settings(spark):
        return writer.start()


def delimited_options(sep: str = S.BULK_SEPARATOR, encoding: str = S.BULK_ENCODING) -> dict:
    """Reader options of the delimited file for ``source_format="csv"``: quoted line breaks and all."""
    return {"header": "true", "sep": sep, "encoding": encoding, "quote": '"', "escape": '"', "multiLine": "true"}


def run_until_caught_up(spark: SparkSession, cfg: StreamIngest) -> None:
    q = start(spark, cfg, available_now=True)
    try:
        q.awaitTermination()
    except Exception as e:  # noqa: BLE001  (the batch error, surfaced as one type)
        raise RuntimeError(f"ingestion stopped: {e}") from e
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def read_target(spark: SparkSession, cfg: StreamIngest) -> DataFrame:
    return spark.read.parquet(cfg.target).drop(BATCH)


def batch_progress(metrics: DataFrame) -> DataFrame:
    """Running totals over the committed batches (small: one row per batch)."""
    from pyspark.sql import Window
    w = Window.orderBy(BATCH).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return metrics.select(BATCH, "filas_leidas", "insertadas",
                          F.sum("filas_leidas").over(w).alias("filas_acumuladas"),
                          F.sum("insertadas").over(w).alias("insertadas_acumuladas"),
                          F.row_number().over(Window.orderBy(BATCH)).alias("lote"))

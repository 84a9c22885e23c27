"""Helpers shared by the operators: row identity, fixed-size hash bitmaps, scratch tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.session import scratch_path

_BUCKET = 32768  # bits of one bitmap that Spark's bitmap functions build


def row_key(id_col: str, text_col: str) -> Column:
    """128-bit identity of a row: its id and its text.

    Made from content, so a task that runs again after an executor is lost gives the
    same key. Repeated rows share a key; every result here depends on id and text only.
    """
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("\u0001null")), F.lit("\u0000"),
                                  F.coalesce(F.col(text_col), F.lit("")))))


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id, the text and the row key; columns of other names cannot clash."""
    arrow_batches(df.sparkSession)
    return df.select(row_key(id_col, text_col).alias("row_key"), F.col(id_col).alias("doc_id"),
                     F.col(text_col).alias("text"))


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends here, on storage that outlives executors."""
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside are removed as soon as it is written; nobody reads them again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def slot(hash_col: str, bits: int) -> Column:
    return F.pmod(F.col(hash_col), F.lit(bits)) + 1


def bitmaps(slots: DataFrame, bits: int, **wanted: Column) -> dict[str, np.ndarray]:
    """One bitmap of ``bits`` bits for each condition on the rows (slot, ...).

    Built by partial aggregation; the driver gets ``bits / 8`` bytes for each whatever
    the size of the data.
    """
    s = F.col("slot")
    rows = (slots.groupBy(F.bitmap_bucket_number(s).alias("bucket"))
            .agg(*[F.bitmap_construct_agg(F.when(c, F.bitmap_bit_position(s))).alias(k) for k, c in wanted.items()]))
    out = {k: np.zeros(bits // 8, np.uint8) for k in wanted}
    for r in rows.collect():
        at = (r["bucket"] - 1) * (_BUCKET // 8)
        for k in wanted:
            part = np.frombuffer(bytes(r[k]), np.uint8)
            out[k][at:at + len(part)] = part[:len(out[k]) - at]
    return out


def hash_bitmap(df: DataFrame, hash_col: str, bits: int) -> Broadcast:
    """Bitmap with a bit for each hash of the column: a filter without false negatives,
    of ``bits / 8`` bytes whatever the size of the data."""
    found = bitmaps(df.select(slot(hash_col, bits).alias("slot")), bits, any=F.lit(True))
    return df.sparkSession.sparkContext.broadcast(found["any"])


def in_bitmap(bitmap: np.ndarray, bits: int, hashes: np.ndarray) -> np.ndarray:
    """Which of the (signed or unsigned) 64-bit hashes have their bit set."""
    at = hashes.astype(np.uint64).view(np.int64) % bits
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def signed(h: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit hashes as Spark's bigint."""
    return h.view(np.int64)


#: text that one Arrow batch between Spark and Python holds, where the session does not say
BATCH_BYTES = 4 << 20


def arrow_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes: rows alone do not bound them, since texts may be long."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def in_place(rows: DataFrame, bitmap: Broadcast, bits: int, hash_col: Column, has: bool) -> DataFrame:
    """Rows whose hash has (or lacks) its bit, filtered where they are read."""
    schema = rows.schema
    at = len(schema)

    def run(batches):
        for b in batches:
            mine = in_bitmap(bitmap.value, bits, b.column(at).to_numpy()) == has
            yield b.filter(pa.array(mine)).select(range(at))

    return rows.withColumn("__hash", hash_col).mapInArrow(run, schema)

"""Run ledger (append-only Parquet), resume planning, count reconciliation, key detection."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow import spec as S
from tableflow.session import path_exists

LEDGER_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("tabla", T.StringType(), False),
    T.StructField("fecha_inicio", T.StringType()),
    T.StructField("fecha_fin", T.StringType()),
    T.StructField("filas_oracle", T.LongType()),
    T.StructField("filas_extraidas", T.LongType()),
    T.StructField("estado", T.StringType()),
    T.StructField("mensaje", T.StringType()),
    T.StructField("ejecutado_en", T.TimestampNTZType(), False),
])


def append_run(spark: SparkSession, ledger_path: str, tabla: str, fecha_inicio: str, fecha_fin: str,
               filas_oracle: int, filas_extraidas: int, estado: str, mensaje: str = "",
               at: _dt.datetime | None = None) -> None:
    """Append one run record (also for failures, with the error text)."""
    at = at or _dt.datetime.now()
    run_id = int(at.timestamp() * 1_000_000)
    row = [(run_id, tabla, fecha_inicio, fecha_fin, filas_oracle, filas_extraidas, estado, mensaje, at)]
    spark.createDataFrame(row, LEDGER_SCHEMA).write.mode("append").parquet(ledger_path)


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    if path_exists(spark, ledger_path):
        return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)
    return spark.createDataFrame([], LEDGER_SCHEMA)


def latest_ok(ledger: DataFrame) -> DataFrame:
    """Latest successful run per table (ties on time broken by id), one partial aggregation."""
    ok = ledger.filter(F.col("estado") == S.STATE_OK)
    rest = [c for c in ledger.columns if c not in ("tabla", "ejecutado_en", "id")]
    best = F.max(F.struct(F.col("ejecutado_en"), F.col("id"), *[F.col(c) for c in rest])).alias("_b")
    return ok.groupBy("tabla").agg(best).select(
        F.col("_b.id").alias("id"), "tabla", *[F.col(f"_b.{c}").alias(c) for c in rest],
        F.col("_b.ejecutado_en").alias("ejecutado_en"))


def pending_extractions(tables: DataFrame, ledger: DataFrame, fecha_inicio: str, fecha_fin: str | None = None,
                        match: str = "both") -> DataFrame:
    """Tables still to extract: those whose latest success is not for the same period.

    ``match="start"`` compares the start date only (the original rule).
    """
    last = latest_ok(ledger)
    same = F.col("fecha_inicio") == F.lit(fecha_inicio)
    if match == "both" and fecha_fin is not None:
        same = same & (F.col("fecha_fin") == F.lit(fecha_fin))
    done = last.filter(same).select(F.upper("tabla").alias("_done"))
    return tables.join(done, F.upper(tables["tabla"]) == F.col("_done"), "left_anti")


def mismatch_message(source: Column, extracted: Column) -> Column:
    """The fixed message of two counts that differ."""
    before, between, after = S.MISMATCH_MESSAGE.replace("{source}", "{}").replace("{extracted}", "{}").split("{}")
    return F.concat(F.lit(before), source.cast("string"), F.lit(between), extracted.cast("string"), F.lit(after))


def reconcile_counts(source: DataFrame, extracted: DataFrame) -> DataFrame:
    """Source count vs extracted count per table; a difference is an error with its message."""
    s = source.select("tabla", F.col("filas").alias("filas_oracle"))
    e = extracted.select("tabla", F.col("filas").alias("filas_extraidas"))
    j = s.join(e, "tabla", "full")
    so, ex = F.coalesce(F.col("filas_oracle"), F.lit(0)), F.coalesce(F.col("filas_extraidas"), F.lit(0))
    equal = so == ex
    msg = mismatch_message(so, ex)
    return j.select("tabla", so.cast("long").alias("filas_oracle"), ex.cast("long").alias("filas_extraidas"),
                    F.when(equal, F.lit(S.STATE_OK)).otherwise(F.lit(S.STATE_ERROR)).alias("estado"),
                    F.when(equal, F.lit("")).otherwise(msg).alias("mensaje"))


def detect_keys(tables: DataFrame, constraints: DataFrame, columns: DataFrame) -> DataFrame:
    """First primary-key column (lowest position, then name) per table; ``ROWID`` when none.

    tables: (table_name); constraints: (constraint_name, owner, constraint_type, table_name);
    columns: (constraint_name, owner, column_name, position).
    """
    wanted = tables.select(F.upper("table_name").alias("table_name"))
    pk = constraints.filter(F.col("constraint_type") == "P").join(
        wanted.select(F.col("table_name").alias("_t")), F.col("table_name") == F.col("_t"), "left_semi")
    joined = pk.join(columns, ["constraint_name", "owner"])
    first = joined.groupBy("table_name").agg(
        F.min(F.struct("position", "column_name")).getField("column_name").alias("pk"))
    return wanted.join(first, "table_name", "left").select(
        "table_name", F.coalesce(F.col("pk"), F.lit(S.DEFAULT_KEY)).alias("pk"))


def best_runs(results: DataFrame) -> DataFrame:
    """The run with the lowest memory and the run with the highest speed (ties: the other metric, then all)."""
    cols = [c for c in results.columns if c not in ("ram_mb", "filas_s")]
    low = F.min(F.struct(F.col("ram_mb").alias("a"), (-F.col("filas_s")).alias("b"), *[F.col(c) for c in cols],
                         F.col("ram_mb")))
    fast = F.min(F.struct((-F.col("filas_s")).alias("a"), F.col("ram_mb").alias("b"), *[F.col(c) for c in cols],
                          F.col("ram_mb")))
    one = results.agg(low.alias("low"), fast.alias("fast"))
    pick = F.explode(F.array(
        F.struct(F.lit("menor_ram").alias("criterio"), F.col("low").alias("r")),
        F.struct(F.lit("mayor_velocidad").alias("criterio"), F.col("fast").alias("r"))))
    picked = one.select(pick.alias("p"))
    return picked.select(F.col("p.criterio").alias("criterio"), *[F.col(f"p.r.{c}").alias(c) for c in cols],
                         F.col("p.r.ram_mb").alias("ram_mb"))

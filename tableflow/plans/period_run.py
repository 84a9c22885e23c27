"""The period run: extract -> profile -> clean -> deliver, with ledger and resume.

Plain Python sequencing of Spark jobs. The loops run over the table catalogue (a few
configured tables), never over rows; every table is one distributed read, write and
count. Intermediate hand-over is Parquet (typed); CSV is a delivery format.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow import spec as S
from tableflow.operators import delivery as DLV
from tableflow.operators import ledger as LED
from tableflow.operators import profiling as PRF
from tableflow.operators import quarantine as Q
from tableflow.session import path_exists
from tableflow.sources import database as DB
from tableflow.sources import delimited as DL


CLEAN_FAILED = "limpieza"


def _stage_path(root: str, stage: str, table: str, start: str, end: str) -> str:
    return f"{root.rstrip('/')}/{stage}/periodo={start}_{end}/tabla={table.upper()}"


def table_keys(spark: SparkSession, names, catalogue) -> dict[str, str]:
    """Key column of each configured table, from the constraint catalogue (constraints, columns)."""
    tables = spark.createDataFrame([(n,) for n in names], "table_name string")
    # one row for each configured table
    return {r["table_name"]: r["pk"] for r in LED.detect_keys(tables, *catalogue).collect()}


def extract_phase(spark: SparkSession, reader: Callable[..., DataFrame], specs: dict, start: str, end: str,
                  root: str, ledger_path: str, tables=None, resume: bool = True, match: str = "both",
                  catalogue=None) -> bool:
    """Count and extract every pending table for the window; stop at the first mismatch or error.

    ``catalogue``: (constraints, columns) frames of the source; with it the reader is
    called as ``reader(name, key)``, the key detected there (``ROWID`` when a table has
    none), so that it can read ranges of the key in parallel
    (:func:`tableflow.sources.database.jdbc_reader`).
    """
    chosen = S.select_tables(specs, tables)
    keys = table_keys(spark, chosen, catalogue) if catalogue else {}
    ledger = LED.read_ledger(spark, ledger_path)
    if resume:
        names = spark.createDataFrame([(t,) for t in chosen], "tabla string")
        pending = {r["tabla"] for r in LED.pending_extractions(names, ledger, start, end, match).collect()}
    else:
        pending = set(chosen)
    for name, spec in chosen.items():
        out = _stage_path(root, "datos", name, start, end)
        if name not in pending and path_exists(spark, out):
            continue  # done for this period and its output is still there
        try:
            src = reader(name, keys[name.upper()]) if catalogue else reader(name)
            source_n = DB.count_window(src, spec.window_column, start, end).first()["filas"]
            DB.extract_window(src, spec.window_column, start, end).write.mode("overwrite").parquet(out)
            extracted_n = spark.read.parquet(out).count()
            if source_n != extracted_n:
                msg = S.MISMATCH_MESSAGE.format(source=source_n, extracted=extracted_n)
                LED.append_run(spark, ledger_path, name, start, end, source_n, extracted_n, S.STATE_ERROR, msg)
                return False
            LED.append_run(spark, ledger_path, name, start, end, source_n, extracted_n, S.STATE_OK)
        except Exception as e:  # noqa: BLE001  (recorded in the ledger, then stop)
            LED.append_run(spark, ledger_path, name, start, end, 0, 0, S.STATE_ERROR, str(e))
            return False
    return True


def _extracted(spark: SparkSession, root: str, specs: dict, start: str, end: str) -> dict[str, DataFrame]:
    out = {}
    for name in specs:
        p = _stage_path(root, "datos", name, start, end)
        if path_exists(spark, p):
            out[name] = spark.read.parquet(p)
    return out


def profile_phase(spark: SparkSession, specs: dict, start: str, end: str, root: str) -> DataFrame | None:
    """Quality report (per column) and summary (per table) for the period, as JSON."""
    tables = _extracted(spark, root, specs, start, end)
    if not tables:
        return None
    profile = None
    for name, df in tables.items():
        p = PRF.profile_table(df, name)
        profile = p if profile is None else profile.unionByName(p)
    report = f"{root}/reportes/{S.QUALITY_REPORT}_{start}_{end}"
    profile.coalesce(1).write.mode("overwrite").json(report)          # one row per column: bounded
    summary = PRF.quality_summary(spark.read.json(report))
    summary.coalesce(1).write.mode("overwrite").json(f"{root}/reportes/{S.QUALITY_SUMMARY}_{start}_{end}")
    return summary


def clean_phase(spark: SparkSession, specs: dict, start: str, end: str, root: str, ledger_path: str | None = None) -> bool:
    """Clean every extracted table; refuses to run without the quality report.

    Each table is tagged and counted once, in one write; the clean rows and the problems
    are read from it. A table that fails is noted in the ledger with its error, and the
    others go on.
    """
    if not path_exists(spark, f"{root}/reportes/{S.QUALITY_REPORT}_{start}_{end}"):
        return False
    ok = True
    for name, df in _extracted(spark, root, specs, start, end).items():
        try:
            spec = S.spec_by_name(specs, name)
            tagged_path = _stage_path(root, "etiquetados", name, start, end)
            Q.tag_table(df, spec).write.mode("overwrite").parquet(tagged_path)
            tagged = spark.read.parquet(tagged_path)
            Q.clean_of(tagged, spec).write.mode("overwrite").parquet(_stage_path(root, "limpios", name, start, end))
            Q.problems_of(tagged).write.mode("overwrite").parquet(_stage_path(root, "problemas", name, start, end))
        except Exception as e:  # noqa: BLE001  (noted, then the other tables)
            if ledger_path:
                LED.append_run(spark, ledger_path, name, start, end, 0, 0, S.STATE_ERROR, f"{CLEAN_FAILED}: {e}")
            ok = False
    return ok


def deliver_phase(spark: SparkSession, specs: dict, start: str, end: str, root: str, ledger_path: str) -> bool:
    """Write each clean table under its delivery name plus one manifest per period."""
    ledger = LED.latest_ok(LED.read_ledger(spark, ledger_path)).filter(
        (F.col("fecha_inicio") == start) & (F.col("fecha_fin") == end))
    out = f"{root}/salida/periodo={start}_{end}"
    digests, parts = None, None
    columns = {}
    for name in specs:
        src = _stage_path(root, "limpios", name, start, end)
        if not path_exists(spark, src):
            continue
        df = spark.read.parquet(src)
        columns[name] = df.columns
        # the file name drops the end year; the folder keeps the full period apart
        target = f"{out}/{DLV.delivery_file_name(name, start, end)}"
        DL.write_csv(df, target)
        # what the manifest says is said of the delivered files, read back
        back = DL.read_csv(spark, target, df.schema)
        d = DLV.content_digest(back).withColumn("tabla", F.lit(name.upper()))
        p = DLV.part_file_md5(spark, target).withColumn("path", F.concat(F.lit(f"/tabla={name.upper()}/"), F.regexp_extract("path", r"([^/]+)$", 1)))
        digests = d if digests is None else digests.unionByName(d)
        parts = p if parts is None else parts.unionByName(p)
    if digests is None:
        return False
    counts = digests.select("tabla", F.col("filas").alias("filas_csv")).join(
        ledger.select(F.upper("tabla").alias("tabla"), "filas_oracle"), "tabla", "left")
    summary_path = f"{root}/reportes/{S.QUALITY_SUMMARY}_{start}_{end}"
    summary = spark.read.json(summary_path) if path_exists(spark, summary_path) else None
    m = DLV.manifest(counts, digests, summary, start, end, columns, parts=DLV.parts_by_table(parts))
    DLV.write_manifest(m, f"{out}/manifiesto")
    return True


def run_period(spark: SparkSession, reader: Callable[[str], DataFrame], specs: dict, start: str, end: str,
               root: str, tables=None, resume: bool = True, catalogue=None) -> dict:
    """Extract, profile, clean, deliver; stop at the first failed phase. Returns the phase results."""
    ledger_path = f"{root}/control/ledger"
    result = {"inicio": start, "fin": end, "ejecutado_en": _dt.datetime.now().isoformat()}
    result["extraccion"] = extract_phase(spark, reader, specs, start, end, root, ledger_path, tables, resume,
                                         catalogue=catalogue)
    specs = S.select_tables(specs, tables)  # the later phases concern the chosen tables only
    if not result["extraccion"]:
        return result
    result["perfilado"] = profile_phase(spark, specs, start, end, root) is not None
    if not result["perfilado"]:
        return result
    result["limpieza"] = clean_phase(spark, specs, start, end, root, ledger_path)
    if not result["limpieza"]:
        return result
    result["carga"] = deliver_phase(spark, specs, start, end, root, ledger_path)
    return result


def summary_json(result: dict) -> str:
    return json.dumps(result, ensure_ascii=False)


def event_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole period run over driver tables (two event types, one catalogue table); returns its manifest."""
    from tableflow.plans import derived as DV
    from tableflow.session import scratch_path

    events = DV.table(spark, sf_dir, "events")
    specs = {"CLICKS": S.TableSpec("CLICKS", required=("event_id",), window_column="ts"),
             "COMPRAS": S.TableSpec("COMPRAS", required=("event_id", "props"), window_column="ts"),
             "NACIONES": S.TableSpec("NACIONES", required=("n_name",))}
    sources = {"CLICKS": events.filter("event_type = 'click'"), "COMPRAS": events.filter("event_type = 'purchase'"),
               "NACIONES": DV.table(spark, sf_dir, "nation")}
    root, start, end = scratch_path(spark, "periodo"), "2024-01-10", "2024-01-15"
    result = run_period(spark, sources.__getitem__, specs, start, end, root)
    if not result.get("carga"):
        raise RuntimeError(f"period run stopped: {summary_json(result)}")
    return spark.read.json(f"{root}/salida/periodo={start}_{end}/manifiesto")

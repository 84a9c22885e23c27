"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Each reads whole driver tables (or inputs Spark derives from them); the matching
DuckDB statement lives in :mod:`tableflow.plans.oracle_queries`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow import spec as S
from tableflow.functions import rules as R
from tableflow.operators import records as REC
from tableflow.plans import derived as DV
from tableflow.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# the columns the orders-derived bulk file carries, in bulk spec order
ORDERS_BULK_COLUMNS = [c for c in S.BULK_COLUMNS if c in (
    "idpersona", "codigohecho", "fechaocurrencia", "fechareporte", "coddanemunicipioocurrencia",
    "discapacidad", "hecho", "primernombre", "tipodocumento", "origen", "direccion")]


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def _as_output(df: DataFrame) -> DataFrame:
    """Exact integers of 38 digits are reported as bigint (null beyond it)."""
    return df.select(*[F.col(f.name).try_cast("bigint").alias(f.name) if f.dataType.simpleString() == "decimal(38,0)"
                       else F.col(f.name) for f in df.schema.fields])


# --- scalar rules on the orders-derived bulk file ---------------------------

@query("clean_date")
def q_clean_date(spark, sf):
    d = DV.dirty_orders(spark, sf).select("row_no", F.col("fechaocurrencia").alias("raw"), "fechaocurrencia",
                                          "fechareporte")
    return REC.clean_dates(d, {"fecha": "fechaocurrencia", "fecha_reporte": "fechareporte"}).select(
        "row_no", "raw", "fecha", "fecha_reporte")


@query("clean_int")
def q_clean_int(spark, sf):
    d = DV.dirty_orders(spark, sf)
    return d.select("row_no", F.col("idpersona").alias("raw"),
                    R.clean_int("idpersona").try_cast("bigint").alias("entero"),
                    R.clean_int("codigohecho").try_cast("bigint").alias("codigo"),
                    R.clean_int("discapacidad").try_cast("bigint").alias("monto"))


@query("clean_code")
def q_clean_code(spark, sf):
    d = DV.dirty_orders(spark, sf)
    return d.select("row_no", F.col("coddanemunicipioocurrencia").alias("raw"),
                    R.clean_code("coddanemunicipioocurrencia").try_cast("bigint").alias("codigo"))


@query("clean_text")
def q_clean_text(spark, sf):
    d = DV.dirty_orders(spark, sf)
    return d.select("row_no", R.clean_text("hecho").alias("hecho"), R.clean_text("primernombre").alias("nombre"),
                    R.clean_text("tipodocumento").alias("tipo"))


@query("clean_record")
def q_clean_record(spark, sf):
    d = DV.dirty_orders(spark, sf)
    out = REC.clean_record(d, S.BULK_SPEC, keep=["row_no"])
    return _as_output(out.select("row_no", *ORDERS_BULK_COLUMNS))


@query("clean_record_by_name")
def q_clean_record_by_name(spark, sf):
    d = DV.dirty_orders(spark, sf)
    return REC.clean_record_by_name(d, ORDERS_BULK_COLUMNS, keep=["row_no"])


@query("project_spec")
def q_project_spec(spark, sf):
    d = DV.dirty_orders(spark, sf)
    return REC.project_spec(d, S.BULK_SPEC, keep=["row_no"])


@query("drop_columns")
def q_drop_columns(spark, sf):
    return REC.drop_columns(DV.dirty_orders(spark, sf), ["direccion", "origen", "not_there"])


@query("header_normalise")
def q_header_normalise(spark, sf):
    return REC.normalise_headers(DV.raw_header_orders(spark, sf))


@query("copy_text_lines")
def q_copy_text_lines(spark, sf):
    d = REC.clean_record(DV.dirty_orders(spark, sf), S.BULK_SPEC, keep=["row_no"])
    return REC.copy_text_lines(d, ORDERS_BULK_COLUMNS, keep=["row_no"])


@query("null_tokens")
def q_null_tokens(spark, sf):
    return REC.null_tokens(DV.customer_text(spark, sf), keep=["row_no"])


@query("value_kind")
def q_value_kind(spark, sf):
    t = DV.customer_text(spark, sf)
    cols = [c for c in t.columns if c != "row_no"]
    return t.select("row_no", *[F.when(R.null_token(c).isNotNull(), R.value_kind(R.null_token(c))).alias(c)
                                for c in cols])


from tableflow.operators import date_formats as DFM  # noqa: E402


@query("strip_columns")
def q_strip_columns(spark, sf):
    return REC.strip_columns(DV.patients(spark, sf))


@query("coerce_date")
def q_coerce_date(spark, sf):
    p = REC.strip_columns(DV.patients(spark, sf))
    return p.select("PACIENTE_ID", "CREATED_AT",
                    R.coerce_timestamp(F.col("CREATED_AT")).alias("created_ts"),
                    R.coerce_timestamp(F.col("FECHA_NACIMIENTO")).alias("birth_ts"))


@query("elected_dates")
def q_elected_dates(spark, sf):
    """Order dates written in three undeclared layouts, one of them mixed with another in a third of the rows."""
    o, key = DV.table(spark, sf, "orders", spread=True), F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    texts = o.select("o_orderkey", F.date_format(day, "dd/MM/yyyy").alias("latina"), F.date_format(day, "MM-dd-yyyy").alias("inglesa"),
                     F.when(key % 3 == 0, F.date_format(day, "dd.MM.yyyy")).otherwise(F.date_format(day, "yyyyMMdd")).alias("mezclada"))
    return DFM.coerce_elected(texts, ["latina", "inglesa", "mezclada"])


# --- quarantine (period table shaped like PACIENTES) ---------------------------

from tableflow.operators import profiling as PRF  # noqa: E402
from tableflow.operators import quarantine as Q  # noqa: E402

PATIENTS_SPEC = S.PERIOD_SPECS["PACIENTES"]
# both below the rows of the smallest checked table, so that they cut
SAMPLE_ROWS = 5_000
ROW_CAP = 10_000


@query("dedupe_rows")
def q_dedupe_rows(spark, sf):
    return Q.dedupe_rows(DV.patients(spark, sf))


@query("duplicate_rejects")
def q_duplicate_rejects(spark, sf):
    return Q.split_duplicates(DV.patients(spark, sf))[1]


@query("required_clean")
def q_required_clean(spark, sf):
    return Q.split_required(REC.strip_columns(DV.patients(spark, sf)), PATIENTS_SPEC.required)[0]


@query("required_rejects")
def q_required_rejects(spark, sf):
    return Q.split_required(REC.strip_columns(DV.patients(spark, sf)), PATIENTS_SPEC.required)[1]


@query("date_problems")
def q_date_problems(spark, sf):
    return Q.date_problems(REC.strip_columns(DV.patients(spark, sf)), PATIENTS_SPEC.date_columns)


@query("clean_table")
def q_clean_table(spark, sf):
    return Q.clean_table(DV.patients(spark, sf), PATIENTS_SPEC).clean


@query("clean_table_problems")
def q_clean_table_problems(spark, sf):
    return Q.clean_table(DV.patients(spark, sf), PATIENTS_SPEC).problems


@query("problem_counts")
def q_problem_counts(spark, sf):
    return Q.count_problems(Q.tag_table(DV.patients(spark, sf), PATIENTS_SPEC), PATIENTS_SPEC)


# --- profiling and inspection -------------------------------------------------

def _profiles(spark, sf):
    return (PRF.profile_table(DV.customer_floats(spark, sf), "CUSTOMER")
            .unionByName(PRF.profile_table(DV.patients(spark, sf), "PACIENTES")))


@query("profile_table")
def q_profile_table(spark, sf):
    return _profiles(spark, sf)


@query("quality_summary")
def q_quality_summary(spark, sf):
    return PRF.quality_summary(_profiles(spark, sf))


@query("inspect_columns")
def q_inspect_columns(spark, sf):
    return PRF.inspect_columns(DV.customer_text(spark, sf), ordinal="row_no")


@query("critical_columns")
def q_critical_columns(spark, sf):
    return PRF.critical_columns(PRF.inspect_columns(DV.customer_text(spark, sf), ordinal="row_no"))


@query("head_tail")
def q_head_tail(spark, sf):
    return _as_output(PRF.head_tail(DV.customer_text(spark, sf), "row_no"))


@query("sample_first_n")
def q_sample_first_n(spark, sf):
    return PRF.first_n(DV.dirty_orders(spark, sf), SAMPLE_ROWS, "row_no")


@query("row_cap")
def q_row_cap(spark, sf):
    return PRF.row_cap(DV.dirty_orders(spark, sf), ROW_CAP, "row_no")[0]


@query("first_n_narrowed")
def q_first_n_narrowed(spark, sf):
    """The first rows of an order with values far from all others, which equal buckets would not cut."""
    far = F.when(F.col("row_no") % 1000 == 1, F.col("row_no") * F.lit(10 ** 9)).otherwise(F.col("row_no"))
    placed = DV.dirty_orders(spark, sf).select(far.alias("orden"), "row_no", "hecho")
    return PRF.first_n(placed, SAMPLE_ROWS, "orden", narrow=True)


@query("row_cap_report")
def q_row_cap_report(spark, sf):
    return PRF.row_cap(DV.dirty_orders(spark, sf), ROW_CAP, "row_no")[1]


# --- sources ------------------------------------------------------------------

from tableflow.operators import delivery as DLV  # noqa: E402
from tableflow.operators import ingest as ING  # noqa: E402
from tableflow.operators import ledger as LED  # noqa: E402
from tableflow.session import scratch_path  # noqa: E402
from tableflow.sources import database as DB  # noqa: E402
from tableflow.sources import key_ranges as KR  # noqa: E402
from tableflow.sources import delimited as DL  # noqa: E402
from tableflow.sources import file_records as FR  # noqa: E402
from tableflow.sources import period as PER  # noqa: E402

WINDOW_START, WINDOW_END = "2024-01-10", "2024-01-15"
LOAD_TIME = "2024-02-01 00:00:00"
PENDING_START = "2024-01-30"
EVENT_PAGE = 1_000
LOSSY_TABLE = "CLICK"


def _events_window(spark, sf):
    e = DV.table(spark, sf, "events")
    return DB.extract_window(e, "ts", WINDOW_START, WINDOW_END).withColumn("tabla", F.upper("event_type"))


@query("extract_window")
def q_extract_window(spark, sf):
    return DB.extract_window(DV.table(spark, sf, "events"), "ts", WINDOW_START, WINDOW_END)


@query("count_window")
def q_count_window(spark, sf):
    e = DV.table(spark, sf, "events").withColumn("tabla", F.upper("event_type"))
    return DB.count_window(e, "ts", WINDOW_START, WINDOW_END, by=["tabla"])


@query("extract_catalogue_table")
def q_extract_catalogue_table(spark, sf):
    return DB.extract_window(DV.table(spark, sf, "nation"), None, WINDOW_START, WINDOW_END)


@query("page_slice")
def q_page_slice(spark, sf):
    return DB.page_slice(DV.table(spark, sf, "orders"), "o_orderkey", 1, S.EXTRACT_PAGE_ROWS)


@query("extract_key_ranges")
def q_extract_key_ranges(spark, sf):
    """Every line with the number of ranges that read it; eleven discounts are dealt into 16 even ranges and classes."""
    lines, row_class = DV.table(spark, sf, "lineitem"), "pmod(xxhash64(l_orderkey, l_linenumber), {n})"
    ranges = KR.range_predicates("l_discount", KR.frame_parts(lines, "l_discount", 16), 16, row_class)
    taken = sum((F.coalesce(F.expr(p).cast("int"), F.lit(0)) for p in ranges), F.lit(0))
    return lines.withColumn("lecturas", taken).filter("lecturas > 0")


@query("union_pages")
def q_union_pages(spark, sf):
    w = DB.extract_window(DV.table(spark, sf, "events"), "ts", WINDOW_START, WINDOW_END)
    return DB.union_pages(w, DB.range_predicates("event_id", 0, 8 * EVENT_PAGE, 8))   # the last page is open


def _written_extracts(spark, sf, rows=None):
    """The window of every event table, delivered in one write and read back with its table's name."""
    root = scratch_path(spark, "datos")
    rows = _events_window(spark, sf) if rows is None else rows
    DL.write_csv_by_table(rows, root, "tabla")
    return root, DL.read_csv_by_table(spark, root, rows.drop("tabla").schema, "tabla")


def _lossy_events(spark, sf):
    """The window with some properties lost, and every 50th row of one table missing."""
    w = _events_window(spark, sf)
    lost = (F.col("tabla") == LOSSY_TABLE) & (F.col("event_id") % 50 == 0)
    return w.filter(~lost).withColumn("props", F.when(F.col("value") >= 5, F.col("props")))


@query("period_files")
def q_period_files(spark, sf):
    """One file folder per table and period, found again by name."""
    root = scratch_path(spark, "periodo")
    PER.write_period_tables(_events_window(spark, sf), root, "tabla", WINDOW_START, WINDOW_END)
    return PER.read_period_files(spark, root, WINDOW_START, WINDOW_END, schema=DV.table(spark, sf, "events").schema)


@query("reconcile_counts")
def q_reconcile_counts(spark, sf):
    e = DV.table(spark, sf, "events").withColumn("tabla", F.upper("event_type"))
    source = DB.count_window(e, "ts", WINDOW_START, WINDOW_END, by=["tabla"])
    _, back = _written_extracts(spark, sf, _lossy_events(spark, sf))
    extracted = back.groupBy("tabla").agg(F.count(F.lit(1)).alias("filas"))
    return LED.reconcile_counts(source, extracted)


@query("scan_delimited")
def q_scan_delimited(spark, sf):
    path = scratch_path(spark, "bulk")
    DL.write_delimited(DV.dirty_orders(spark, sf), path)
    return FR.read_records(spark, path).withColumn("row_no", F.col("row_no").cast("bigint"))


@query("row_numbers")
def q_row_numbers(spark, sf):
    """Every record with its number over the files, counted as a reader that goes through them in order."""
    path = scratch_path(spark, "numbered")
    DL.write_delimited(DV.dirty_orders(spark, sf).repartitionByRange("row_no").sortWithinPartitions("row_no"), path)
    return FR.read_records(spark, path, number="numero").select("numero", F.col("row_no").cast("bigint").alias("row_no"), "hecho")


@query("csv_infer")
def q_csv_infer(spark, sf):
    path = scratch_path(spark, "csv")
    DL.write_csv(DV.customer_tokens(spark, sf), path)
    return DL.read_csv_inferred(spark, path)


@query("split_records")
def q_split_records(spark, sf):
    """Files with quoted line breaks, landed once as other files of whole records."""
    few, parts = scratch_path(spark, "few_files"), scratch_path(spark, "parts")
    DL.write_delimited(DV.dirty_orders(spark, sf), few)
    DL.split_records(spark, few, parts, files=16)
    back = DL.read_delimited(spark, parts, multi_line=True).drop(DL.LINE)
    return back.withColumn("row_no", F.col("row_no").cast("bigint"))


@query("inspect_file_columns")
def q_inspect_file_columns(spark, sf):
    """The inspector on the delimited file itself, whose fields hold line breaks."""
    path = scratch_path(spark, "inspect")
    DL.write_delimited(DV.dirty_orders(spark, sf), path)
    return PRF.inspect_file(spark, path, ignored=("row_no",))["columnas"]


@query("csv_roundtrip")
def q_csv_roundtrip(spark, sf):
    clean = Q.clean_table(DV.patients(spark, sf), PATIENTS_SPEC).clean
    path = scratch_path(spark, "clean")
    DL.write_csv(clean, path)
    return DL.read_csv(spark, path, clean.schema)


# --- ingestion ------------------------------------------------------------------

def _lineitem_load(spark, sf):
    inc = DV.lineitem_incoming(spark, sf)
    target = ING.first_per_key(inc.filter(F.col("l_shipdate") < F.lit(DV.LOADED_BEFORE).cast("timestamp_ntz")),
                               DV.LINEITEM_KEY, DV.LINEITEM_ORDER)
    return target, ING.insert_ignore(target, inc, DV.LINEITEM_KEY, DV.LINEITEM_ORDER)


@query("insert_ignore")
def q_insert_ignore(spark, sf):
    target, new = _lineitem_load(spark, sf)
    return target.unionByName(new)


@query("load_default")
def q_load_default(spark, sf):
    return ING.with_load_time(_lineitem_load(spark, sf)[1], "cargado_en", LOAD_TIME)


@query("target_accepts")
def q_target_accepts(spark, sf):
    return ING.prepare_load(DV.dirty_orders(spark, sf), S.BULK_SPEC, "row_no")[0].select(
        "row_no", *ORDERS_BULK_COLUMNS)


@query("target_rejects")
def q_target_rejects(spark, sf):
    bad = ING.prepare_load(DV.dirty_orders(spark, sf), S.BULK_SPEC, "row_no")[1]
    return _as_output(bad.select("row_no", *ORDERS_BULK_COLUMNS, Q.PROBLEM))


def _bulk_load(spark, sf):
    src = scratch_path(spark, "bulk_src")
    DL.write_delimited(DV.dirty_orders(spark, sf), src)
    raw = FR.read_records(spark, src).withColumn("row_no", F.col("row_no").cast("bigint"))
    target = scratch_path(spark, "target")
    ING.create_target(spark, S.BULK_SPEC, path=target)
    report = ING.bulk_load(spark, raw, S.BULK_SPEC, target, "row_no", staging_path=scratch_path(spark, "staging"),
                           load_time=LOAD_TIME)
    return target, report


@query("bulk_load")
def q_bulk_load(spark, sf):
    target, _ = _bulk_load(spark, sf)
    return spark.read.parquet(target)


@query("load_summary")
def q_load_summary(spark, sf):
    _, report = _bulk_load(spark, sf)
    return spark.createDataFrame([report.as_row()],
                                 "filas_procesadas long, enviadas long, insertadas long, conflictos long, "
                                 "rechazadas long, total_en_destino long")


# --- ledger -------------------------------------------------------------------------

@query("ledger_latest_ok")
def q_ledger_latest_ok(spark, sf):
    return LED.latest_ok(DV.event_ledger(spark, sf))


@query("pending_extractions")
def q_pending_extractions(spark, sf):
    return LED.pending_extractions(DV.event_tables(spark, sf), DV.event_ledger(spark, sf), PENDING_START,
                                   match="start")


@query("detect_keys")
def q_detect_keys(spark, sf):
    return LED.detect_keys(*DV.key_catalogue(spark, sf))


@query("best_run")
def q_best_run(spark, sf):
    return LED.best_runs(DV.run_results(spark, sf))


# --- delivery -----------------------------------------------------------------------

@query("delivery_name")
def q_delivery_name(spark, sf):
    n = DV.table(spark, sf, "nation")
    return n.select("n_nationkey", DLV.delivery_name(F.col("n_name"), WINDOW_START, WINDOW_END).alias("archivo"))


@query("content_digest")
def q_content_digest(spark, sf):
    w = _events_window(spark, sf)
    return DLV.content_digest(w, by=["tabla"], columns=[c for c in w.columns if c != "tabla"])


@query("manifest")
def q_manifest(spark, sf):
    """Delivered rows read back from their files, against the source's counts."""
    e = DV.table(spark, sf, "events").withColumn("tabla", F.upper("event_type"))
    source = DB.count_window(e, "ts", WINDOW_START, WINDOW_END, by=["tabla"]).withColumnRenamed("filas", "filas_oracle")
    root, back = _written_extracts(spark, sf, _lossy_events(spark, sf))
    cols = [c for c in back.columns if c != "tabla"]
    digest = DLV.content_digest(back, by=["tabla"], columns=cols)
    counts = source.join(digest.select("tabla", F.col("filas").alias("filas_csv")), "tabla", "left")
    summary = PRF.quality_summary(PRF.profile_tables(back, "tabla"))
    parts = DLV.parts_by_table(DLV.part_file_md5(spark, f"{root}/tabla=*"))
    m = DLV.manifest(counts, digest, summary, WINDOW_START, WINDOW_END, parts=parts)
    return m.select("tabla", "periodo_inicio", "periodo_fin", "archivo", "filas_oracle", "filas_csv", "digest",
                    F.forall("partes", lambda p: (F.length(p["md5"]) == 32) & (p["bytes"] > 0)).alias("partes_con_md5"),
                    F.col("problemas_calidad.total_filas").alias("calidad_total_filas"),
                    F.col("problemas_calidad.columnas_con_nulos").alias("calidad_columnas_con_nulos"),
                    F.col("problemas_calidad.max_pct_nulos").alias("calidad_max_pct_nulos"), "generado_por")


# --- streaming ----------------------------------------------------------------------

from tableflow.streaming import resumable as ST  # noqa: E402

STREAM_FILES_PER_COPY = 4
STREAM_FILES_PER_TRIGGER = 2
#: a stream reads a file by one task, so more rows land as more files, and a batch takes the same share of them
STREAM_FILE_ROWS = 100_000


def _landing(spark, sf, name):
    """Files that a copy of the table lands as, and files of a batch; rows are counted from the table's footers."""
    rows = DV.table(spark, sf, name).count()
    times = max(1, -(-rows // (STREAM_FILES_PER_COPY * STREAM_FILE_ROWS)))
    return STREAM_FILES_PER_COPY * times, STREAM_FILES_PER_TRIGGER * times


def _land_events(spark, sf, src, copies=1):
    """Land ``events`` as files in the stream's source folder (each copy as separate files)."""
    e, files = DV.table(spark, sf, "events"), _landing(spark, sf, "events")[0]
    for _ in range(copies):
        e.repartition(files).write.mode("append").parquet(src)
    return e.schema


def _event_stream(spark, sf, copies=2):
    src = scratch_path(spark, "stream_src")
    schema = _land_events(spark, sf, src, copies)
    cfg = ST.StreamIngest(source=src, schema=schema, target=scratch_path(spark, "stream_target"),
                          checkpoint=scratch_path(spark, "stream_ckpt"), key=("event_id",), order=("ts",),
                          max_files_per_trigger=_landing(spark, sf, "events")[1], metrics=scratch_path(spark, "stream_metrics"))
    ST.run_until_caught_up(spark, cfg)
    return cfg


@query("stream_insert_ignore")
def q_stream_insert_ignore(spark, sf):
    return ST.read_target(spark, _event_stream(spark, sf))


def _metric_totals(metrics):
    return metrics.agg(F.count(F.lit(1)).alias("lotes"), F.sum("filas_leidas").alias("filas_leidas"),
                       F.sum("insertadas").alias("insertadas"), F.sum("conflictos").alias("conflictos"))


@query("stream_batches")
def q_stream_batches(spark, sf):
    cfg = _event_stream(spark, sf)
    return _metric_totals(spark.read.parquet(cfg.metrics))


@query("batch_progress")
def q_batch_progress(spark, sf):
    """Four landings, one after another: batch i holds the events of class i and some that batch i - 1 brought."""
    e = DV.table(spark, sf, "events")
    src, files = scratch_path(spark, "stream_src"), _landing(spark, sf, "events")[0]
    cfg = ST.StreamIngest(source=src, schema=e.schema, target=scratch_path(spark, "stream_target"),
                          checkpoint=scratch_path(spark, "stream_ckpt"), key=("event_id",), order=("ts",),
                          max_files_per_trigger=files, metrics=scratch_path(spark, "stream_metrics"))
    k = F.col("event_id")
    for i in range(4):
        again = (k % 4 == i - 1) & (k % 10 == 0)
        e.filter((k % 4 == i) | again).repartition(files).write.mode("append").parquet(src)
        ST.run_until_caught_up(spark, cfg)
    return ST.batch_progress(spark.read.parquet(cfg.metrics))


def _order_stream(spark, sf, src):
    """A stream of the delimited file, whose fields hold line breaks, and its rows as they land."""
    d, (files, per_trigger) = DV.dirty_orders(spark, sf), _landing(spark, sf, "orders")
    text = T.StructType([T.StructField(c, T.StringType()) for c in d.columns])
    numbered = lambda b: b.withColumn("row_no", F.col("row_no").cast("bigint"))
    return d.repartition(files), ST.StreamIngest(
        source=src, schema=text, target=scratch_path(spark, "stream_target"), checkpoint=scratch_path(spark, "stream_ckpt"),
        key=S.BULK_SPEC.key, order=("row_no",), source_format="csv", options=ST.delimited_options(),
        max_files_per_trigger=per_trigger, metrics=scratch_path(spark, "stream_metrics"),
        rejects=scratch_path(spark, "stream_rej"), prepare=lambda b: ING.tag_load(numbered(b), S.BULK_SPEC, "row_no"),
        conform=lambda a: ING.conform(a, S.BULK_SPEC, "row_no"), load_time_column=S.BULK_LOAD_TIME)


@query("stream_resume")
def q_stream_resume(spark, sf):
    """The delimited file loaded by a stream that is restarted when the same file arrives again."""
    src = scratch_path(spark, "stream_src")
    d, cfg = _order_stream(spark, sf, src)
    with ST.settings(spark):     # the dirty columns too make a method too long to be compiled
        DL.write_delimited(d, src, mode="append")
    ST.run_until_caught_up(spark, cfg)
    first_run_last = spark.read.parquet(cfg.metrics).agg(F.max(ST.BATCH)).first()[0]
    with ST.settings(spark):
        DL.write_delimited(d, src, mode="append")  # the restart reads only these
    ST.run_until_caught_up(spark, cfg)
    m = spark.read.parquet(cfg.metrics)
    runs = F.when(F.col(ST.BATCH) <= first_run_last, F.lit(1)).otherwise(F.lit(2))
    return (m.withColumn("run", runs).groupBy("run")
             .agg(F.sum("filas_leidas").alias("filas_leidas"), F.sum("insertadas").alias("insertadas"),
                  F.sum("rechazadas").alias("rechazadas")))


@query("stream_rejects")
def q_stream_rejects(spark, sf):
    src = scratch_path(spark, "stream_orders")
    d, cfg = _order_stream(spark, sf, src)
    with ST.settings(spark):
        DL.write_delimited(d, src)
    ST.run_until_caught_up(spark, cfg)
    rej = spark.read.parquet(cfg.rejects)
    return _as_output(rej.select("row_no", *ORDERS_BULK_COLUMNS, Q.PROBLEM))


# --- SQL surface ----------------------------------------------------------------------

from tableflow.functions import sql as FSQL  # noqa: E402


@query("sql_functions")
def q_sql_functions(spark, sf):
    FSQL.register(spark)
    DV.dirty_orders(spark, sf).createOrReplaceTempView("tf_dirty_orders")
    return spark.sql("""SELECT row_no, clean_date(fechaocurrencia) AS fecha,
        try_cast(clean_int(idpersona) AS BIGINT) AS entero, try_cast(clean_code(coddanemunicipioocurrencia) AS BIGINT) AS codigo,
        clean_text(hecho) AS hecho, value_kind(lower(strip_text(primernombre))) AS kind FROM tf_dirty_orders""")


@query("line_count")
def q_line_count(spark, sf):
    """Physical lines of the delimited file (records whose fields hold line breaks count more)."""
    path = scratch_path(spark, "lines")
    DL.write_delimited(DV.dirty_orders(spark, sf), path)
    return DL.line_count(spark, path)

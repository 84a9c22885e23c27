"""DuckDB statements matching :mod:`tableflow.plans.registry`, one per query name."""

from __future__ import annotations

from tableflow import spec as S
from tableflow.plans import oracle as O
from tableflow.plans.registry import ORDERS_BULK_COLUMNS

SQL: dict[str, str] = {}

_DO = O.with_(O.DIRTY_ORDERS)


def _bulk_clean(c: str) -> str:
    r = S.BULK_SPEC.rule(c)
    if r.kind == S.DATE:
        return O.clean_date(c)
    if r.kind == S.DATE_TEXT:
        return O.clean_date_text(c)
    if r.kind == S.CODE:
        return f"TRY_CAST({O.clean_code(c)} AS BIGINT)"
    if r.kind == S.INT:
        return f"TRY_CAST({O.clean_int(c)} AS BIGINT)"
    return O.clean_text(c)


SQL["clean_date"] = _DO + f"""SELECT row_no, fechaocurrencia AS raw, {O.clean_date('fechaocurrencia')} AS fecha,
  {O.clean_date('fechareporte')} AS fecha_reporte FROM dirty_orders"""

SQL["clean_int"] = _DO + f"""SELECT row_no, idpersona AS raw,
  TRY_CAST({O.clean_int('idpersona')} AS BIGINT) AS entero,
  CAST({O.clean_int('codigohecho')} AS BIGINT) AS codigo,
  CAST({O.clean_int('discapacidad')} AS BIGINT) AS monto FROM dirty_orders"""

SQL["clean_code"] = _DO + f"""SELECT row_no, coddanemunicipioocurrencia AS raw,
  CAST({O.clean_code('coddanemunicipioocurrencia')} AS BIGINT) AS codigo FROM dirty_orders"""

SQL["clean_text"] = _DO + f"""SELECT row_no, {O.clean_text('hecho')} AS hecho, {O.clean_text('primernombre')} AS nombre,
  {O.clean_text('tipodocumento')} AS tipo FROM dirty_orders"""

SQL["clean_record"] = _DO + "SELECT row_no, " + ", ".join(
    f"{_bulk_clean(c)} AS {c}" for c in ORDERS_BULK_COLUMNS) + " FROM dirty_orders"


def _by_name(c: str) -> str:
    if "fecha" in c:
        return O.clean_date_text(c)
    if "coddane" in c:
        return f"(CASE WHEN {O.strip(c)} = '0' THEN NULL ELSE {O.clean_text(c)} END)"
    return O.clean_text(c)


SQL["clean_record_by_name"] = _DO + "SELECT row_no, " + ", ".join(
    f"{_by_name(c)} AS {c}" for c in ORDERS_BULK_COLUMNS) + " FROM dirty_orders"

SQL["project_spec"] = _DO + "SELECT row_no, " + ", ".join(
    (c if c in ORDERS_BULK_COLUMNS else f"CAST(NULL AS VARCHAR) AS {c}") for c in S.BULK_COLUMNS) + " FROM dirty_orders"

SQL["drop_columns"] = _DO + "SELECT * EXCLUDE (direccion, origen) FROM dirty_orders"

SQL["header_normalise"] = _DO + "SELECT * FROM dirty_orders"

_CT = O.with_(O.CUSTOMER_TEXT)
_CT_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]

SQL["null_tokens"] = _CT + "SELECT row_no, " + ", ".join(
    f"{O.null_token(c)} AS {c}" for c in _CT_COLS) + " FROM customer_text"

SQL["value_kind"] = _CT + "SELECT row_no, " + ", ".join(
    f"(CASE WHEN {O.null_token(c)} IS NOT NULL THEN {O.value_kind(O.null_token(c))} END) AS {c}"
    for c in _CT_COLS) + " FROM customer_text"

_PT = O.with_(O.PATIENTS)
_PT_TEXT = ["NOMBRE", "FECHA_NACIMIENTO", "CREATED_AT", "SEGMENTO"]


def _patients_stripped() -> str:
    return ("patients_s AS (SELECT PACIENTE_ID, " + ", ".join(f"{O.strip(c)} AS {c}" for c in _PT_TEXT)
            + ", MUNICIPIO_ID FROM patients)")


SQL["strip_columns"] = _PT + "SELECT PACIENTE_ID, " + ", ".join(
    f"{O.strip(c)} AS {c}" for c in _PT_TEXT) + ", MUNICIPIO_ID FROM patients"

SQL["elected_dates"] = """WITH d AS (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS dia FROM orders)
  SELECT o_orderkey, dia AS latina, dia AS inglesa, CASE WHEN o_orderkey % 3 <> 0 THEN dia END AS mezclada FROM d"""
SQL["coerce_date"] = O.with_(O.PATIENTS, _patients_stripped()) + f"""SELECT PACIENTE_ID, CREATED_AT,
  {O.coerce_timestamp('CREATED_AT')} AS created_ts, {O.coerce_timestamp('FECHA_NACIMIENTO')} AS birth_ts
  FROM patients_s"""


# --- quarantine -------------------------------------------------------------

_PCOLS = ["PACIENTE_ID", "NOMBRE", "FECHA_NACIMIENTO", "CREATED_AT", "SEGMENTO", "MUNICIPIO_ID"]
_PC = ", ".join(_PCOLS)
_REQ = ["PACIENTE_ID", "NOMBRE", "FECHA_NACIMIENTO"]
_DATES = ["FECHA_NACIMIENTO", "CREATED_AT"]
_REQ_TAG = "COALESCE(" + ", ".join(
    f"CASE WHEN {c} IS NULL THEN '{c}: valor requerido nulo' END" for c in _REQ) + ")"

SQL["dedupe_rows"] = _PT + "SELECT DISTINCT * FROM patients"

SQL["duplicate_rejects"] = _PT + f"""SELECT {_PC} FROM (
  SELECT {_PC}, unnest(range(n - 1)) AS i FROM (SELECT {_PC}, count(*) AS n FROM patients GROUP BY ALL))"""

_PS = O.with_(O.PATIENTS, _patients_stripped())

SQL["required_clean"] = _PS + f"SELECT {_PC} FROM patients_s WHERE {_REQ_TAG} IS NULL"
SQL["required_rejects"] = _PS + f"SELECT {_PC}, {_REQ_TAG} AS _problema FROM patients_s WHERE {_REQ_TAG} IS NOT NULL"

SQL["date_problems"] = _PS + " UNION ALL ".join(
    f"SELECT {_PC}, '{c}: fecha inválida' AS _problema FROM patients_s "
    f"WHERE {c} IS NOT NULL AND {O.coerce_timestamp(c)} IS NULL" for c in _DATES)

_CLEAN_BASE = O.with_(
    O.PATIENTS, _patients_stripped(),
    f"g AS (SELECT {_PC}, count(*) AS n FROM patients_s GROUP BY ALL)",
    f"req AS (SELECT {_PC}, n, {_REQ_TAG} AS tag FROM g)",
    f"""problems AS (
  SELECT {_PC}, 'fila duplicada' AS _problema FROM (SELECT {_PC}, unnest(range(n - 1)) AS i FROM g)
  UNION ALL SELECT {_PC}, tag AS _problema FROM req WHERE tag IS NOT NULL
  UNION ALL """ + " UNION ALL ".join(
        f"SELECT {_PC}, '{c}: fecha inválida' AS _problema FROM req "
        f"WHERE tag IS NULL AND {c} IS NOT NULL AND {O.coerce_timestamp(c)} IS NULL" for c in _DATES) + ")")

SQL["clean_table"] = _CLEAN_BASE + (
    "SELECT PACIENTE_ID, NOMBRE, " + ", ".join(f"{O.coerce_timestamp(c)} AS {c}" for c in _DATES)
    + ", SEGMENTO, MUNICIPIO_ID FROM req WHERE tag IS NULL")
SQL["clean_table_problems"] = _CLEAN_BASE + f"SELECT {_PC}, _problema FROM problems"
SQL["problem_counts"] = _CLEAN_BASE + "SELECT _problema, count(*) AS filas FROM problems GROUP BY _problema"

# --- profiling --------------------------------------------------------------

_CH_TYPES = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
             ("c_mktsegment", "string")]
_PT_TYPES = [("PACIENTE_ID", "bigint"), ("NOMBRE", "string"), ("FECHA_NACIMIENTO", "string"),
             ("CREATED_AT", "string"), ("SEGMENTO", "string"), ("MUNICIPIO_ID", "int")]


def _profile_sql(view: str, name: str, cols) -> str:
    arms = []
    for i, (c, t) in enumerate(cols):
        nulos = f"(count(*) - count({c}))"
        arms.append(
            f"SELECT '{name}' AS tabla, '{c}' AS columna, {i} AS posicion, '{t}' AS tipo, "
            f"count(*) AS total_filas, CAST({len(cols)} AS BIGINT) AS total_cols, {nulos} AS nulos, "
            f"count(*) - count(DISTINCT {c}) - CASE WHEN {nulos} > 0 THEN 1 ELSE 0 END AS duplicados, "
            f"count(DISTINCT {c}) AS unicos, {O.percent(nulos, 'count(*)')} AS pct_nulos FROM {view}")
    return " UNION ALL ".join(arms)


_PROFILES = O.with_(O.CUSTOMER_FLOATS, O.PATIENTS, f"""profiles AS (
  {_profile_sql('customer_floats', 'CUSTOMER', _CH_TYPES)}
  UNION ALL {_profile_sql('patients', 'PACIENTES', _PT_TYPES)})""")

SQL["profile_table"] = _PROFILES + "SELECT * FROM profiles"
SQL["quality_summary"] = _PROFILES + """SELECT tabla, max(total_filas) AS total_filas,
  count(CASE WHEN nulos > 0 THEN 1 END) AS columnas_con_nulos, COALESCE(max(pct_nulos), 0.0) AS max_pct_nulos
  FROM profiles GROUP BY tabla"""


def _inspect_sql(columns=tuple(_CT_COLS)) -> str:
    arms = []
    for i, c in enumerate(columns):
        v = O.null_token(c)
        rank = (f"max(CASE WHEN {v} IS NULL THEN NULL WHEN {O.value_kind(v)} = 'int' THEN 1 "
                f"WHEN {O.value_kind(v)} = 'float' THEN 2 ELSE 3 END)")
        nulos = f"sum(CASE WHEN {v} IS NULL THEN 1 ELSE 0 END)"
        arms.append(
            f"SELECT '{c}' AS columna, {i} AS posicion, CASE {rank} WHEN 1 THEN 'int' WHEN 2 THEN 'float' "
            f"ELSE 'str' END AS tipo_inferido, {O.percent(nulos, 'count(*)')} AS porcentaje_nulos, "
            f"count(*) AS filas_analizadas FROM sample")
    return " UNION ALL ".join(arms)


_INSPECT = O.with_(O.CUSTOMER_TEXT, "sample AS (SELECT * FROM customer_text)",
                   f"inspection AS ({_inspect_sql()})")
SQL["inspect_columns"] = _INSPECT + "SELECT * FROM inspection"
SQL["critical_columns"] = _INSPECT + "SELECT * FROM inspection WHERE porcentaje_nulos > 30 ORDER BY porcentaje_nulos DESC"

_HT_COLS = ", ".join([f"{O.null_token(c)} AS {c}" for c in _CT_COLS] + [
    f"(CASE WHEN {O.null_token(c)} IS NOT NULL THEN {O.value_kind(O.null_token(c))} END) AS {c}_kind"
    for c in _CT_COLS] + [
    f"(CASE WHEN {O.value_kind(O.null_token(c))} = 'int' THEN TRY_CAST({O.null_token(c)} AS BIGINT) END) AS {c}_int"
    for c in _CT_COLS] + [
    f"(CASE WHEN {O.value_kind(O.null_token(c))} = 'float' THEN TRY_CAST({O.null_token(c)} AS DOUBLE) END) AS {c}_float"
    for c in _CT_COLS])
SQL["head_tail"] = _INSPECT + f"""(SELECT row_no, {_HT_COLS}, 'head' AS lado FROM sample ORDER BY row_no LIMIT 5)
  UNION ALL (SELECT row_no, {_HT_COLS}, 'tail' AS lado FROM sample ORDER BY row_no DESC LIMIT 5)"""

SQL["sample_first_n"] = _DO + "SELECT * FROM dirty_orders ORDER BY row_no LIMIT 5000"
SQL["first_n_narrowed"] = _DO + ("SELECT CASE WHEN row_no % 1000 = 1 THEN row_no * 1000000000 ELSE row_no END AS orden, row_no, hecho "
                                 "FROM dirty_orders ORDER BY orden LIMIT 5000")
SQL["row_cap"] = _DO + "SELECT * FROM dirty_orders ORDER BY row_no LIMIT 10000"
SQL["row_cap_report"] = """SELECT count(*) AS filas_fuente, CAST(10000 AS BIGINT) AS tope, count(*) > 10000 AS recortado FROM orders"""


# --- sources ----------------------------------------------------------------

_WIN = "ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-15' + INTERVAL 1 DAY"
SQL["extract_window"] = f"SELECT * FROM events WHERE {_WIN}"
SQL["count_window"] = f"SELECT upper(event_type) AS tabla, count(*) AS filas FROM events WHERE {_WIN} GROUP BY 1"
SQL["extract_catalogue_table"] = "SELECT * FROM nation"
SQL["page_slice"] = "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10000 OFFSET 10000"
SQL["extract_key_ranges"] = "SELECT *, CAST(1 AS INTEGER) AS lecturas FROM lineitem"
SQL["union_pages"] = SQL["extract_window"]
SQL["period_files"] = f"SELECT *, upper(event_type) AS tabla FROM events WHERE {_WIN}"
# the extract of one table lost every 50th row
_LOST = "upper(event_type) = 'CLICK' AND event_id % 50 = 0"
SQL["reconcile_counts"] = f"""SELECT tabla, a AS filas_oracle, b AS filas_extraidas, CASE WHEN a = b THEN 'OK' ELSE 'ERROR' END AS estado,
  CASE WHEN a = b THEN '' ELSE 'DISCREPANCIA: Oracle=' || a || ' | CSV=' || b END AS mensaje
  FROM (SELECT upper(event_type) AS tabla, count(*) AS a, count(*) FILTER (NOT ({_LOST})) AS b FROM events WHERE {_WIN} GROUP BY 1)"""
SQL["scan_delimited"] = _DO + "SELECT * FROM dirty_orders"
SQL["split_records"] = SQL["scan_delimited"]
SQL["row_numbers"] = _DO + "SELECT row_number() OVER (ORDER BY row_no) AS numero, row_no, hecho FROM dirty_orders"
_ORDER_TEXT = [c for c in ("idpersona", "codigohecho", "fechaocurrencia", "fechareporte", "coddanemunicipioocurrencia", "discapacidad",
                           "hecho", "primernombre", "tipodocumento", "origen", "direccion")]
SQL["inspect_file_columns"] = O.with_(O.DIRTY_ORDERS, "sample AS (SELECT * FROM dirty_orders)") + _inspect_sql(_ORDER_TEXT)
# by class of the key modulo 7: the texts written for each column, after the null tokens
SQL["csv_infer"] = """SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 'NONE' WHEN 3 THEN 'none'
    WHEN 4 THEN 'Null' ELSE c_name END AS c_name,
  CASE WHEN c_custkey % 7 < 3 THEN NULL ELSE CAST(c_nationkey AS BIGINT) END AS c_nationkey,
  CASE WHEN c_custkey % 7 < 2 THEN NULL ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_custkey % 2 = 0 THEN TRUE WHEN c_custkey % 3 = 0 THEN NULL ELSE FALSE END AS c_active,
  CASE WHEN c_custkey % 7 < 2 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer"""
SQL["csv_roundtrip"] = SQL["clean_table"]

# --- ingestion --------------------------------------------------------------

_LI_KEY = ["l_orderkey", "l_linenumber", "ship_day"]
_LI_ORDER = "l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_returnflag, l_linestatus"
_LI_COLS = ("l_orderkey, l_linenumber, ship_day, l_partkey, l_suppkey, l_quantity, l_extendedprice, "
            "l_returnflag, l_linestatus, l_shipdate")
_LI = O.with_(
    f"""inc AS (SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_shipdate AS DATE) END AS ship_day,
  l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus, l_shipdate FROM lineitem)""",
    f"""t AS (SELECT {_LI_COLS} FROM inc WHERE l_shipdate < TIMESTAMP '1998-01-01'
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, ship_day ORDER BY {_LI_ORDER}) = 1)""",
    f"""firsts AS (SELECT {_LI_COLS} FROM inc
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, ship_day ORDER BY {_LI_ORDER}) = 1)""",
    """new AS (SELECT * FROM firsts f WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.l_orderkey = f.l_orderkey
  AND t.l_linenumber = f.l_linenumber AND t.ship_day IS NOT DISTINCT FROM f.ship_day))""")
SQL["insert_ignore"] = _LI + "SELECT * FROM t UNION ALL SELECT * FROM new"
SQL["load_default"] = _LI + "SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS cargado_en FROM new"


def _target_tag() -> str:
    arms = []
    for r in S.BULK_SPEC.columns:
        if r.name not in ORDERS_BULK_COLUMNS:
            continue
        v = _bulk_clean_raw(r.name)
        if r.target in ("int", "smallint"):
            duck = "INTEGER" if r.target == "int" else "SMALLINT"
            arms.append(f"CASE WHEN {v} IS NOT NULL AND TRY_CAST({v} AS {duck}) IS NULL "
                        f"THEN '{r.name}: fuera de rango para {r.target}' END")
        if r.max_length is not None:
            arms.append(f"CASE WHEN length({v}) > {r.max_length} THEN '{r.name}: texto mayor a {r.max_length}' END")
    return "COALESCE(" + ", ".join(arms) + ")"


def _bulk_clean_raw(c: str) -> str:
    r = S.BULK_SPEC.rule(c)
    if r.kind == S.CODE:
        return O.clean_code(c)
    if r.kind == S.INT:
        return O.clean_int(c)
    return _bulk_clean(c)


SQL["copy_text_lines"] = _DO + "SELECT row_no, concat_ws(chr(9), " + ", ".join(
    O.copy_escape(_bulk_clean_raw(c)) for c in ORDERS_BULK_COLUMNS) + ") AS line FROM dirty_orders"

_DUCK_TYPE = {"int": "INTEGER", "smallint": "SMALLINT", "date": "DATE", "string": "VARCHAR"}
_CLEANED = O.with_(O.DIRTY_ORDERS, "cleaned AS (SELECT row_no, " + ", ".join(
    f"{_bulk_clean_raw(c)} AS {c}" for c in ORDERS_BULK_COLUMNS) + f", {_target_tag()} AS _problema FROM dirty_orders)")

SQL["target_accepts"] = _CLEANED + "SELECT row_no, " + ", ".join(
    f"CAST({c} AS {_DUCK_TYPE[S.BULK_SPEC.rule(c).target]}) AS {c}" for c in ORDERS_BULK_COLUMNS
) + " FROM cleaned WHERE _problema IS NULL"
SQL["target_rejects"] = _CLEANED + "SELECT row_no, " + ", ".join(
    (f"TRY_CAST({c} AS BIGINT) AS {c}" if S.BULK_SPEC.rule(c).kind in (S.INT, S.CODE) else c) for c in ORDERS_BULK_COLUMNS
) + ", _problema FROM cleaned WHERE _problema IS NOT NULL"

_BULK_FIRSTS = _CLEANED + ", " + """firsts AS (SELECT * FROM cleaned WHERE _problema IS NULL
  QUALIFY row_number() OVER (PARTITION BY idpersona, codigohecho, fechaocurrencia ORDER BY row_no) = 1)
"""
SQL["bulk_load"] = _BULK_FIRSTS + "SELECT " + ", ".join(
    (f"CAST({c} AS {_DUCK_TYPE[S.BULK_SPEC.rule(c).target]}) AS {c}" if c in ORDERS_BULK_COLUMNS
     else f"CAST(NULL AS {_DUCK_TYPE[S.BULK_SPEC.rule(c).target]}) AS {c}") for c in S.BULK_COLUMNS
) + ", TIMESTAMP '2024-02-01 00:00:00' AS cargado_en FROM firsts"
SQL["load_summary"] = _BULK_FIRSTS + """SELECT (SELECT count(*) FROM cleaned) AS filas_procesadas,
  (SELECT count(*) FROM cleaned WHERE _problema IS NULL) AS enviadas,
  (SELECT count(*) FROM firsts) AS insertadas,
  (SELECT count(*) FROM cleaned WHERE _problema IS NULL) - (SELECT count(*) FROM firsts) AS conflictos,
  (SELECT count(*) FROM cleaned WHERE _problema IS NOT NULL) AS rechazadas,
  (SELECT count(*) FROM firsts) AS total_en_destino"""

# --- ledger -----------------------------------------------------------------

_LEDGER = """ledger AS (SELECT event_id AS id, upper(event_type) || '_' || user_id AS tabla,
  strftime(ts, '%Y-%m-%d') AS fecha_inicio, strftime(ts, '%Y-%m-%d') AS fecha_fin,
  user_id * 100 + 7 AS filas_oracle, user_id * 100 + 7 - CASE WHEN value < 5 THEN 1 ELSE 0 END AS filas_extraidas,
  CASE WHEN value < 5 THEN 'ERROR' ELSE 'OK' END AS estado,
  CASE WHEN value < 5 THEN 'DISCREPANCIA: Oracle=' || (user_id * 100 + 7) || ' | CSV=' || (user_id * 100 + 6)
       ELSE '' END AS mensaje, ts AS ejecutado_en FROM events)"""
_LATEST = O.with_(_LEDGER, """latest AS (SELECT * FROM ledger WHERE estado = 'OK'
  QUALIFY row_number() OVER (PARTITION BY tabla ORDER BY ejecutado_en DESC, id DESC) = 1)""")
SQL["ledger_latest_ok"] = _LATEST + "SELECT * FROM latest"
SQL["pending_extractions"] = _LATEST + """SELECT DISTINCT upper(event_type) || '_' || user_id AS tabla FROM events
  WHERE upper(event_type) || '_' || user_id NOT IN (SELECT tabla FROM latest WHERE fecha_inicio = '2024-01-30')"""
SQL["detect_keys"] = """WITH cons AS (SELECT 'C' || o_orderkey AS constraint_name, 'HOSP' AS owner,
    CASE o_orderstatus WHEN 'F' THEN 'P' WHEN 'O' THEN 'U' ELSE 'R' END AS constraint_type,
    'T' || o_custkey AS table_name FROM orders),
  cols AS (SELECT 'C' || l_orderkey AS constraint_name, 'HOSP' AS owner, 'COL_' || l_partkey AS column_name,
    l_linenumber AS position FROM lineitem),
  tabs AS (SELECT upper('t' || c_custkey) AS table_name FROM customer),
  firsts AS (SELECT c.table_name, k.column_name FROM cons c JOIN cols k
    ON c.constraint_name = k.constraint_name AND c.owner = k.owner
    WHERE c.constraint_type = 'P' AND c.table_name IN (SELECT table_name FROM tabs)
    QUALIFY row_number() OVER (PARTITION BY c.table_name ORDER BY k.position, k.column_name) = 1)
SELECT t.table_name, COALESCE(f.column_name, 'ROWID') AS pk FROM tabs t LEFT JOIN firsts f USING (table_name)"""
SQL["best_run"] = """WITH r AS (SELECT event_type AS metodo, user_id AS lote, value AS tiempo_s,
    value * 0.5 + user_id AS ram_mb, 50000.0 / value AS filas_s FROM events)
(SELECT 'menor_ram' AS criterio, metodo, lote, tiempo_s, ram_mb FROM r
  ORDER BY ram_mb, -filas_s, metodo, lote, tiempo_s LIMIT 1)
UNION ALL (SELECT 'mayor_velocidad' AS criterio, metodo, lote, tiempo_s, ram_mb FROM r
  ORDER BY -filas_s, ram_mb, metodo, lote, tiempo_s LIMIT 1)"""

# --- delivery ---------------------------------------------------------------

SQL["delivery_name"] = "SELECT n_nationkey, upper(n_name) || '_2024_01-01.csv' AS archivo FROM nation"
_EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _digest(source: str) -> str:
    fields = [f"CAST({c} AS VARCHAR)" for c in _EVENT_COLS]
    row = " || ".join(f"COALESCE(length({f}) || ':' || {f}, '-')" for f in fields)
    return f"""digest AS (SELECT tabla, count(*) AS filas,
  CAST(sum(CAST(('0x' || substr(md5({row}), 1, 15)) AS BIGINT)) AS VARCHAR) AS digest,
  count(*) - count(props) AS sin_props FROM {source} GROUP BY 1)"""


_WINDOW = f"w AS (SELECT *, upper(event_type) AS tabla FROM events WHERE {_WIN})"
SQL["content_digest"] = O.with_(_WINDOW, _digest("w")) + "SELECT tabla, filas, digest FROM digest"
SQL["manifest"] = O.with_(
    _WINDOW, f"""delivered AS (SELECT * REPLACE (CASE WHEN value >= 5 THEN props END AS props) FROM w WHERE NOT ({_LOST}))""",
    _digest("delivered"), "source AS (SELECT tabla, count(*) AS n FROM w GROUP BY 1)") + f"""SELECT tabla,
  '2024-01-10' AS periodo_inicio, '2024-01-15' AS periodo_fin, tabla || '_2024_01-01.csv' AS archivo, n AS filas_oracle,
  filas AS filas_csv, digest, TRUE AS partes_con_md5, filas AS calidad_total_filas,
  CAST(CASE WHEN sin_props > 0 THEN 1 ELSE 0 END AS BIGINT) AS calidad_columnas_con_nulos,
  {O.percent('sin_props', 'filas')} AS calidad_max_pct_nulos, 'tableflow 0.1.0' AS generado_por FROM source JOIN digest USING (tabla)"""


# --- streaming --------------------------------------------------------------

SQL["stream_insert_ignore"] = "SELECT * FROM events"
SQL["stream_batches"] = """SELECT CAST(4 AS BIGINT) AS lotes, 2 * count(*) AS filas_leidas, count(*) AS insertadas,
  count(*) AS conflictos FROM events"""
SQL["stream_resume"] = _BULK_FIRSTS + """, n AS (SELECT count(*) AS leidas, count(*) FILTER (_problema IS NOT NULL) AS malas FROM cleaned)
  SELECT 1 AS run, leidas AS filas_leidas, (SELECT count(*) FROM firsts) AS insertadas, malas AS rechazadas FROM n
  UNION ALL SELECT 2, leidas, 0, malas FROM n"""
SQL["batch_progress"] = """WITH b AS (SELECT i AS batch_id,
    (SELECT count(*) FROM events WHERE event_id % 4 = i OR (event_id % 4 = i - 1 AND event_id % 10 = 0)) AS filas_leidas,
    (SELECT count(*) FROM events WHERE event_id % 4 = i) AS insertadas FROM range(4) t(i))
  SELECT batch_id, filas_leidas, insertadas, CAST(sum(filas_leidas) OVER w AS BIGINT) AS filas_acumuladas,
    CAST(sum(insertadas) OVER w AS BIGINT) AS insertadas_acumuladas, CAST(batch_id + 1 AS INTEGER) AS lote
  FROM b WINDOW w AS (ORDER BY batch_id)"""
SQL["stream_rejects"] = SQL["target_rejects"]

SQL["sql_functions"] = _DO + f"""SELECT row_no, {O.clean_date('fechaocurrencia')} AS fecha,
  TRY_CAST({O.clean_int('idpersona')} AS BIGINT) AS entero,
  TRY_CAST({O.clean_code('coddanemunicipioocurrencia')} AS BIGINT) AS codigo, {O.clean_text('hecho')} AS hecho,
  {O.value_kind('lower(' + O.strip('primernombre') + ')')} AS kind FROM dirty_orders"""

# the text reader splits lines at LF and at CR: rows whose text field holds "LF - CR" add two lines
SQL["line_count"] = """SELECT count(*) + 2 * sum(CASE WHEN o_orderkey % 4 = 2 THEN 1 ELSE 0 END) AS total_filas
  FROM orders"""

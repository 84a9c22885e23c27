"""DuckDB SQL of the derived inputs and of each cleaning rule, for the correctness gate.

Only used to build ``oracle_sql()`` strings: an independent statement of the same
semantics in another engine's dialect (RE2 regexes, strptime formats).
"""

from __future__ import annotations

# White space as Python's str.isspace() sees it, spelled for RE2.
WS = (r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
      r"\x{202F}\x{205F}\x{3000}]")
D = "[0-9]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def clean_text(x: str) -> str:
    return f"nullif(lower(trim(regexp_replace({x}, '{WS}+', ' ', 'g'))), '')"


def clean_int(x: str, dtype: str = "DECIMAL(38,0)") -> str:
    s = strip(x)
    largest = f"CAST('{'9' * 38}' AS DECIMAL(38,0))"
    return (f"(CASE WHEN regexp_full_match({s}, '[+-]?{D}+(_{D}+)*') "
            f"THEN COALESCE(TRY_CAST(replace({s}, '_', '') AS {dtype}), "
            f"CASE WHEN starts_with({s}, '-') THEN -{largest} ELSE {largest} END) END)")


def clean_code(x: str, dtype: str = "DECIMAL(38,0)") -> str:
    n = clean_int(x, dtype)
    return f"(CASE WHEN {n} <> 0 THEN {n} END)"


_LAYOUTS = [
    (f"({D}{{1,2}})/({D}{{1,2}})/({D}{{4}})", 3, 2, 1, False),
    (f"({D}{{4}})-({D}{{1,2}})-({D}{{1,2}})", 1, 2, 3, False),
    (f"({D}{{1,2}})-({D}{{1,2}})-({D}{{4}})", 3, 2, 1, False),
    (f"({D}{{2}})-({D}{{1,2}})-({D}{{1,2}})", 1, 2, 3, True),
    (f"({D}{{1,2}})-({D}{{1,2}})-({D}{{2}})", 3, 2, 1, True),
]


def clean_date(x: str) -> str:
    s = strip(x)
    arms = []
    for pat, gy, gm, gd, two in _LAYOUTS:
        y = f"regexp_extract({s}, '^{pat}$', {gy})"
        if two:
            y = f"(CASE WHEN {y} <= '68' THEN '20' || {y} ELSE '19' || {y} END)"
        m = f"regexp_extract({s}, '^{pat}$', {gm})"
        d = f"regexp_extract({s}, '^{pat}$', {gd})"
        t = f"try_strptime({y} || '-' || {m} || '-' || {d}, '%Y-%m-%d')"
        arms.append(f"(CASE WHEN regexp_full_match({s}, '{pat}') AND year({t}) BETWEEN 1900 AND 2100 "
                    f"THEN CAST({t} AS DATE) END)")
    return f"(CASE WHEN {s} <> '' AND {s} <> '01/01/1900' THEN COALESCE({', '.join(arms)}) END)"


def clean_date_text(x: str) -> str:
    return f"strftime({clean_date(x)}, '%Y-%m-%d')"


def null_token(x: str) -> str:
    v = f"lower({strip(x)})"
    return f"(CASE WHEN {v} NOT IN ('', 'null', 'none') THEN {v} END)"


_FLOAT = (f"(?i)[+-]?(({D}+(_{D}+)*\\.?({D}+(_{D}+)*)?|\\.{D}+(_{D}+)*)(e[+-]?{D}+(_{D}+)*)?"
          f"|inf(inity)?|nan)")


def value_kind(v: str) -> str:
    return (f"(CASE WHEN regexp_full_match({v}, '-*{D}+') THEN 'int' "
            f"WHEN regexp_full_match({v}, '{_FLOAT}') THEN 'float' ELSE 'str' END)")


def coerce_timestamp(x: str) -> str:
    return (f"COALESCE(try_strptime({x}, '%Y-%m-%d %H:%M:%S'), try_strptime({x}, '%Y-%m-%d %H:%M:%S.%f'), "
            f"try_strptime({x}, '%Y-%m-%dT%H:%M:%S'), try_strptime({x}, '%Y-%m-%dT%H:%M:%S.%f'), "
            f"try_strptime({x}, '%Y-%m-%d'))")


def copy_escape(x: str) -> str:
    return (f"COALESCE(replace(replace(replace(replace(CAST({x} AS VARCHAR), '\\', '\\\\'), chr(9), ' '), "
            f"chr(10), ' '), chr(13), ' '), '\\N')")


def percent(part: str, total: str) -> str:
    return f"(CASE WHEN {total} > 0 THEN round_even({part} / {total} * 100, 2) ELSE 0.0 END)"


_DUCK_LAYOUTS = ("%d/%m/%Y", "%Y-%m-%d", "%d-%m-%Y", "%y-%m-%d", "%d-%m-%y", "%-d/%-m/%Y")


def _date_text(d: str, sel: str) -> str:
    arms = " ".join(f"WHEN {sel} = {i} THEN strftime({d}, '{f}')" for i, f in enumerate(_DUCK_LAYOUTS))
    return f"(CASE {arms} END)"


DIRTY_ORDERS = f"""dirty_orders AS (
  SELECT o_orderkey AS row_no,
    CASE WHEN o_orderkey % 97 = 5 THEN repeat('7', 38) || o_orderkey
         WHEN o_orderkey % 6 = 0 THEN '+' || o_orderkey
         WHEN o_orderkey % 6 = 1 THEN ' ' || o_orderkey || ' '
         WHEN o_orderkey % 6 = 2 THEN o_orderkey || '.0'
         WHEN o_orderkey % 6 = 3 THEN o_orderkey || '_0'
         WHEN o_orderkey % 6 = 4 THEN '--' || o_orderkey
         ELSE CAST(o_orderkey AS VARCHAR) END AS idpersona,
    CASE WHEN o_orderstatus = 'F' THEN '1' WHEN o_orderstatus = 'O' THEN ' 2 ' ELSE '3' END AS codigohecho,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL
         WHEN o_orderkey % 13 = 0 THEN 'no-date'
         WHEN o_orderkey % 11 = 0 THEN '01/01/1900'
         WHEN o_orderkey % 7 = 0 THEN chr(9) || {_date_text('CAST(o_orderdate AS DATE)', 'o_orderkey % 6')} || ' '
         ELSE {_date_text('CAST(o_orderdate AS DATE)', 'o_orderkey % 6')} END AS fechaocurrencia,
    CASE WHEN o_orderkey % 19 = 0 THEN '31/02/1999'
         ELSE {_date_text('(CAST(o_orderdate AS DATE) + CAST(o_custkey % 30 AS INTEGER))', '(o_orderkey + 3) % 6')}
         END AS fechareporte,
    CASE WHEN o_custkey % 5 = 0 THEN '0' WHEN o_custkey % 5 = 1 THEN '00' WHEN o_custkey % 5 = 2 THEN '-0'
         WHEN o_custkey % 5 = 3 THEN lpad(CAST(o_custkey AS VARCHAR), 5, '0')
         ELSE CAST(o_custkey AS VARCHAR) END AS coddanemunicipioocurrencia,
    CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR) AS discapacidad,
    CASE WHEN o_orderkey % 4 = 0 THEN '  ' || upper(o_orderpriority) || ' '
         WHEN o_orderkey % 4 = 1 THEN chr(160) || o_orderpriority || chr(9)
         WHEN o_orderkey % 4 = 2 THEN replace(o_orderpriority, '-', chr(10) || ' - ' || chr(13))
         ELSE lower(o_orderpriority) || chr(133) END AS hecho,
    CASE WHEN o_orderkey % 9 = 0 THEN '   ' WHEN o_orderkey % 9 = 1 THEN 'NULL'
         WHEN o_orderkey % 9 = 2 THEN ' none' ELSE 'Cliente ' || o_custkey END AS primernombre,
    CASE WHEN o_orderkey % 3 = 0 THEN lower(o_orderstatus) ELSE o_orderstatus END AS tipodocumento,
    repeat(o_orderpriority, 4) AS origen,
    'Calle ' || (o_custkey % 100) || ' # ' || o_orderkey AS direccion
  FROM orders)"""

PATIENTS = """patients AS (
  SELECT CASE WHEN c.c_nationkey = 11 THEN NULL ELSE c.c_custkey END AS PACIENTE_ID,
    CASE WHEN c.c_acctbal < 0 THEN NULL WHEN c.c_custkey % 2 = 0 THEN '  ' || c.c_name || ' '
         ELSE c.c_name || chr(9) END AS NOMBRE,
    CASE WHEN c.c_mktsegment = 'MACHINERY' THEN 'no-es-fecha' WHEN c.c_nationkey = 3 THEN NULL
         ELSE strftime(DATE '1940-01-01' + CAST(trunc(abs(c.c_acctbal)) AS INTEGER), '%Y-%m-%d') END AS FECHA_NACIMIENTO,
    CASE WHEN c.c_nationkey = 7 THEN '2024-13-01'
         ELSE '2024-01-' || lpad(CAST(c.c_custkey % 28 + 1 AS VARCHAR), 2, '0')
              || CASE WHEN c.c_custkey % 10 = 0 THEN 'T08:30:00' ELSE ' 10:15:00' END END AS CREATED_AT,
    ' ' || c.c_mktsegment AS SEGMENTO,
    c.c_nationkey AS MUNICIPIO_ID
  FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey)"""

CUSTOMER_HOLES = """customer_holes AS (
  SELECT c_custkey,
    CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS c_name,
    CASE WHEN c_nationkey < 10 THEN NULL ELSE c_nationkey END AS c_nationkey,
    CASE WHEN c_acctbal > 9000 THEN NULL ELSE c_acctbal END AS c_acctbal,
    CASE WHEN c_nationkey < 24 THEN NULL ELSE c_mktsegment END AS c_mktsegment
  FROM customer)"""

# floats as a profile compares them: NaN is no value, -0.0 is 0.0
CUSTOMER_FLOATS = CUSTOMER_HOLES + """,
customer_floats AS (
  SELECT c_custkey, c_name, c_nationkey,
    CASE c_custkey % 50 WHEN 1 THEN NULL WHEN 2 THEN 0.0 WHEN 3 THEN 0.0 ELSE c_acctbal END AS c_acctbal, c_mktsegment
  FROM customer_holes)"""

CUSTOMER_TEXT = CUSTOMER_HOLES + """,
customer_text AS (
  SELECT c_custkey AS row_no, CASE WHEN c_custkey % 1000 = 999 THEN c_custkey || 'x' ELSE CAST(c_custkey AS VARCHAR) END AS c_custkey,
    CASE WHEN c_name IS NULL AND c_custkey % 2 = 0 THEN 'NULL' WHEN c_name IS NULL THEN ' none '
         ELSE c_name END AS c_name,
    COALESCE(CAST(c_nationkey AS VARCHAR), '') AS c_nationkey,
    COALESCE(CAST(c_acctbal AS VARCHAR), 'Null') AS c_acctbal,
    CASE WHEN c_custkey % 3 = 0 THEN ' -' || CAST(c_custkey % 7 AS VARCHAR) ELSE c_mktsegment END AS c_mktsegment
  FROM customer_holes)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"

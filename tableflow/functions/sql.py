"""The cleaning rules as SQL expression text.

Used twice: as temporary SQL functions (``CREATE TEMPORARY FUNCTION ... RETURN``) for SQL
users, and by the record cleaner, which builds each column's rule with one
``F.expr`` call (the same expressions as :mod:`tableflow.functions.rules`, but built
JVM-side from text instead of node by node from Python).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tableflow.functions import rules as R


def lit(s: str) -> str:
    """A SQL string literal (backslashes and quotes escaped)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


_WS = R._WS


def strip_sql(c: str) -> str:
    return f"btrim({c}, {lit(R.WHITE)})"


def text_sql(c: str) -> str:
    return f"nullif(lower(trim(regexp_replace({c}, {lit(_WS + '+')}, ' '))), '')"


def int_sql(s: str, dtype: str = "DECIMAL(38,0)") -> str:
    """On a stripped text; beyond 38 digits the largest value of the sign."""
    largest, least = (f"CAST('{sign}{'9' * 38}' AS {dtype})" for sign in ("", "-"))
    return (f"(CASE WHEN {s} RLIKE {lit(R._INT_TEXT_RE)} THEN coalesce(try_cast(replace({s}, '_', '') AS {dtype}), "
            f"if(startswith({s}, '-'), {least}, {largest})) END)")


def code_sql(s: str, dtype: str = "DECIMAL(38,0)") -> str:
    return f"(CASE WHEN NOT {s} RLIKE {lit(R._ZERO_RE)} THEN {int_sql(s, dtype)} END)"


def kind_sql(v: str) -> str:
    return (f"(CASE WHEN {v} RLIKE {lit(R._KIND_INT_RE)} THEN 'int' "
            f"WHEN {v} RLIKE {lit(R._KIND_FLOAT_RE)} THEN 'float' ELSE 'str' END)")


def date_fields_sql(s: str) -> list[str]:
    """Three numbers and the first matching layout (1-based) of a stripped date text."""
    nums = [f"try_cast(get(split({s}, '[/-]'), {i}) AS INT)" for i in range(3)]
    arms = " ".join(f"WHEN {s} RLIKE {lit(R._LAYOUT_PARTS[name][0])} THEN {i}"
                    for i, name in enumerate(R.DATE_LAYOUTS, start=1))
    return [*nums, f"(CASE {arms} END)"]


def _pivot(y: str) -> str:
    return f"(CASE WHEN {y} <= {R.TWO_DIGIT_YEAR_PIVOT} THEN {y} + 2000 ELSE {y} + 1900 END)"


def date_parts_sql(fields: list[str]) -> list[str]:
    """Year, month and day picked by layout."""
    a, b, c, layout = fields
    nums = (a, b, c)
    out = []
    for slot in range(3):
        arms = []
        for i, name in enumerate(R.DATE_LAYOUTS, start=1):
            v = nums[R._LAYOUT_PARTS[name][1 + slot]]
            if slot == 0 and "%y" in name:
                v = _pivot(v)
            arms.append(f"WHEN {layout} = {i} THEN {v}")
        out.append(f"(CASE {' '.join(arms)} END)")
    return out


def _valid_date(y: str, m: str, d: str) -> str:
    base = (f"make_date(CASE WHEN {y} BETWEEN {R.YEAR_MIN} AND {R.YEAR_MAX} THEN {y} ELSE 2000 END, "
            f"CASE WHEN {m} BETWEEN 1 AND 12 THEN {m} ELSE 1 END, 1)")
    return (f"(CASE WHEN {y} BETWEEN {R.YEAR_MIN} AND {R.YEAR_MAX} AND {m} BETWEEN 1 AND 12 "
            f"AND {d} BETWEEN 1 AND dayofmonth(last_day({base})) THEN date_add({base}, {d} - 1) END)")


def date_final_sql(s: str, fields: list[str], parts: list[str]) -> str:
    a, b, c, layout = fields
    y, m, d = parts
    fallback = (f"(CASE WHEN {layout} = 4 AND {s} RLIKE {lit(R._AMBIGUOUS_RE)} "
                f"THEN {_valid_date(_pivot(c), b, a)} END)")
    return (f"(CASE WHEN {s} <> '' AND {s} <> {lit(R.DATE_SENTINEL)} "
            f"THEN coalesce({_valid_date(y, m, d)}, {fallback}) END)")


def date_sql(s: str) -> str:
    """The whole date rule in one expression, on a stripped text."""
    fields = date_fields_sql(s)
    return date_final_sql(s, fields, date_parts_sql(fields))


def register(spark: SparkSession) -> list[str]:
    """Register strip_text, clean_text, clean_int, clean_code, clean_date, value_kind."""
    st = strip_sql("s")
    defs = {
        "strip_text": ("STRING", st),
        "clean_text": ("STRING", text_sql("s")),
        "clean_int": ("DECIMAL(38,0)", int_sql(f"({st})")),
        "clean_code": ("DECIMAL(38,0)", code_sql(f"({st})")),
        "clean_date": ("DATE", date_sql(f"({st})")),
        "value_kind": ("STRING", kind_sql("s")),
    }
    for name, (ret, body) in defs.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS {ret} RETURN {body}")
    return list(defs)

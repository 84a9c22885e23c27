"""Cleaning rules as Spark Column expressions.

Every rule is a composition of built-in functions, so it stays inside whole-stage
codegen and runs wherever the row lives. No Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's rules for identical results)
# ---------------------------------------------------------------------------
# Date text that stands for "no date".
DATE_SENTINEL = "01/01/1900"
# Accepted date layouts, tried in this order: %d/%m/%Y, %Y-%m-%d, %d-%m-%Y, %y-%m-%d, %d-%m-%y
DATE_LAYOUTS = ("%d/%m/%Y", "%Y-%m-%d", "%d-%m-%Y", "%y-%m-%d", "%d-%m-%y")
# Years outside this range make a layout fail, so the next one is tried.
YEAR_MIN, YEAR_MAX = 1900, 2100
# Two-digit years up to this value are 20xx, later ones 19xx.
TWO_DIGIT_YEAR_PIVOT = 68
# Text read as "no value" by the file inspector (after strip + lower).
NULL_TOKENS = ("", "null", "none")
# Null marker and field separator of the bulk text format.
COPY_NULL = "\\N"
COPY_SEPARATOR = "\t"
# ---------------------------------------------------------------------------

# White space as Python's str.isspace() sees it (Unicode White_Space plus the four
# information separators U+001C..U+001F), spelled out: an explicit class is cheaper
# to match than a Unicode property.
_WS = (r"[\t\n\x0b\f\r\x1c-\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: the same characters, for the trim functions
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_COLLAPSE_RE = _WS + r"+"

LARGEST = "decimal(38,0)"
_INT_TEXT_RE = r"^[+-]?\d+(_\d+)*$"
_ZERO_RE = r"^[+-]?0+(_0+)*$"
_KIND_INT_RE = r"^-*\d+$"
_DIGITS = r"\d+(_\d+)*"
_KIND_FLOAT_RE = (r"(?i)^[+-]?((" + _DIGITS + r"\.?(" + _DIGITS + r")?|\." + _DIGITS + r")(e[+-]?"
                  + _DIGITS + r")?|inf(inity)?|nan)$")

# One regex per layout of DATE_LAYOUTS and the order of its three fields in the text
# (index of year, month, day after splitting on the separators).
_LAYOUT_PARTS = {
    "%d/%m/%Y": (r"^\d{1,2}/\d{1,2}/\d{4}$", 2, 1, 0),
    "%Y-%m-%d": (r"^\d{4}-\d{1,2}-\d{1,2}$", 0, 1, 2),
    "%d-%m-%Y": (r"^\d{1,2}-\d{1,2}-\d{4}$", 2, 1, 0),
    "%y-%m-%d": (r"^\d{2}-\d{1,2}-\d{1,2}$", 0, 1, 2),
    "%d-%m-%y": (r"^\d{1,2}-\d{1,2}-\d{2}$", 2, 1, 0),
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Remove leading and trailing white space (tabs, NBSP, U+0085 and U+001C-1F too)."""
    return F.btrim(_col(c), F.lit(WHITE))


def clean_text(c) -> Column:
    """Collapse white-space runs to one blank, trim, lower-case; empty gives null."""
    collapsed = F.regexp_replace(_col(c), _COLLAPSE_RE, " ")
    return F.nullif(F.lower(F.trim(collapsed)), F.lit(""))


def clean_int(c, dtype: str = "decimal(38,0)", stripped: bool = False) -> Column:
    """Integer from text: optional sign, digit groups joined by '_', outer white space.

    Anything else (``12.0``, ``1e3``, ``--5``) is null. The value is exact up to 38
    digits; a longer one becomes the largest value of its sign, which no target column
    holds, so the target check sets the row aside instead of losing the number.
    """
    s = _col(c) if stripped else strip(c)
    limit = F.when(s.startswith("-"), F.lit("-" + "9" * 38).cast(LARGEST)).otherwise(F.lit("9" * 38).cast(LARGEST))
    n = F.coalesce(F.replace(s, F.lit("_"), F.lit("")).try_cast(LARGEST), limit)
    return F.when(s.rlike(_INT_TEXT_RE), n).try_cast(dtype)


def clean_code(c, dtype: str = "decimal(38,0)", stripped: bool = False) -> Column:
    """Like :func:`clean_int`, and code 0 (``0``, ``00``, ``-0``) means "unknown" -> null."""
    s = _col(c) if stripped else strip(c)
    return F.when(~s.rlike(_ZERO_RE), clean_int(s, dtype, stripped=True))


_AMBIGUOUS_RE = r"^\d{2}-\d{1,2}-\d{2}$"   # fits both two-digit-year layouts


def date_fields(s: Column) -> list[Column]:
    """Per date text: its three numbers (split on the separators) and the first layout
    whose pattern it fits (1-based, null when none)."""
    parts = F.split(s, "[/-]")
    nums = [F.get(parts, F.lit(i)).try_cast("int") for i in range(3)]
    layout = None
    for i, name in enumerate(DATE_LAYOUTS, start=1):
        hit = s.rlike(_LAYOUT_PARTS[name][0])
        layout = F.when(hit, F.lit(i)) if layout is None else layout.when(hit, F.lit(i))
    return [*nums, layout]


def _pivot(y: Column) -> Column:
    return F.when(y <= TWO_DIGIT_YEAR_PIVOT, y + 2000).otherwise(y + 1900)


def _valid_date(y: Column, m: Column, d: Column) -> Column:
    """make the date when year, month and day are in range, else null; never throws.

    The base is the first of the month, clamped to a valid date so ``make_date`` cannot
    fail; the day is added as an offset once it is known to fit the month.
    """
    month_ok = m.between(1, 12)
    base = F.make_date(F.when(y.between(YEAR_MIN, YEAR_MAX), y).otherwise(F.lit(2000)),
                       F.when(month_ok, m).otherwise(F.lit(1)), F.lit(1))
    ok = y.between(YEAR_MIN, YEAR_MAX) & month_ok & d.between(F.lit(1), F.dayofmonth(F.last_day(base)))
    return F.when(ok, F.date_add(base, d - 1))


def date_parts(fields) -> list[Column]:
    """Year, month and day of a date text, from its :func:`date_fields`, by layout."""
    a, b, c, layout = fields
    nums = (a, b, c)
    out = []
    for slot in range(3):
        expr = None
        for i, name in enumerate(DATE_LAYOUTS, start=1):
            v = nums[_LAYOUT_PARTS[name][1 + slot]]
            if slot == 0 and "%y" in name:
                v = _pivot(v)
            expr = F.when(layout == i, v) if expr is None else expr.when(layout == i, v)
        out.append(expr)
    return out


def date_from_parts(s: Column, fields, parts) -> Column:
    """:func:`clean_date` from the stripped text, its fields and its (year, month, day).

    A value that fits the first two-digit-year layout but is no valid date there falls
    back to the second one. The record cleaner keeps fields and parts in their own
    columns (one projection each), so each is computed once per row.
    """
    a, b, c, layout = fields
    y, m, d = parts
    first = _valid_date(y, m, d)
    fallback = F.when((layout == 4) & s.rlike(_AMBIGUOUS_RE), _valid_date(_pivot(c), b, a))
    return F.when((s != F.lit("")) & (s != F.lit(DATE_SENTINEL)), F.coalesce(first, fallback))


def date_from_fields(s: Column, fields) -> Column:
    return date_from_parts(s, fields, date_parts(fields))


def clean_date(c, stripped: bool = False) -> Column:
    """Date from text in the accepted layouts (first that fits wins); sentinel and junk give null.

    A single expression, convenient in SQL and ad-hoc selects. For whole tables use
    :func:`tableflow.operators.records.clean_record` (same rule, staged projections).
    """
    s = _col(c) if stripped else strip(c)
    return date_from_fields(s, date_fields(s))


def clean_date_text(c, stripped: bool = False) -> Column:
    """:func:`clean_date` rendered as ISO text, for targets that store dates as text."""
    return F.date_format(clean_date(c, stripped), "yyyy-MM-dd")


def null_token(c) -> Column:
    """Stripped, lower-cased text; the null tokens (and a missing field) give null."""
    v = F.lower(strip(c))
    return F.when(~v.isin(*NULL_TOKENS), v)


def value_kind(c) -> Column:
    """'int', 'float' or 'str' for a (stripped, lower-cased) text value."""
    v = _col(c)
    return (F.when(v.rlike(_KIND_INT_RE), F.lit("int"))
             .when(v.rlike(_KIND_FLOAT_RE), F.lit("float"))
             .otherwise(F.lit("str")))


def typed_value(c) -> Column:
    """Value of a text by its kind: a struct (int, float, str) with one field set.

    ``--5`` is of kind int but has no integer value, so the int field is null; so has an
    integer of more than 38 digits, whose text stays in the input.
    """
    v = _col(c)
    kind = value_kind(v)
    return F.struct(
        F.when(kind == "int", v.try_cast(LARGEST)).alias("as_int"),
        F.when(kind == "float", F.regexp_replace(v, "_", "").try_cast("double")).alias("as_float"),
        F.when(kind == "str", v).alias("as_str"),
    )


DEFAULT_TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss[.SSSSSS]", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]", "yyyy-MM-dd")
# Shape of the text each default format can parse. A parse is only attempted on text
# of the right shape: failed parses are costly (exception per value on the JVM).
_FORMAT_SHAPES = {
    "yyyy-MM-dd HH:mm:ss[.SSSSSS]": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,6})?$",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]": r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?$",
    "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$",
}


def coerce_timestamp(c, formats=DEFAULT_TIMESTAMP_FORMATS) -> Column:
    """Timestamp (without time zone) from text in one of the declared formats; bad text gives null."""
    v = _col(c)
    parsed = []
    for f in formats:
        p = F.try_to_timestamp(v, F.lit(f))
        shape = _FORMAT_SHAPES.get(f)
        parsed.append(F.when(v.rlike(shape), p) if shape else p)
    return F.coalesce(*parsed).cast("timestamp_ntz")


def fence(c) -> Column:
    """The same value, computed where it stands.

    A filter on a computed column is normally pushed below the projection that
    computes it, with the whole expression copied into the filter: the rules would run
    twice and lose their staging. Wrapping the value in an always-true guard on the
    partition id marks the projection as non-pushable, so the filter reads the column.
    """
    return F.when(F.spark_partition_id() >= 0, _col(c))


def is_invalid(raw, parsed) -> Column:
    """A value that was present but did not parse."""
    return _col(parsed).isNull() & _col(raw).isNotNull()


def copy_escape(c) -> Column:
    """One field of the bulk text format: backslash doubled, tab/LF/CR as blank, null as \\N."""
    s = _col(c).cast("string")
    esc = F.translate(F.replace(s, F.lit("\\"), F.lit("\\\\")), "\t\n\r", "   ")
    return F.coalesce(esc, F.lit(COPY_NULL))


def percent(part, total, scale: int = 2) -> Column:
    """part / total * 100 rounded half-to-even; 0 when total is 0."""
    p, t = _col(part), _col(total)
    return F.when(t > 0, F.bround(p / t * 100, scale)).otherwise(F.lit(0.0))

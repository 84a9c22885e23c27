"""Date columns whose layout nobody declared: every layout is scored over all rows, the one that reads most is elected.

A layout is the order of year, month and day; separators (one kind a value), a time of
day and one-digit months and days are taken in any of them. All columns are scored in one
partial aggregate of a few counts, so one row reaches the driver, whatever the table's
size. A value that the elected layout does not read is a bad date, as with a declared one:
in a mixed column the minority is reported and not guessed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow import spec as S
from tableflow.functions import rules as R
from tableflow.operators import quarantine as Q

#: of layouts that read equally many values the first is elected: 01/02/2024 alone is January 2nd
LAYOUTS = ("ymd", "mdy", "dmy")
_PARTS = r"^(\d{1,4})([-/.])(\d{1,2})\2(\d{1,4})(?:[ T](\d{1,2}):(\d{2})(?::(\d{2}(?:\.\d{1,6})?))?)?$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})$"


#: before each field of a text that has the shape of a date
_MARK = "\u0001"
_FIELDS = "".join(f"{_MARK}${g}" for g in (1, 3, 4, 5, 6, 7))


def _let(value: Column, use) -> Column:
    """``use(value)``, the value computed once. A lambda's body also stays out of the generated method, which with several
    columns in it would outgrow what the JVM compiles."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _fields(c) -> Column:
    """The fields of a text (date parts as they stand, hour, minute, second), null if it has not the shape of a date: one match of the pattern."""
    def parts(v):
        marked = F.regexp_replace(v, _PARTS, _FIELDS)
        return _let(marked, lambda m: F.when(m != v, F.split(m, _MARK)))

    # a compact text has only ymd's shape then
    dashed = _let(R.strip(c), lambda v: F.when(F.length(v) == 8, F.regexp_replace(v, _COMPACT, "$1-$2-$3")).otherwise(v))
    return _let(dashed, parts)


def _date_of(fields: Column, layout: str) -> Column:
    def date(f):
        text = {p: F.get(f, F.lit(i)) for i, p in enumerate(layout, 1)}
        number = {p: t.try_cast("int") for p, t in text.items()}
        time = [F.coalesce(F.when(F.get(f, F.lit(i)) != "", F.get(f, F.lit(i)).try_cast(kind)), F.lit(0).cast(kind)) for i, kind in ((4, "int"), (5, "int"), (6, "decimal(16,6)"))]
        short = (F.length(text["m"]) <= 2) & (F.length(text["d"]) <= 2) & (F.length(text["y"]) == 4)
        # another layout's values and absent times go by here: a failed cast or date costs an exception a value
        fits = short & number["m"].between(1, 12) & number["d"].between(1, 31)
        return F.when(fits, F.try_make_timestamp_ntz(number["y"], number["m"], number["d"], *time))

    return _let(fields, date)


def read_date(c, layout: str) -> Column:
    """Timestamp (without time zone) of a text in this layout; another text, or a day that does not exist, gives null.

    A year has four digits. Fields are put together from numbers: nothing is parsed by
    pattern, so bad text costs no exception.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"no date layout {layout!r}; there are {', '.join(LAYOUTS)}")
    return _date_of(_fields(c), layout)


def layout_scores(df: DataFrame, columns) -> DataFrame:
    """One row for each column and layout: the values that it reads, and the values there are."""
    # the fields stand in columns of their own, so that a value is matched once for all layouts
    fields = df.select(*[x for i, c in enumerate(columns) for x in (_fields(F.col(f"`{c}`")).alias(f"f{i}"), F.isnotnull(F.col(f"`{c}`")).alias(f"v{i}"))])
    counts = [F.count(_date_of(F.col(f"f{i}"), x)).alias(f"n{i}_{x}") for i in range(len(columns)) for x in LAYOUTS]
    known = [F.count_if(F.col(f"v{i}")).alias(f"k{i}") for i in range(len(columns))]
    rows = [F.struct(F.lit(c).alias("columna"), F.lit(x).alias("formato"), F.lit(j).alias("orden"), F.col(f"n{i}_{x}").alias("leidas"),
                     F.col(f"k{i}").alias("valores")) for i, c in enumerate(columns) for j, x in enumerate(LAYOUTS)]
    return fields.agg(*counts, *known).select(F.inline(F.array(*rows)))


def elect_layouts(df: DataFrame, columns) -> dict[str, str]:
    """The layout of each text column, the first of equals; a column without a value that reads gets the first layout."""
    columns = [c for c in columns if c in df.columns and df.schema[c].dataType.simpleString() == "string"]
    if not columns:
        return {}
    best: dict[str, tuple] = {}
    for r in layout_scores(df, columns).collect():     # a few rows a column
        best[r["columna"]] = max(best.get(r["columna"], (-1, 0, "")), (r["leidas"], -r["orden"], r["formato"]))
    return {c: b[2] for c, b in best.items()}


def coerce_elected(df: DataFrame, columns, layouts: dict[str, str] | None = None) -> DataFrame:
    """The date columns as timestamps by their elected layouts (``layouts`` of an earlier election, or now); the others as they are."""
    layouts = elect_layouts(df, columns) if layouts is None else layouts
    # fields first, dates then: a value is matched once
    fields = df.select(*[_fields(F.col(f"`{c}`")).alias(c) if c in layouts else F.col(f"`{c}`") for c in df.columns])
    return fields.select(*[_date_of(F.col(f"`{c}`"), layouts[c]).alias(c) if c in layouts else F.col(f"`{c}`") for c in df.columns])


def elected_problems(df: DataFrame, columns, layouts: dict[str, str] | None = None) -> DataFrame:
    """Rows with a value that the elected layout of its column does not read, once for each such column; raw text kept."""
    layouts = elect_layouts(df, columns) if layouts is None else layouts
    tags = [F.when(R.is_invalid(F.col(f"`{c}`"), read_date(F.col(f"`{c}`"), x)), F.lit(S.BAD_DATE_TAG.format(col=c))) for c, x in layouts.items()]
    if not tags:
        return df.limit(0).withColumn(Q.PROBLEM, F.lit(None).cast("string"))
    return df.select("*", F.explode(F.filter(F.array(*tags), lambda t: t.isNotNull())).alias(Q.PROBLEM))

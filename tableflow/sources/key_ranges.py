"""Balanced, disjoint predicates that cover a table, for a parallel read by any key.

The source itself is asked for splitters: the values that begin each of n equal parts of
its rows in the key's order, with their counts. They follow the rows, so neither an
outlier nor an uneven spread leaves the rows to one query, and text and dates are cut like
numbers. A value with more rows than a part holds cannot be cut by its key: it becomes a
part of its own, and is dealt into classes of a row hash where the source has one. A table
without a key is dealt into such classes whole.

Only splitters (a few for each part) reach the driver.
"""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow import spec as S
from tableflow.sources import database as DB

#: class of a row, from 0 to n - 1, by the address that a source gives it
ROW_CLASS = "ORA_HASH(ROWID, {n} - 1)"
#: rank error of a quantile is the rows over this
ACCURACY = 10_000

#: types whose values can be written as literals and whose order the source and we agree to be its own
_RANGED = (T.IntegralType, T.DecimalType, T.FractionalType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)


def can_range(kind: T.DataType) -> bool:
    """Can a key of this type be cut into ranges?"""
    return isinstance(kind, _RANGED)


def literal(value) -> str:
    """A value as a literal of standard SQL."""
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, dt.date):
        return f"DATE '{value:%Y-%m-%d}'"
    if isinstance(value, float):
        return repr(value) if "e" in repr(value) else f"{value!r}e0"
    if isinstance(value, int | Decimal) and not isinstance(value, bool):
        return f"{value:f}" if isinstance(value, Decimal) else str(value)
    raise ValueError(f"a key range cannot begin with {value!r}")


def splitter_query(table: str, key: str, partitions: int) -> str:
    """A subquery for the source: for each of ``partitions`` equal parts of the rows in key order, the first key and the rows."""
    return (f"(SELECT part, min({key}) AS lo, max({key}) AS hi, count(*) AS n FROM (SELECT {key}, ntile({int(partitions)})"
            f" OVER (ORDER BY {key}) AS part FROM {table} WHERE {key} IS NOT NULL) t GROUP BY part) e")


def range_predicates(key: str, parts, partitions: int, row_class: str | None = None) -> list[str]:
    """Predicates of ranges of the key, every row (nulls too) under exactly one.

    ``parts`` are (first key, last key, rows) of consecutive parts in key order, as
    :func:`splitter_query` gives them. A value whose whole parts hold an even share or more
    is taken by its own predicate, or by one for each share where ``row_class`` tells
    rows of one value apart. A range holds at most the rows of two parts. The first has no
    lower bound and the last no upper one, so rows that came since are read too.
    """
    parts = [p for p in parts if p[0] is not None and not (isinstance(p[0], float) and not math.isfinite(p[0]))]
    share = sum(n for *_, n in parts) / partitions
    filled, goes_on = {}, set()
    for lo, hi, n in parts:
        if lo == hi:
            filled[lo] = filled.get(lo, 0) + n
        else:
            goes_on.add(lo)
    preds, lower, joined = [], None, True

    def close(upper: str | None) -> None:
        ends = [e for e in (lower, upper) if e]
        text = " AND ".join(ends) or "1 = 1"
        preds.append(text if lower or not ends else f"{text} OR {key} IS NULL")

    for lo in dict.fromkeys(p[0] for p in parts):
        value, shares = literal(lo), int(filled.get(lo, 0) / share)
        if shares and filled[lo] > 1:
            close(f"{key} < {value}")
            own = f"{key} = {value}"
            preds += [f"{own} AND {c}" for c in hash_predicates(row_class, shares + 1)] if row_class else [own]
            # rows of the part that follow the value stand alone; where there are none, the next part joins
            lower, joined = f"{key} > {value}", lo not in goes_on
        elif joined:
            joined = False
        else:
            close(f"{key} < {value}")
            lower = f"{key} >= {value}"
    close(None)
    return preds


def hash_predicates(row_class: str, classes: int) -> list[str]:
    """Predicates of the classes of a row's hash; ``row_class`` is SQL with the number of classes as ``{n}``."""
    return [f"{row_class.format(n=int(classes))} = {i}" for i in range(int(classes))]


def frame_parts(df: DataFrame, key: str, partitions: int) -> list[tuple]:
    """What :func:`splitter_query` asks of a source, of rows that Spark holds: (first key, last key, rows) of about equal parts.

    Quantiles of a mergeable sketch, then one aggregate of counts: no row is sorted. For
    numbers, dates and timestamps.
    """
    k = F.col(key)
    known = df.filter(k.isNotNull()).select(key)
    cuts = known.agg(F.percentile_approx(k, [i / partitions for i in range(partitions)], ACCURACY).alias("q")).first()["q"]
    if not cuts:
        return []
    cuts = sorted(set(cuts))
    # two zones a cut: its value, and what lies between it and the next
    zone = F.lit(0)
    for i, c in enumerate(cuts):
        zone = F.when(k == F.lit(c), 2 * i + 1).when(k > F.lit(c), 2 * i + 2).otherwise(zone)
    found = {r["zone"]: (r["lo"], r["hi"], r["n"]) for r in known.groupBy(zone.alias("zone")).agg(
        F.min(k).alias("lo"), F.max(k).alias("hi"), F.count(F.lit(1)).alias("n")).collect()}
    share, parts = sum(n for *_, n in found.values()) / partitions, [found[0]] if 0 in found else []
    for i in range(len(cuts)):
        at, after = found.get(2 * i + 1), found.get(2 * i + 2)
        if at and after and at[2] < share:
            parts.append((at[0], after[1], at[2] + after[2]))
        else:
            parts += [p for p in (at, after) if p]
    return parts


def read_predicates(spark: SparkSession, options: dict, predicates: list[str]) -> DataFrame:
    """One query of the source for each predicate."""
    rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=predicates, properties=rest)


def balanced_reader(spark: SparkSession, url: str, partitions: int = 8, row_class: str | None = ROW_CLASS,
                    load=DB.read_jdbc, read=read_predicates, **extra):
    """A reader for the extract phase, ``reader(table, key)``: about even queries whatever the key's type and spread.

    One query of the source plans the ranges of a key. A table without a key, or with one
    whose type has no ranges, is read by classes of ``row_class``; without that, whole.
    ``load`` takes (spark, options), ``read`` (spark, options, predicates).
    """
    whole = hash_predicates(row_class, partitions) if row_class and partitions > 1 else ["1 = 1"]

    def reader(table: str, key: str | None = None) -> DataFrame:
        predicates = whole
        if key and key != S.DEFAULT_KEY:
            parts = load(spark, DB.jdbc_options(url, splitter_query(table, key, partitions), **extra))
            if can_range(parts.schema["lo"].dataType):
                predicates = range_predicates(key, [(r["lo"], r["hi"], int(r["n"])) for r in parts.orderBy("part").collect()],
                                              partitions, row_class)
        return read(spark, DB.jdbc_options(url, table, **extra), predicates)

    return reader

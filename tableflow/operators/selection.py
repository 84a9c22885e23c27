"""The first n rows of an order, found by counting.

Which value the n-th row has is found by narrowing: two quantiles of a mergeable sketch
(an error in ranks, so no outlier and no uneven spread of values spoils it) enclose the
n-th value, exact counts check it, and the rows between them are the next round's. Every
round is two partial aggregates over the rows and leaves a small share of them, whatever
their values; rows below the enclosure pass by a plain filter. Only a bounded rest is
ever ranked in one task.
"""

from __future__ import annotations

from decimal import ROUND_FLOOR, Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: rank error of a quantile is the rows over this
ACCURACY = 2_000
#: most rows that one task ranks
RANKED = 50_000

_ORDERED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _nth(rows: DataFrame, o: Column, n: int, ranked: int) -> tuple:
    """(value, rows below it, None) of the n-th of ``rows``, none of which is null; or (lower, rows below it, upper):
    at most ``ranked`` rows lie from ``lower`` to ``upper``, the n-th among them."""
    ends = rows.agg(F.count(F.lit(1)).alias("n"), F.min(o).alias("lo"), F.max(o).alias("hi")).first()
    total, lo, hi, below, middle = ends["n"], ends["lo"], ends["hi"], 0, None
    while True:
        if lo == hi:
            return lo, below, None
        if total <= ranked:
            return lo, below, hi
        inside, share = rows.filter(o.between(F.lit(lo), F.lit(hi))), (n - below) / total
        near = [max(0.0, share - 2 / ACCURACY), min(1.0, share + 2 / ACCURACY)]
        pivots = [middle, middle] if middle is not None else inside.agg(F.percentile_approx(o, near, ACCURACY).alias("q")).first()["q"]
        a, b = map(F.lit, pivots)
        # the two values and the three zones that they leave, in order
        zones = [o < a, o == a, (o > a) & (o < b), (o == b) & (a < b), o > b]
        aggs = [f(F.when(z, o)).alias(f"{name}{i}") for i, z in enumerate(zones) for name, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]
        found = inside.agg(*aggs).first()
        for i in range(5):
            if n - below <= found[f"n{i}"]:
                break
            below += found[f"n{i}"]
        stuck = found[f"n{i}"] == total
        total, lo, hi = found[f"n{i}"], found[f"lo{i}"], found[f"hi{i}"]
        middle = _middle(lo, hi) if stuck else None


def _middle(lo, hi):
    """Halves a range that quantiles do not cut: they are doubles, too coarse for long integers and decimals."""
    if isinstance(lo, Decimal):
        return (lo + (hi - lo) / 2).quantize(lo, ROUND_FLOOR)
    return lo + (hi - lo) // 2 if isinstance(lo, int) else lo


def _cut(rows: DataFrame, ordinal: str, n: int, ranked: int, ties) -> DataFrame:
    """The first ``n`` (one at least, not all) of ``rows`` without nulls; ``ties(rows, k)`` gives k of rows of one value."""
    o = F.col(ordinal)
    lo, below, hi = _nth(rows, o, n, ranked)
    whole = rows.filter(o < F.lit(lo))
    if hi is None:
        return whole.unionByName(ties(rows.filter(o == F.lit(lo)), n - below))
    rest = rows.filter(o.between(F.lit(lo), F.lit(hi))).withColumn("_tf_rank", F.row_number().over(Window.orderBy(ordinal)))
    return whole.unionByName(rest.filter(F.col("_tf_rank") <= n - below).drop("_tf_rank"))


def _tied(rows: DataFrame, n: int, ranked: int) -> DataFrame:
    """``n`` of rows that the order does not tell apart: the first by a hash of their content, and of equal ones any."""
    mark = rows.withColumn("_tf_tie", F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]))
    return _cut(mark, "_tf_tie", n, ranked, lambda equal, k: equal.limit(k)).drop("_tf_tie")


def first_n(df: DataFrame, n: int, ordinal: str, ranked: int = RANKED) -> DataFrame:
    """The first ``n`` records by ``ordinal`` (exact; null ordinals first; of ties some, chosen by their content).

    For an ordinal of numbers, dates or timestamps no task ranks more than ``ranked`` rows
    and the bounds are found when this is called, by a few small aggregates. An ordinal of
    another type is merged by a top-n, whose n rows meet in one task: for reports of a few
    rows.
    """
    if not isinstance(df.schema[ordinal].dataType, _ORDERED):
        return df.orderBy(F.col(ordinal)).limit(n)
    if n <= 0:
        return df.limit(0)
    o = F.col(ordinal)
    size = df.agg(F.count(F.lit(1)).alias("n"), F.count(o).alias("known")).first()
    if n >= size["n"]:
        return df
    empty = size["n"] - size["known"]
    if n <= empty:
        return _tied(df.filter(o.isNull()), n, ranked)
    cut = _cut(df.filter(o.isNotNull()), ordinal, n - empty, ranked, lambda equal, k: _tied(equal, k, ranked))
    return df.filter(o.isNull()).unionByName(cut)

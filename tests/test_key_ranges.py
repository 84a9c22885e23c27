"""Ranges of any key: every row once, and no query with much more than its share."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tableflow.sources import database as DB
from tableflow.sources import key_ranges as KR

ROWS = 4000
SPARK_CLASS = "pmod(xxhash64(id), {n})"


def keys():
    rng = random.Random(3)
    day, at = dt.date(2020, 1, 1), dt.datetime(2020, 1, 1, 0, 0, 0, 5)
    return {
        "text": ("string", [f"{rng.choice('abcxyz')}'{rng.randint(0, 999)}" for _ in range(ROWS)]),
        "dates": ("date", [day + dt.timedelta(int(rng.expovariate(0.02))) for _ in range(ROWS)]),
        "timestamps": ("timestamp", [at + dt.timedelta(microseconds=i * i) for i in range(ROWS)]),
        "outlier": ("bigint", [*range(ROWS - 2), 10 ** 15, -10 ** 17]),
        "decimals": ("decimal(20,4)", [Decimal(i * i) / 16 for i in range(ROWS)]),
        "doubles": ("double", [*[rng.gauss(0, 1) ** 9 for _ in range(ROWS - 5)], float("inf"), float("-inf"), float("nan"), 0.0, None]),
        "hot value": ("bigint", [7 if i % 3 == 0 else rng.randint(0, 50) for i in range(ROWS)]),
        "hot ends": ("string", ["a" if i % 3 == 0 else "z" if i % 3 == 1 else f"m{i}" for i in range(ROWS)]),
        "one value": ("int", [1] * ROWS),
        "nulls": ("int", [None if i % 9 == 0 else i for i in range(ROWS)]),
        "few": ("int", [5, 6, None]),
        "no rows": ("int", []),
        "only nulls": ("int", [None] * 20),
    }


def source(spark, kind, values):
    """A table that stands for the source: what it is asked runs as SQL, each predicate as a query of its own."""
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"k {kind}, id int").cache()
    df.createOrReplaceTempView("src")
    asked = []

    def load(session, options):
        asked.append(options["dbtable"])
        return session.sql(f"SELECT * FROM {options['dbtable']}")

    def read(session, options, predicates):
        asked.append(predicates)
        number = F.array(*[F.expr(p) for p in predicates])
        return df.withColumn("taken", number)

    return df, asked, load, read


def check(df, out, predicates, most):
    """Each row under one predicate; the rows of the largest one."""
    rows = [[i for i, t in enumerate(r["taken"]) if t] for r in out.collect()]
    assert all(len(r) == 1 for r in rows) and len(rows) == df.count()
    sizes = [sum(r[0] == i for r in rows) for i in range(len(predicates))]
    assert max(sizes, default=0) <= most, (sizes, predicates)


@pytest.mark.parametrize("name", keys())
def test_planned_by_the_source(spark, name):
    kind, values = keys()[name]
    df, asked, load, read = source(spark, kind, values)
    out = KR.balanced_reader(spark, "jdbc:none", 8, SPARK_CLASS, load, read)("src", "k")
    nulls = sum(v is None for v in values)
    check(df, out, asked[-1], 2 * len(values) / 8 + nulls + 60)
    assert asked[0].startswith("(SELECT part, min(k)") and len(asked) == 2 and len(asked[-1]) <= 28


def test_hot_value_without_a_row_hash(spark):
    kind, values = keys()["hot value"]
    df, asked, load, read = source(spark, kind, values)
    out = KR.balanced_reader(spark, "jdbc:none", 8, None, load, read)("src", "k")
    check(df, out, asked[-1], values.count(7))      # alone, but whole
    assert "k = 7" in asked[-1]


def test_no_key_and_keys_without_ranges(spark):
    df, asked, load, read = source(spark, "int", list(range(ROWS)))
    for key in (None, "ROWID"):
        check(df, KR.balanced_reader(spark, "jdbc:none", 8, SPARK_CLASS, load, read)("src", key), asked[-1], ROWS / 8 * 1.3)
    assert KR.balanced_reader(spark, "jdbc:none", 8, None, load, read)("src") and asked[-1] == ["1 = 1"]
    df, asked, load, read = source(spark, "binary", [bytes([i % 250]) for i in range(ROWS)])
    check(df, KR.balanced_reader(spark, "jdbc:none", 8, SPARK_CLASS, load, read)("src", "k"), asked[-1], ROWS / 8 * 1.3)


@pytest.mark.parametrize("name", ["dates", "timestamps", "outlier", "decimals", "doubles", "hot value", "one value", "nulls", "few", "no rows", "only nulls"])
def test_planned_from_rows_that_spark_holds(spark, name):
    kind, values = keys()[name]
    df = source(spark, kind, values)[0]
    preds = KR.range_predicates("k", KR.frame_parts(df, "k", 8), 8, SPARK_CLASS)
    check(df, df.withColumn("taken", F.array(*[F.expr(p) for p in preds])), preds, 2 * len(values) / 8 + sum(v is None for v in values) + 60)
    assert DB.union_pages(df, preds).count() == df.count()


def test_literals():
    assert KR.literal("a'b") == "'a''b'" and KR.literal(dt.date(2024, 2, 1)) == "DATE '2024-02-01'"
    assert KR.literal(dt.datetime(2024, 2, 1, 3, 4, 5, 6)) == "TIMESTAMP '2024-02-01 03:04:05.000006'"
    assert KR.literal(Decimal("1E+3")) == "1000" and KR.literal(1e300) == "1e+300" and KR.literal(2.5) == "2.5e0"
    with pytest.raises(ValueError):
        KR.literal(True)

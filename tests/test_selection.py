"""The first n rows, whatever the spread of their order's values."""

import random

import pytest
from pyspark.sql import functions as F

from tableflow.operators import selection as SEL
from tableflow.sources import database as DB


def frame(spark, values, kind="bigint"):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"o {kind}, id int").repartition(4)


def spreads():
    rng = random.Random(1)
    return {"even": list(range(3000)), "outlier": [*range(3000), 10 ** 15, -10 ** 17], "two values": [1] * 2000 + [2] * 1500,
            "one value": [7] * 3000, "steps": [2 ** (i % 60) for i in range(3000)], "long": [2 ** 62 + k for k in range(3000)], "heavy middle": [0] * 100 + [5] * 2500 + list(range(6, 900)),
            "nulls": [None] * 700 + [rng.randint(-50, 50) for _ in range(2500)]}


@pytest.mark.parametrize("name", spreads())
def test_first_n_and_the_rows_that_one_task_ranks(spark, name):
    values = spreads()[name]
    df, ranked = frame(spark, values).cache(), 300
    ordered = sorted(values, key=lambda v: (v is not None, v or 0))
    for n in (650, 2900):
        out = SEL.first_n(df, n, "o", ranked=ranked).collect()
        assert sorted((r["o"] for r in out), key=lambda v: (v is not None, v or 0)) == ordered[:n], n
        assert len({r["id"] for r in out}) == n
        lo, below, hi = SEL._nth(df.filter("o IS NOT NULL"), F.col("o"), max(1, n - values.count(None)), ranked)
        if hi is not None:
            assert df.filter(F.col("o").between(lo, hi)).count() <= ranked


def test_equal_rows_and_edges(spark):
    df = spark.createDataFrame([(1, "a")] * 50 + [(2, "b")] * 3, "o int, v string")
    assert SEL.first_n(df, 20, "o", ranked=5).count() == 20
    assert SEL.first_n(df, 51, "o", ranked=5).groupBy("o").count().orderBy("o").collect() == [(1, 50), (2, 1)]
    assert SEL.first_n(df, 0, "o").count() == 0 and SEL.first_n(df, 99, "o").count() == 53
    assert SEL.first_n(df.limit(0), 3, "o").count() == 0
    assert [r["v"] for r in SEL.first_n(df, 1, "v").collect()] == ["a"]


def test_other_types(spark):
    days = spark.range(2000).selectExpr("date_add(DATE '2020-01-01', CAST(id * id % 5000 AS INT)) AS o", "id")
    want = sorted(r["o"] for r in days.collect())[:700]
    assert sorted(r["o"] for r in SEL.first_n(days, 700, "o", ranked=100).collect()) == want
    floats = spark.createDataFrame([(float(v),) for v in [*range(500), "inf", "-inf"]] + [(1e300,)], "o double")
    assert SEL.first_n(floats, 3, "o", ranked=10).agg(F.sum("o")).first()[0] == float("-inf")
    assert SEL.first_n(floats, 502, "o", ranked=10).agg(F.max("o")).first()[0] == 1e300


def test_pages_with_an_outlier(spark):
    df = frame(spark, [10 ** 15, *range(0, 30_000, 3)])
    assert sorted(r["o"] for r in DB.page_slice(df, "o", 3, 1000, narrow=True).collect()) == list(range(9000, 12_000, 3))

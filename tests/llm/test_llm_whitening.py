import math
import random

import numpy as np
import pytest

from tableflow.llm import whitening as W

EXTRA = "x string, d string, u string, i string, n string"


def frame(spark, vectors, kind="float"):
    rows = [(i, v, *[None] * 5) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, {EXTRA}")


def brute(vectors, d):
    """x by row, distinct x, sums and scatter in Python integers."""
    xs = {}
    for i, v in enumerate(vectors):
        if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v):
            xs[i] = tuple(math.floor(64 * float(c)) + 1_000_000 for c in v)
    fit = sorted(set(xs.values()))
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    v = [[(n * sum(x[i] * x[j] for x in fit) - s[i] * s[j]) / n ** 2 for j in range(d)] for i in range(d)]
    return xs, n, s, np.array(v)


def check(spark, vectors, d, kind="float", tol=1e-9):
    xs, n, s, v = brute(vectors, d)
    got = W.whiten(frame(spark, vectors, kind)).collect()
    k = min(16, d)
    assert sorted((r["vec_id"], r["component"]) for r in got) == sorted((i, c) for i in xs for c in range(1, k + 1))
    values, vectors_ = np.linalg.eigh(v)
    values, vectors_ = values[::-1], vectors_[:, ::-1]
    by = {(r["vec_id"], r["component"]): r for r in got}
    sign = {}
    for (i, c), r in by.items():
        diff = [n * a - b for a, b in zip(xs[i], s)]
        length = sum(a * a for a in diff)
        assert r["n"] == n and r["deviation"] == (length if length < 1 << 63 else None)
        e = values[c - 1]
        if e <= 1e-13 * np.trace(v):
            assert r["whitened"] == 0 and r["explained"] == 0
            continue
        assert r["explained"] == pytest.approx(e / np.trace(v), rel=1e-6) and r["identity_error"] <= 1e-4
        expected = float(np.array([float(a) / n for a in diff]) @ vectors_[:, c - 1] / math.sqrt(e))
        if c not in sign and abs(expected) > 1e-6:
            sign[c] = 1 if expected * r["whitened"] > 0 else -1
        assert r["whitened"] * sign.get(c, 1) == pytest.approx(expected, abs=tol, rel=1e-6)
    assert len({r["identity_error"] for r in got}) <= 1
    return by


def test_bit_sliced_products_are_exact():
    rng = random.Random(1)
    u = np.array([[rng.getrandbits(b) for b in (1, 7, 63, 0)] for _ in range(131)], dtype=np.uint64)
    scatter = W.Scatter([1, 7, 63, 0])
    scatter.add(u[:70])
    scatter.add(u[70:])
    batch = scatter.rows().to_pydict()
    found = {}
    for i, j, s, n in zip(batch["i"], batch["j"], batch["s"], batch["n"]):
        found[(i, j)] = found.get((i, j), 0) + (n << s)
    columns = [[int(a) for a in c] for c in u.T] + [[1] * 131]
    for i in range(5):
        for j in range(i, 5):
            assert found.get((i, j), 0) == sum(a * b for a, b in zip(columns[i], columns[j]))


def test_vectors(spark):
    rng = random.Random(2)
    base = [[rng.gauss(0, 1 + j / 4) for j in range(20)] for _ in range(300)]
    nasty = [None, [], [1.0] * 19, [float("nan")] * 20, [1.0] * 19 + [None], [float("inf")] + [0.0] * 19, [float("-inf")] * 20]
    check(spark, base + nasty + base[:50] + [base[0]] * 500, 20)


def test_more_dimensions_than_vectors(spark):
    rng = random.Random(3)
    check(spark, [[rng.gauss(0, 3) for _ in range(18)] for _ in range(6)], 18, tol=1e-6)


def test_few_dimensions_ties_and_one_vector(spark):
    check(spark, [[1.0, 2.0], [3.0, 5.0], [1.0, 2.001], [-4.5, 9.0]], 2)
    by = check(spark, [[0.5, 0.25, -1.0]] * 3, 3)
    assert {r["whitened"] for r in by.values()} == {0.0} and {r["deviation"] for r in by.values()} == {0}


def test_huge_entries(spark):
    check(spark, [[1e12, 0.0], [-3e12, 5.0], [2e12, 7.0], [4.0, 1.0]], 2, kind="double", tol=1e-6)
    far = W.whiten(frame(spark, [[1e300, 0.0], [-1e300, 5.0], [3.0, 1.0]], "double")).collect()
    assert len(far) == 6 and all(math.isfinite(r["whitened"]) for r in far)


def test_no_rows(spark):
    assert W.whiten(frame(spark, [])).collect() == []
    assert W.whiten(frame(spark, [None, [], [None]])).collect() == []


def test_whole_table(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = W.whiten(df)
    assert got.count() == 16 * df.where("embedding IS NOT NULL").count()
    assert got.first()["identity_error"] <= 1e-4

r"""Whitening of embeddings by a bit-sliced scatter matrix.

Every entry becomes an integer, so the scatter matrix has an exact value, and it is found
exactly: the shifted entries ``u = x - least`` of a dimension are cut into bit planes, each
plane packed across rows into 64-bit words, and

    sum over rows of u_i * u_j = sum over planes p, q of 2^(p+q) * popcount(plane_ip AND plane_jq).

Counts of (i, j, p + q) are added up by Spark as integers; the driver, which gets a number
of counts that only the dimensions decide, weighs and centres them as integers
(``n * sum(u_i u_j) - sum(u_i) * sum(u_j)``) before one ``eigh``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.common import arrow_batches, written

#: fixed values of the contract: x = floor(SCALE * c) + OFFSET
SCALE, OFFSET = 64, 1_000_000
#: entries beyond this many units are taken as this many (a bigint holds no more)
MOST = float(1 << 62)
COMPONENTS = 16
#: rows whose bit planes are packed at once
ROWS = 8192
#: eigenvalues below this share of the largest are taken for zero
FLAT = 1e-13


def integers(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id``, ``x``: the valid rows, their entries as integers.

    A row is valid if its vector is there, is not empty and holds no null, NaN or infinite
    entry.
    """
    e = F.col(vec_col)
    fine = F.forall(e, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = df.where(e.isNotNull() & (F.size(e) > 0) & F.coalesce(fine, F.lit(False)))
    units = F.transform(e, lambda c: F.greatest(F.least(F.floor(c.cast("double") * SCALE), F.lit(MOST)), F.lit(-MOST)))
    return rows.select(F.col(id_col).alias("vec_id"), F.transform(units, lambda u: u.cast("bigint") + OFFSET).alias("x"))


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """Rows of a list column of ``d`` entries each."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def bit_planes(u: np.ndarray, bits: list[int]) -> np.ndarray:
    """Planes of the columns of ``u`` (unsigned), column by column and low bits first; rows are packed into 64-bit words."""
    n = len(u)
    planes = np.zeros((sum(bits), -(-n // 64) * 8), np.uint8)
    at = 0
    for i, b in enumerate(bits):
        column = np.ascontiguousarray(u[:, i])
        for p in range(b):
            packed = np.packbits((column >> np.uint64(p)).astype(np.uint8) & 1)
            planes[at, :len(packed)] = packed
            at += 1
    return planes.view(np.uint64)


class Scatter:
    """Counts of common bits of every two planes, by dimensions and weight.

    ``counts[k, s]`` is for the k-th pair of ``pairs``; its planes weigh 2^s. The sum of a
    dimension is kept as its product with a dimension that is one everywhere.
    """

    def __init__(self, bits: list[int]) -> None:
        self.bits = [*bits, 1]
        d = len(self.bits)
        i, j = np.triu_indices(d)
        self.pairs = np.stack([i, j], 1)
        number = np.zeros((d, d), np.int64)
        number[i, j] = np.arange(len(i))
        owner = np.repeat(np.arange(d), self.bits)
        weight = np.concatenate([np.arange(b) for b in self.bits] or [np.zeros(0, int)])
        self.counts = np.zeros((len(i), 2 * max(self.bits) - 1), np.int64)
        self._cells = [(number[owner[a], owner[a:]], weight[a] + weight[a:], 1 + ((owner[a:] == owner[a]) & (weight[a:] != weight[a])))
                       for a in range(len(owner))]

    def add(self, u: np.ndarray) -> None:
        ones = np.ones((len(u), 1), np.uint64)
        planes = bit_planes(np.hstack([u, ones]), self.bits)
        for a, (pair, weight, times) in enumerate(self._cells):
            common = np.bitwise_count(planes[a] & planes[a:]).sum(1, dtype=np.int64)
            np.add.at(self.counts, (pair, weight), common * times)

    def rows(self) -> pa.RecordBatch:
        k, s = np.nonzero(self.counts)
        return pa.record_batch([pa.array(self.pairs[k, 0], pa.int32()), pa.array(self.pairs[k, 1], pa.int32()), pa.array(s, pa.int32()),
                                pa.array(self.counts[k, s])], names=["i", "j", "s", "n"])


class Whitening:
    """What the fit list says: ``n``, exact sums ``total``, centred scatter, components of falling eigenvalue."""

    def __init__(self, n: int, least: list[int], products: dict[tuple[int, int], int]) -> None:
        d = self.d = len(least)
        self.n = n
        shifted = [products.get((i, d), 0) for i in range(d)]
        self.total = [t + n * low for t, low in zip(shifted, least)]
        centred = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                # integers of any size; their quotient is the double next to the exact covariance
                centred[i, j] = centred[j, i] = (n * products.get((i, j), 0) - shifted[i] * shifted[j]) / (n * n)
        values, vectors = np.linalg.eigh(centred)
        self.k = min(COMPONENTS, d)
        self.values = values[::-1][:self.k]
        self.vectors = vectors[:, ::-1][:, :self.k]
        trace = float(np.trace(centred))
        flat = self.values <= FLAT * max(trace, 0.0)
        scale = np.where(flat, 0.0, 1 / np.sqrt(np.where(flat, 1.0, self.values)))
        self.explained = np.where(flat, 0.0, self.values / trace if trace else 0.0)
        self.weights = self.vectors * scale
        self.used = int((~flat).sum())

    def differences(self, x: np.ndarray) -> np.ndarray:
        """n * x - total, exactly: bigint where it fits, else Python integers."""
        most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * self.n + max(map(abs, self.total))
        if most < 1 << 62:
            return x * np.int64(self.n) - np.array(self.total, np.int64)
        return x.astype(object) * self.n - np.array(self.total, object)

    def whitened(self, differences: np.ndarray) -> np.ndarray:
        return (differences / self.n).astype(np.float64) @ self.weights

    def deviation(self, differences: np.ndarray) -> list[int | None]:
        """Squared lengths; null where a bigint cannot hold one."""
        if differences.dtype != object:
            most = int(np.abs(differences).max(initial=0))
            if most * most * self.d < 1 << 63:
                return (differences * differences).sum(1).tolist()
        exact = (differences.astype(object) ** 2).sum(1)
        return [int(v) if v < 1 << 63 else None for v in exact]


def _chunks(batches, d: int):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, matrix(part.column(batch.schema.get_field_index("x")), d)


def _ranges(rows: DataFrame, d: int) -> tuple[list[int], list[int]]:
    """Least and greatest value of each dimension."""
    def run(batches):
        low = high = None
        for _, x in _chunks(batches, d):
            low = x.min(0) if low is None else np.minimum(low, x.min(0))
            high = x.max(0) if high is None else np.maximum(high, x.max(0))
        if low is not None:
            yield pa.record_batch([pa.array(np.arange(d), pa.int32()), pa.array(low), pa.array(high)], names=["i", "low", "high"])

    found = rows.mapInArrow(run, "i int, low bigint, high bigint").groupBy("i").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    by = {r["i"]: r for r in found.collect()}
    return [by[i]["low"] for i in range(d)], [by[i]["high"] for i in range(d)]


def fit(fit_list: DataFrame, d: int) -> Whitening | None:
    """The whitening of the distinct vectors ``x`` of ``d`` entries; None without any.

    The driver gets d^2 / 2 pairs of dimensions times at most 127 weights, whatever the
    number of rows.
    """
    fit_list = fit_list.where(F.size("x") == d)
    n = fit_list.count()
    if not n:
        return None
    least, most = _ranges(fit_list, d)
    bits = [(high - low).bit_length() for low, high in zip(least, most)]

    def run(batches):
        scatter = Scatter(bits)
        for _, x in _chunks(batches, d):
            scatter.add(x.view(np.uint64) - np.array(least, np.int64).view(np.uint64))
        yield scatter.rows()

    counts = (fit_list.select("x").mapInArrow(run, "i int, j int, s int, n bigint")
              .groupBy("i", "j", "s").agg(F.sum("n").alias("n")))
    products: dict[tuple[int, int], int] = {}
    for r in counts.collect():
        products[(r["i"], r["j"])] = products.get((r["i"], r["j"]), 0) + (r["n"] << r["s"])
    return Whitening(n, least, products)


def identity_error(fit_list: DataFrame, w: Whitening) -> float:
    """Largest absolute entry of (covariance of the whitened fit list - identity), over components of positive eigenvalue.

    Measured on the whitened vectors themselves, by one pass of partial sums.
    """
    k, d = w.used, w.d
    if not k:
        return 0.0

    def run(batches):
        products, sums = np.zeros((k, k)), np.zeros(k)
        for _, x in _chunks(batches, d):
            y = w.whitened(w.differences(x))[:, :k]
            products += y.T @ y
            sums += y.sum(0)
        yield pa.record_batch([pa.array(np.arange(k * k + k), pa.int32()), pa.array(np.concatenate([products.ravel(), sums]))], names=["i", "v"])

    found = fit_list.where(F.size("x") == d).select("x").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    v = np.zeros(k * k + k)
    for r in found:
        v[r["i"]] = r["v"]
    mean = v[k * k:] / w.n
    return float(np.abs(v[:k * k].reshape(k, k) / w.n - np.outer(mean, mean) - np.eye(k)).max())


SCHEMA = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id_col``, ``component`` (1, 2, ...), ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    For every valid row (:func:`integers`) and each of the first 16 components (fewer if
    vectors have fewer dimensions). Rows whose vector is null, empty or holds a null, NaN
    or infinite entry are left out. Vectors of different lengths have nothing in common,
    so only those of the most frequent length (of the longest such) count; the others are
    left out as invalid. The fit list has each distinct integer vector once, so copies
    change nothing; repeated rows give repeated results; a null id stays null. Where an
    eigenvalue is zero (fewer distinct vectors than dimensions), ``whitened`` and
    ``explained`` are 0 and the component is not part of ``identity_error``.
    ``deviation`` is null where a bigint cannot hold it; entries beyond 2^62 units are
    taken as that. No valid rows give no rows. Other columns are ignored, whatever their
    names.

    Copies fall together before the one shuffle, by partial aggregation.
    """
    spark = df.sparkSession
    arrow_batches(spark)
    rows = integers(df, id_col, vec_col)
    out = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, {SCHEMA}"
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], out)
    d = lengths[0]["d"]
    rows = rows.where(F.size("x") == d)
    fit_list = written(rows.select("x").distinct(), "whitening_fit")
    w = fit(fit_list, d)
    error, k = identity_error(fit_list, w), w.k

    def run(batches):
        for part, x in _chunks(batches, d):
            differences = w.differences(x)
            m = len(x)
            yield pa.record_batch([
                part.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                pa.array(np.full(m * k, w.n)), pa.array(w.deviation(differences), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(w.whitened(differences).ravel()), pa.array(np.tile(w.explained, m)), pa.array(np.full(m * k, error))],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, out)

"""Benchmark decontamination by winnowing.

Both sides keep the minimum k-gram hash of every sliding window of k-grams. With k = 5
and windows of 6 k-grams, any shared span of 10 words holds a k-gram that both sides
kept, so joining the kept fingerprints loses no shared span; each joined pair is then
extended word by word and counts if the match reaches a whole window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm import words as W
from tableflow.llm.common import arrow_batches, hash_bitmap, in_bitmap, in_place, row_key, signed, written

#: fills context beyond a row's ends; the sides differ, so they never match
_OUTSIDE = {"doc": np.uint64(1), "item": np.uint64(2)}

PRINTS = "key binary, doc_id string, n_words bigint, fp bigint, length int, pos bigint, context binary"


def _kept(h: np.ndarray, row: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """k-gram hashes, and the positions that winnowing keeps in rows of a window's words at least."""
    g, w = W.grams(h, k), window - k + 1
    whole = W.inside_rows(row, window)
    if not len(whole):
        return g, np.zeros(0, np.int64)
    low = W.sliding(g, w, np.minimum)[:len(whole)]
    low = np.where(whole, low, np.uint64(0))
    # a k-gram is kept if it is the minimum of any window it lies in
    high = W.sliding(np.concatenate([np.zeros(w - 1, np.uint64), low, np.zeros(w - 1, np.uint64)]), w, np.maximum)
    high = high[:len(g)]
    return g, np.flatnonzero((high == g[:len(high)]) & (high > 0))


def _contexts(h: np.ndarray, row: np.ndarray, at: np.ndarray, before: int, total: int, outside: np.uint64) -> np.ndarray:
    """Word hashes around each position, as rows of a matrix."""
    owner = np.searchsorted(row, at, side="right") - 1
    idx = at[:, None] + np.arange(-before, total - before)[None, :]
    ok = (idx >= row[owner][:, None]) & (idx < row[owner + 1][:, None])
    return np.where(ok, h[np.clip(idx, 0, max(len(h) - 1, 0))] if len(h) else outside, outside)


def _prints(w: W.Words, k: int, window: int, shorts: list[int], side: str, keep=None):
    """(row, fp, length, position, context) of the fingerprints of each row."""
    h, out = w.hash, _OUTSIDE[side]
    total = 2 * window - k
    parts = []
    g, at = _kept(h, w.row, k, window)
    lengths = [(window, g, at)]
    for n in shorts:
        g = W.grams(h, n)
        inside = W.inside_rows(w.row, n)
        if side == "item":  # only items of exactly n words
            first = w.row[:-1][w.counts == n]
            lengths.append((n, g, first))
        else:
            lengths.append((n, g, np.flatnonzero(inside)))
    for n, g, at in lengths:
        fp = g[at]
        if keep is not None:
            at = at[keep(fp)]
            fp = g[at]
        if n == window:
            ctx = _contexts(h, w.row, at, window - k, total, out)
        else:
            ctx = np.zeros((len(at), total), np.uint64)
            ctx[:, :n] = _contexts(h, w.row, at, 0, n, out)
        owner = np.searchsorted(w.row, at, side="right") - 1
        parts.append((owner, fp, np.full(len(at), n, np.int32), at - w.row[owner], ctx))
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def _binary(matrix: np.ndarray) -> pa.Array:
    width = matrix.shape[1] * 8
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(matrix), [None, pa.py_buffer(
        np.ascontiguousarray(matrix))]).cast(pa.binary())


def _scan(side: str, k: int, window: int, shorts: list[int], bits: int = 0, found=None):
    """mapInArrow function: a base row for each document (length -1), and the fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = None if found is None else (lambda fp: in_bitmap(found.value, bits, fp))
        for b in W.passes(batches, "text"):
            w = W.Words(b.column(2), W.ALNUM_WORDS, lower=True)
            owner, fp, length, pos, ctx = _prints(w, k, window, shorts, side, keep)
            names = ["key", "doc_id", "n_words", "fp", "length", "pos", "context"]
            take = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), b.column(1).take(take), pa.array(w.counts[owner], pa.int64()),
                 pa.array(signed(fp)), pa.array(length), pa.array(pos, pa.int64()), _binary(ctx)], names)
            if side == "doc":
                n = b.num_rows
                heads = np.frombuffer(b"".join(x[:8] for x in b.column(0).to_pylist()), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(w.counts, pa.int64()), pa.array(heads),
                     pa.array(np.full(n, -1, np.int32)), pa.array(np.full(n, -1, np.int64)),
                     pa.nulls(n, pa.binary())], names)

    return run


def _extend(k: int, window: int):
    """mapInArrow function: the words that match around each joined fingerprint."""
    side = window - k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hits = b.filter(pa.compute.is_valid(b.column(6)))
            spans_from = np.zeros(0, np.int64)
            spans_to = np.zeros(0, np.int64)
            if hits.num_rows:
                doc = np.frombuffer(b"".join(hits.column(5).to_pylist()), np.uint64).reshape(hits.num_rows, -1)
                item = np.frombuffer(b"".join(hits.column(6).to_pylist()), np.uint64).reshape(hits.num_rows, -1)
                length, pos = hits.column(3).to_numpy(), hits.column(4).to_numpy()
                same = doc == item
                left = np.cumprod(same[:, :side][:, ::-1], axis=1).sum(axis=1)
                right = np.cumprod(same[:, side + k:], axis=1).sum(axis=1)
                core = same[:, side:side + k].all(axis=1)
                long = core & (left + k + right >= window)
                ok = np.where(length == window, long, same.all(axis=1))
                spans_from = np.where(length == window, pos - left, pos)[ok]
                spans_to = np.where(length == window, pos + k + right, pos + length)[ok]
                hits = hits.filter(pa.array(ok))
            names = ["key", "doc_id", "n_words", "base", "start", "end", "items"]
            yield pa.RecordBatch.from_arrays(
                [hits.column(0), hits.column(1), hits.column(2), pa.nulls(hits.num_rows, pa.int64()).fill_null(0),
                 pa.array(spans_from), pa.array(spans_to), hits.column(7)], names)
            base = b.filter(pa.compute.equal(b.column(3), -1))
            n = base.num_rows
            yield pa.RecordBatch.from_arrays(
                [base.column(0), base.column(1), base.column(2), pa.array(np.ones(n, np.int64)),
                 pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, b.column(7).type)], names)

    return run


def hits_by_key(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_id: str, item_text: str, window: int,
                gram: int, bits: int) -> DataFrame:
    """(key, doc_id, n_words, copies, spans, items): a row for each distinct (id, text)."""
    arrow_batches(docs.sparkSession)
    source = items.select(F.lit(None).cast("binary").alias("key"), F.col(item_id).cast("string").alias("doc_id"),
                          F.col(item_text).alias("text"))
    counted = source.mapInArrow(_scan_counts, "n int").filter(F.col("n").between(1, window - 1)).distinct()
    shorts = sorted(r["n"] for r in counted.collect())  # fewer than `window` values
    prints = (source.mapInArrow(_scan("item", gram, window, shorts), PRINTS)
              .groupBy("fp", "length", "context").agg(F.collect_set("doc_id").alias("items")))
    found = hash_bitmap(prints, "fp", bits)
    base = docs.select(row_key(id_col, text_col).alias("key"), F.col(id_col).cast("string").alias("doc_id"),
                       F.col(text_col).alias("text"))
    kept = base.mapInArrow(_scan("doc", gram, window, shorts, bits, found), PRINTS)
    joined = kept.join(prints.withColumnRenamed("context", "item_context"), ["fp", "length"], "left")
    spans = joined.select("key", "doc_id", "n_words", "length", "pos", "context", "item_context", "items").mapInArrow(
        _extend(gram, window),
        "key binary, doc_id string, n_words bigint, base bigint, start bigint, end bigint, items array<string>")
    return spans.groupBy("key").agg(
        F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.sum("base").alias("copies"),
        F.array_sort(F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", "end")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))

def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = 10, gram: int = 5,
                  bits: int = 1 << 24) -> DataFrame:
    """Words of each document that lie in a window of an item.

    Returns a row for each input row: the id, ``n_words``, ``spans`` (array of word
    ranges start, end; end exclusive; disjoint or touching, in order), ``n_hit`` (words
    in spans) and ``items`` (ids of the items with a window there, as text, sorted).

    A window is ``window`` consecutive item words; an item of fewer words is one window,
    looked up among all runs of that many words. Null and empty texts have no words and
    no hits; a null item id marks words but names no item; repeated items count once by
    id; repeated documents each get their row; an empty item table hits nothing. Other
    columns are ignored, whatever their names.

    Scale: documents are filtered by a bitmap of ``bits`` bits of the item fingerprints
    (fixed size; false positives only cost a shuffled row), what is left carries its
    context of ``2 * window - gram`` word hashes through one join. No document text is
    shuffled, and no item table is broadcast by this code.
    """
    rows = hits_by_key(docs, items, id_col, text_col, item_id, item_text, window, gram, bits)
    # ordered spans: how many words each adds beyond what the ones before it reach
    hit = F.aggregate("spans", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("to")),
                      lambda a, s: F.struct(
                          (a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["to"]), F.lit(0))).alias("n"),
                          F.greatest(a["to"], s["end"]).alias("to")), lambda a: a["n"])
    id_type = docs.schema[id_col].dataType
    return (rows.withColumn("n_hit", hit)
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
            .select(F.col("doc_id").cast(id_type).alias(id_col), "n_words", "n_hit", "spans", "items"))


def _scan_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in W.passes(batches, "text"):
        w = W.Words(b.column(2), W.ALNUM_WORDS, lower=True)
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(w.counts, 1 << 30).astype(np.int32))], ["n"])


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_id: str = "item_id", item_text: str = "text", window: int = 10, gram: int = 5,
                      bits: int = 1 << 24) -> DataFrame:
    """The rows of ``docs`` that no window of an item hits, with all their columns.

    Rows whose key is not in a bitmap of the hit rows' keys pass where they are read; the
    few others meet the hit keys in a join.
    """
    hit = written(hits_by_key(docs, items, id_col, text_col, item_id, item_text, window, gram, bits)
                  .filter(F.size("spans") > 0).select(F.col("key").alias("row_key")), "contaminated")
    found = hash_bitmap(hit.select(F.xxhash64("row_key").alias("h")), "h", bits)
    names = docs.columns
    rows = docs.select(row_key(id_col, text_col).alias("row_key"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    h = F.xxhash64("row_key")
    clean = in_place(rows, found, bits, h, has=False)
    rest = in_place(rows, found, bits, h, has=True).join(hit, "row_key", "left_anti")
    return clean.unionByName(rest).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Query rows: one digest row per document."""
    r = decontaminate(docs, items)
    return r.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"))

"""Quality rules: fixed counts of a text, and a hashed n-gram logistic regression.

The model is trained on a bounded sample of labelled rows, one head for quality and one
for toxicity, each calibrated on rows held out from its training; texts are then scored
in Arrow batches against fixed thresholds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.llm import words as W
from tableflow.llm.common import arrow_batches

#: fixed values: base rules
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

BITS = 18
#: labelled rows that training takes at most
SAMPLE_ROWS = 8_000
#: verdict thresholds on the calibrated probabilities
LEAST_QUALITY = 0.5
MOST_TOXIC = 0.5
HEADS = ("quality", "toxic")


# --- features -----------------------------------------------------------------

def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of every word and character n-gram, repeats included.

    Lower-cased words, their first 3, 4 and 5 bytes, and every 3 bytes as written that
    hold no white space.
    """
    w = W.Words(column, W.ALNUM_WORDS, lower=True)
    rows, size = w.row_of(), w.end - w.start
    hashes, owner = [w.hash], [rows]
    for n in (3, 4, 5):
        of = np.flatnonzero(size >= n)
        hashes.append(W.mix(W.span_hash(w.data, w.start[of], w.start[of] + n) + np.uint64(n)))
        owner.append(rows[of])
    raw, offsets = W.string_buffer(column)
    if len(raw) >= 3:
        inside = W.BLANK_WORDS[raw]
        at = np.flatnonzero(inside[:-2] & inside[1:-1] & inside[2:])
        row = np.searchsorted(offsets, at, side="right") - 1
        ok = at + 3 <= offsets[row + 1]
        at, row = at[ok], row[ok]
        code = raw[at].astype(np.uint64) | raw[at + 1].astype(np.uint64) << np.uint64(8) \
            | raw[at + 2].astype(np.uint64) << np.uint64(16)
        hashes.append(W.mix(code + np.uint64(1 << 40)))
        owner.append(row)
    return np.concatenate(owner), (np.concatenate(hashes) >> np.uint64(64 - BITS)).astype(np.int64)


def _distinct(row: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique((row << BITS) | slot)
    return key >> BITS, key & ((1 << BITS) - 1)


# --- training -----------------------------------------------------------------

@dataclass
class Head:
    """One calibrated logistic regression: weights by slot, then sigmoid(a * margin + b)."""

    slots: np.ndarray
    weights: np.ndarray
    bias: float
    a: float = 1.0
    b: float = 0.0


@dataclass
class Model:
    heads: dict[str, Head] = field(default_factory=dict)

    def probabilities(self, column: pa.Array) -> dict[str, np.ndarray]:
        """Calibrated probability of each head for each text."""
        n = len(column)
        out = {}
        if not self.heads:
            return out
        row, slot = features(column)
        used = np.zeros(1 << BITS, bool)
        for h in self.heads.values():
            used[h.slots] = True
        some = used[slot]  # weights are sparse: repeats are taken out among these only
        row, slot = _distinct(row[some], slot[some])
        for name, h in self.heads.items():
            dense = np.zeros(1 << BITS)
            dense[h.slots] = h.weights
            margin = np.bincount(row, dense[slot], n) + h.bias
            out[name] = _sigmoid(h.a * margin + h.b)
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def fit(starts: np.ndarray, slots: np.ndarray, y: np.ndarray, epochs: int = 3, batch: int = 16, rate: float = 0.3,
        l1: float = 4.0, l2: float = 1.0) -> Head:
    """Follow-the-regularised-leader updates on presence features (CSR rows).

    The L1 term keeps slots that tell nothing at exactly zero, so a long neutral text
    gathers no noise.
    """
    n, last = len(y), 1 << BITS
    z, g2 = np.zeros(last + 1), np.zeros(last + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        w = -(z[at] - np.sign(z[at]) * l1) / ((1.0 + np.sqrt(g2[at])) / rate + l2)
        return np.where(np.abs(z[at]) <= l1, 0.0, w)

    def bias() -> float:
        return float(-z[last] / ((1.0 + np.sqrt(g2[last])) / rate))

    for _ in range(epochs):
        for s in range(0, n, batch):
            e = min(n, s + batch)
            idx = slots[starts[s]:starts[e]]
            row = np.repeat(np.arange(e - s), np.diff(starts[s:e + 1]))
            at, inverse = np.unique(idx, return_inverse=True)
            w, b = weights(at), bias()
            error = _sigmoid(np.bincount(row, w[inverse], e - s) + b) - y[s:e]
            g = np.bincount(inverse, error[row], len(at))
            sq = np.bincount(inverse, error[row] ** 2, len(at))
            z[at] += g - (np.sqrt(g2[at] + sq) - np.sqrt(g2[at])) / rate * w
            g2[at] += sq
            sq = float((error ** 2).sum())
            z[last] += error.sum() - (np.sqrt(g2[last] + sq) - np.sqrt(g2[last])) / rate * b
            g2[last] += sq
    w = weights(np.arange(last))
    found = np.flatnonzero(w)
    return Head(found, w[found], bias())


def calibrate(margin: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Platt scaling by Newton steps, with its smoothed targets; (1, 0) without both classes."""
    n1, n0 = float((y > 0).sum()), float((y <= 0).sum())
    if not n1 or not n0:
        return 1.0, 0.0
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = max(1.0, float(np.abs(margin).max()))
    x = np.stack([margin / scale, np.ones_like(margin)], axis=1)
    beta = np.array([scale, 0.0])
    for _ in range(steps):
        p = _sigmoid(x @ beta)
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (p - t))
        beta = beta - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    # never turn the margin's order round
    return (float(beta[0] / scale), float(beta[1])) if beta[0] > 0 else (1.0, 0.0)


_FEATURES = "id_hash bigint, quality int, toxic int, slots binary"
_HEAD = "head string, slots binary, weights binary, bias double, a double, b double"


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in W.passes(batches, "text"):
        row, slot = _distinct(*features(b.column(3)))
        edge = np.searchsorted(row, np.arange(b.num_rows + 1))
        raw = slot.astype("<i4").tobytes()
        packed = [raw[4 * x:4 * y] for x, y in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(packed, pa.binary())],
                                         ["id_hash", "quality", "toxic", "slots"])


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task: the sampled rows in hash order; every fifth is held out for calibration."""
    slots, labels = [], {k: [] for k in HEADS}
    for b in batches:
        slots += [np.frombuffer(x, "<i4") for x in b.column(3).to_pylist()]
        for i, k in enumerate(HEADS):
            labels[k] += b.column(1 + i).to_pylist()
    if not slots:
        return
    held = np.arange(len(slots)) % 5 == 4
    size = np.array([len(s) for s in slots])
    flat = np.concatenate(slots).astype(np.int64)
    owner = np.repeat(np.arange(len(slots)), size)
    starts = np.concatenate([[0], np.cumsum(size[~held])])
    train_flat = flat[~held[owner]]
    rows = []
    for k in HEADS:
        y = np.array(labels[k], float)
        head = fit(starts, train_flat, y[~held])
        dense = np.zeros(1 << BITS)
        dense[head.slots] = head.weights
        margin = np.bincount(owner, dense[flat], len(slots)) + head.bias
        a, b = calibrate(margin[held], y[held])
        rows.append({"head": k, "slots": head.slots.astype("<i4").tobytes(), "weights": head.weights.tobytes(),
                     "bias": head.bias, "a": a, "b": b})
    yield pa.RecordBatch.from_pylist(rows, pa.schema([
        ("head", pa.string()), ("slots", pa.binary()), ("weights", pa.binary()), ("bias", pa.float64()),
        ("a", pa.float64()), ("b", pa.float64())]))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          sample: int = SAMPLE_ROWS) -> Model:
    """Model of the labelled documents.

    At most ``sample`` labelled ids are used, those first by a hash of the id, so the
    sample is the same however the tables are laid out; training is one task over their
    features, bounded by that parameter. Labels with a null are left out; of repeated
    labels of an id the lowest quality and the highest toxicity count; of documents that
    share an id, one text. Without labelled documents the model has no heads and rejects
    nothing.
    """
    arrow_batches(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("id"), F.col("quality").cast("int").alias("quality"),
                          F.col("toxic").cast("int").alias("toxic")).dropna()
    chosen = (known.groupBy("id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
              .withColumn("id_hash", F.xxhash64("id")).orderBy("id_hash", "id").limit(sample))
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
             .join(F.broadcast(chosen), "id")
             .groupBy("id").agg(F.min("text").alias("text"), *[F.first(c).alias(c) for c in ("id_hash", *HEADS)]))
    rows = texts.select("id_hash", "quality", "toxic", "text").mapInArrow(_featurise, _FEATURES)
    heads = rows.repartition(1).sortWithinPartitions("id_hash").mapInArrow(_train, _HEAD).collect()
    return Model({h["head"]: Head(np.frombuffer(h["slots"], "<i4").astype(np.int64), np.frombuffer(h["weights"]),
                                  h["bias"], h["a"], h["b"]) for h in heads})


# --- measures -----------------------------------------------------------------

def _later_equal(row: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """For each row, how many of its values equal an earlier one of the row."""
    key = W.mix(h ^ W.mix(row.astype(np.uint64)))
    _, first = np.unique(key, return_index=True)
    return np.bincount(row, minlength=n) - np.bincount(row[first], minlength=n)


def measures(column: pa.Array) -> dict[str, np.ndarray]:
    """The base counts of each text."""
    w = W.Words(column, W.BLANK_WORDS, lower=False)
    n = len(w.row) - 1
    data, offsets = w.data, w.offsets
    inside = W.BLANK_WORDS[data]

    def per_row(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[offsets[1:]] - total[offsets[:-1]]

    table = np.zeros(256, bool)
    table[list(SYMBOLS)] = True
    out = {"n_words": w.counts, "word_chars": per_row(inside & ((data & 0xC0) != 0x80)), "n_symbols": per_row(table[data])}
    # lines: from a text's start or a line feed to the next
    feed = np.flatnonzero(data == 0x0A)
    start = np.sort(np.concatenate([offsets[:-1], feed + 1]))
    owner = np.searchsorted(offsets[1:], start, side="right")
    # a line feed that ends a text opens an empty line there: wordless, so it may go
    ok = owner < n
    start, owner = start[ok], owner[ok]
    stop = np.minimum(np.append(start[1:], len(data)), offsets[owner + 1])
    cut = (stop > start) & (data[np.maximum(stop - 1, 0)] == 0x0A) if len(data) else np.zeros(len(start), bool)
    end = stop - cut
    words_upto = np.concatenate([[0], np.cumsum(inside)])
    worded = words_upto[end] > words_upto[start]
    h = W.span_hash(data, start[worded], end[worded])
    out["n_dup_lines"] = _later_equal(owner[worded], h, n)
    # words in 3-word windows that the text has twice or more
    rows = w.row_of()
    repeated = np.zeros(len(rows), bool)
    of = np.flatnonzero(W.inside_rows(w.row, 3))
    if len(of):
        key = W.mix(W.grams(w.hash, 3)[of] ^ W.mix(rows[of].astype(np.uint64)))
        _, kind, count = np.unique(key, return_inverse=True, return_counts=True)
        twice = of[count[kind] > 1]
        for j in range(3):
            repeated[twice + j] = True
    out["n_repeat_words"] = np.bincount(rows[repeated], minlength=n)
    return out


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _judge(model, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = None
        m = model.value
        for b in batches:
            name = b.schema.names[text_at]
            for p in W.passes(iter([b]), name):
                text = p.column(text_at)
                x = measures(text)
                failed = (x["n_words"] < LEAST_WORDS) | (100 * x["n_repeat_words"] > MOST_REPEATED_PERCENT * x["n_words"])
                prob = m.probabilities(text)
                good = prob.get("quality", np.ones(p.num_rows))
                bad = prob.get("toxic", np.zeros(p.num_rows))
                kept = ~failed & (good >= LEAST_QUALITY) & (bad < MOST_TOXIC)
                yield pa.RecordBatch.from_arrays(
                    [*p.columns, *[pa.array(x[k].astype(np.int64)) for k in MEASURES], pa.array(failed), pa.array(good),
                     pa.array(bad), pa.array(kept)],
                    [*p.schema.names, *MEASURES, "base_failed", "quality", "toxic", "kept"])

    return run


def _judged(rows: DataFrame, model: Model, text_at: int) -> DataFrame:
    arrow_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(model)  # two sparse heads of 2**BITS slots at most
    added = [T.StructField(k, T.LongType()) for k in MEASURES]
    added += [T.StructField("base_failed", T.BooleanType()), T.StructField("quality", T.DoubleType()),
              T.StructField("toxic", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    return rows.mapInArrow(_judge(shared, text_at), T.StructType([*rows.schema.fields, *added]))


def judge(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the base counts, ``base_failed``, probabilities ``quality`` and ``toxic``, ``kept``.

    A null or empty text has no words, so it fails the base rules; repeated rows each
    get their verdict; an empty table gives none; other columns are ignored, whatever
    their names. One pass of map tasks over whole texts, no shuffle.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return _judged(rows, model, 1).drop("text").withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    names = docs.columns
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    return _judged(rows, model, names.index(text_col)).filter("kept").select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])


def quality_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Query rows: base counts and verdict of each document."""
    return judge(docs, train(docs, labels)).select("doc_id", *MEASURES, "base_failed", "kept", "quality", "toxic")

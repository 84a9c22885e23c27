"""Substring dedup by super-k-mer partitioning.

A window is a run of consecutive words. Its minimiser is its m-gram of lowest hash;
consecutive windows with the same minimising m-gram travel as one packed string to the
minimiser's bucket, where sorting the windows shows exactly which occur twice or more.
Equal windows have equal minimisers, so they always meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm import words as W
from tableflow.llm.common import bitmaps, hash_bitmap, in_bitmap, in_place, keyed, signed, slot, written

#: bits of a key that are the place, so that the leftmost of equal hashes is the minimum
_PLACE = 28


class Packs:
    """Super-k-mers of the texts of one column: words ``first`` to ``last + window`` of each run of windows.

    ``places``: the bucket of every place of a minimiser; a run has several if its text
    repeats the m-gram, and only then can windows of one run be equal.
    """

    def __init__(self, column: pa.Array, window: int, gram: int) -> None:
        self.words = w = W.Words(column, W.BLANK_WORDS, lower=False)
        none = np.zeros(0, np.int64)
        self.first, self.last, self.bucket = none, none, np.zeros(0, np.uint64)
        self.places = self.bucket
        valid = np.flatnonzero(W.inside_rows(w.row, window))
        if not len(valid):
            return
        g = W.grams(w.hash, gram)
        place = np.uint64((1 << _PLACE) - 1)
        key = (g & ~place) | np.arange(len(g), dtype=np.uint64)
        at = (W.sliding(key, window - gram + 1, np.minimum)[valid] & place).astype(np.int64)
        value = g[at]
        new = np.ones(len(valid), bool)
        new[1:] = (value[1:] != value[:-1]) | (valid[1:] != valid[:-1] + 1)
        moved = new.copy()
        moved[1:] |= at[1:] != at[:-1]
        self.places = value[moved]
        head = np.flatnonzero(new)
        self.first = valid[head]
        self.last = valid[np.append(head[1:], len(valid)) - 1]
        self.bucket = value[head]

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words joined by one space, and where each starts and ends there."""
        w = self.words
        size = w.end - w.start
        upto = np.cumsum(size + 1)
        start = upto - size - 1
        text = w.data[np.minimum(np.repeat(w.start - start, size + 1) + np.arange(int(upto[-1])), len(w.data) - 1)]
        text[upto - 1] = 0x20
        return text.tobytes(), start, start + size


def _buckets(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.passes(batches, "text"):
            bucket, n = np.unique(Packs(b.column(0), window, gram).places, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(signed(bucket)), pa.array(n.astype(np.int64))], ["bucket", "n"])

    return run


def _levels(shared, bits: int, buckets: np.ndarray) -> np.ndarray:
    """Level of each bucket's slot: 0 for one super-k-mer, 1 for a bucket of one task, more for hot ones."""
    level = np.zeros(len(buckets), np.int64)
    for k, plane in enumerate(shared.value):
        level |= in_bitmap(plane, bits, buckets).astype(np.int64) << k
    return level


def _packs(window: int, gram: int, bits: int, shared):
    """mapInArrow function: packed strings of buckets that may hold a repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.passes(batches, "text"):
            p = Packs(b.column(1), window, gram)
            use = np.flatnonzero(_levels(shared, bits, p.bucket) == 1)
            if not len(use):
                continue
            text, start, end = p.joined()
            first, last = p.first[use], p.last[use]
            row = np.searchsorted(p.words.row, first, side="right") - 1
            pack = [text[x:y] for x, y in zip(start[first].tolist(), end[last + window - 1].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(p.bucket[use])), pa.array(pack, pa.binary()), b.column(0).take(pa.array(row)),
                 pa.array(first - p.words.row[row])], ["bucket", "pack", "row_key", "start"])

    return run


def _hot_packs(window: int, gram: int, bits: int, shared):
    """mapInArrow function: windows of hot buckets, by 128-bit digests.

    A window that a pass holds twice is known to repeat: its word range goes out at once
    (part -1), with one digest as evidence for others. Only the others ask, with their
    places. So a window that very many texts share sends one row for each pass, not one
    for each text. A bucket is split by the hash of its windows into 4 ** (level - 1) parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.passes(batches, "text"):
            p = Packs(b.column(1), window, gram)
            level = _levels(shared, bits, p.bucket)
            use = np.flatnonzero(level > 1)
            if not len(use):
                continue
            text, start, end = p.joined()
            n = p.last[use] - p.first[use] + 1
            pack = np.repeat(use, n)
            at = np.repeat(p.first[use] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
            row = np.searchsorted(p.words.row, at, side="right") - 1
            raw = np.frombuffer(b"".join(hashlib.blake2b(text[x:y], digest_size=16).digest() for x, y in zip(
                start[at].tolist(), end[at + window - 1].tolist(), strict=True)), np.uint64).reshape(-1, 2)
            order = np.lexsort((raw[:, 1], raw[:, 0]))
            new = np.concatenate([[True], (raw[order][1:] != raw[order][:-1]).any(axis=1)])
            kind = np.cumsum(new) - 1
            count = np.bincount(kind)
            twice = np.zeros(len(at), bool)
            twice[order] = count[kind] > 1
            keys = b.column(0).to_pylist()
            out = []
            # word ranges that are known here
            known = np.unique(at[twice])
            if len(known):
                owner = np.searchsorted(p.words.row, known, side="right") - 1
                head = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (known[1:] > known[:-1] + window)]))
                ends = known[np.append(head[1:], len(known)) - 1] + window
                for r, x, z in zip(owner[head].tolist(), known[head].tolist(), ends.tolist(), strict=True):
                    span = np.array([x, z]) - p.words.row[r]
                    out.append((int.from_bytes(keys[r][:8], "little", signed=True), -1, keys[r], span.astype("<i4").tobytes(), None))
            # evidence of these, and questions about the others
            ask = np.flatnonzero(~twice)
            sent = np.concatenate([order[new & (count[kind] > 1)], ask])
            who = np.concatenate([np.full(len(sent) - len(ask), -1), row[ask]])
            parts = np.uint64(1) << (2 * (level[pack[sent]] - 1)).astype(np.uint64)
            part = (W.grams(p.words.hash, window)[at[sent]] & (parts - np.uint64(1))).astype(np.int64)
            bucket = signed(p.bucket[pack[sent]])
            group = np.lexsort((at[sent], part, bucket, who))
            sent, who, part, bucket = sent[group], who[group], part[group], bucket[group]
            if len(sent):
                head = np.flatnonzero(np.concatenate([[True], (who[1:] != who[:-1]) | (bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])]))
                for x, z in zip(head.tolist(), np.append(head[1:], len(sent)).tolist(), strict=True):
                    r = int(who[x])
                    place = b"" if r < 0 else (at[sent[x:z]] - p.words.row[r]).astype("<i4").tobytes()
                    out.append((int(bucket[x]), int(part[x]), None if r < 0 else keys[r], place, raw[sent[x:z]].tobytes()))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary()),
                 pa.array(columns[3], pa.binary()), pa.array(columns[4], pa.binary())], ["bucket", "part", "row_key", "places", "digests"])

    return run


def _windows(pack: bytes, window: int) -> list[bytes]:
    words = pack.split(b" ")
    end = list(accumulate((len(x) + 1 for x in words), initial=0))
    return [pack[end[i]:end[i + window] - 1] for i in range(len(words) - window + 1)]


def repeated_windows(packs: list[bytes], window: int) -> list[list[int]]:
    """For each packed string of one bucket, which of its windows occur twice or more there."""
    of: dict[bytes, list[int]] = {}
    for i, pack in enumerate(packs):
        of.setdefault(pack, []).append(i)
    found: list[list[int]] = [[] for _ in packs]
    listed = []
    for pack, rows in of.items():
        if len(of) > 1 or len(rows) == 1:
            listed += [(x, j, rows) for j, x in enumerate(_windows(pack, window))]
        else:  # the whole string repeats, and nothing else is here
            every = list(range(pack.count(b" ") + 2 - window))
            for r in rows:
                found[r] = every
    listed.sort(key=lambda x: x[0])
    for i, (x, j, rows) in enumerate(listed):
        if len(rows) > 1 or (i and listed[i - 1][0] == x) or (i + 1 < len(listed) and listed[i + 1][0] == x):
            for r in rows:
                found[r].append(j)
    return found


def _ranges(places: list[int], window: int) -> list[tuple[int, int]]:
    """Word ranges that windows at these places cover."""
    out: list[tuple[int, int]] = []
    for i in sorted(places):
        if out and i <= out[-1][1]:
            out[-1] = (out[-1][0], i + window)
        else:
            out.append((i, i + window))
    return out


def _by_bucket(keys: int, solve):
    """mapInArrow function over rows sorted by their first ``keys`` columns: ``solve`` gets the other
    columns of each group and gives (row_key, start, end)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, out = None, [], []

        def flush():
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()),
                                               pa.array(columns[2], pa.int64())], ["row_key", "start", "end"])

        for b in batches:
            ids = [b.column(k).to_numpy() for k in range(keys)]
            change = np.zeros(max(b.num_rows - 1, 0), bool)
            for x in ids:
                change |= x[1:] != x[:-1]
            cut = [0, *(np.flatnonzero(change) + 1).tolist(), b.num_rows]
            columns = [b.column(i).to_pylist() for i in range(keys, b.num_columns)]
            for a, z in zip(cut[:-1], cut[1:], strict=True):
                if a == z:
                    continue
                name = tuple(int(x[a]) for x in ids)
                if name != group:
                    if held:
                        out += solve(*held)
                    group, held = name, [[] for _ in columns]
                for to, c in zip(held, columns, strict=True):
                    to += c[a:z]
            if len(out) > 10_000:
                yield flush()
        if held:
            out += solve(*held)
        yield flush()

    return run


def _solve_packs(window: int):
    def solve(packs, keys, starts):
        return [(key, at + a, at + z) for key, at, places in zip(keys, starts, repeated_windows(packs, window), strict=True)
                for a, z in _ranges(places, window)]

    return solve


def _solve_digests(window: int):
    def solve(keys, places, digests):
        if digests[0] is None:  # ranges that their pass knew
            spans = [np.frombuffer(p, "<i4") for p in places]
            return [(k, int(x[0]), int(x[1])) for k, x in zip(keys, spans, strict=True)]
        raw = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
        order = np.lexsort((raw[:, 1], raw[:, 0]))
        same = (raw[order][1:] == raw[order][:-1]).all(axis=1)
        twice = np.zeros(len(raw), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        edge = np.concatenate([[0], np.cumsum([len(d) // 16 for d in digests])])
        out = []
        for i in np.unique(np.searchsorted(edge, np.flatnonzero(twice), side="right") - 1).tolist():
            if keys[i] is not None:
                at = np.frombuffer(places[i], "<i4")[twice[edge[i]:edge[i + 1]]]
                out += [(keys[i], a, z) for a, z in _ranges(at.tolist(), window)]
        return out

    return solve


def repeated_ranges(docs: DataFrame, window: int = 35, gram: int = 8, bits: int = 1 << 26, hot_from: int = 8192) -> DataFrame:
    """(row_key, ranges): word ranges of the keyed documents that windows found twice or more cover.

    First pass: how many super-k-mers each slot of minimisers has, as a level that comes
    back in four bitmaps of ``bits`` bits, of a fixed size. A bucket of one super-k-mer holds no
    repeat and is not sent at all. A slot of more than ``hot_from`` would make a large
    bucket: it is split by the hash of the window into four times as many parts at each
    level, so that no part has many more windows than ``hot_from`` super-k-mers have;
    there, windows travel as digests of 128 bits, what one pass holds twice only once, and
    are sorted and counted likewise.
    """
    spark = docs.sparkSession
    counts = (docs.select("text").mapInArrow(_buckets(window, gram), "bucket bigint, n bigint")
              .groupBy(slot("bucket", bits).alias("slot")).agg(F.sum("n").alias("n")))
    n = F.col("n")
    level = (F.when(n <= 1, 0).when(n <= hot_from, 1)
             .otherwise(F.least(F.lit(15), 1 + F.ceil(F.log2(n / hot_from) / 2))).cast("int"))
    planes = bitmaps(counts, bits, **{f"plane{k}": level.bitwiseAND(F.lit(1 << k)) != 0 for k in range(4)})
    shared = spark.sparkContext.broadcast([planes[f"plane{k}"] for k in range(4)])
    rows = docs.select("row_key", "text")
    packs = rows.mapInArrow(_packs(window, gram, bits, shared), "bucket bigint, pack binary, row_key binary, start bigint")
    found = "row_key binary, start bigint, end bigint"
    ranges = packs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_by_bucket(1, _solve_packs(window)), found)
    if any(planes[f"plane{k}"].any() for k in range(1, 4)):
        hot = rows.mapInArrow(_hot_packs(window, gram, bits, shared),
                              "bucket bigint, part bigint, row_key binary, places binary, digests binary")
        ranges = ranges.unionByName(hot.repartition("bucket", "part").sortWithinPartitions("bucket", "part")
                                    .mapInArrow(_by_bucket(2, _solve_digests(window)), found))
    return ranges.groupBy("row_key").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("ranges"))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, ranges) to (id, n_words, n_removed, kept)."""
    for b in W.passes(batches, "text"):
        w = W.Words(b.column(1), W.BLANK_WORDS, lower=False)
        gone = np.zeros(int(w.row[-1]), bool)
        if b.num_columns > 2:
            r = b.column(2)
            owner = np.repeat(np.arange(b.num_rows), pa.compute.list_value_length(r).fill_null(0).to_numpy())
            if len(owner):
                flat = r.flatten()
                start = flat.field(0).to_numpy() + w.row[owner]
                gone = W.covered(start, flat.field(1).to_numpy() + w.row[owner] - start, len(gone))
        total = np.concatenate([[0], np.cumsum(gone)])
        stay = np.flatnonzero(~gone)
        row = np.searchsorted(stay, w.row)
        size = (w.end - w.start + 1)[stay]
        upto = np.concatenate([[0], np.cumsum(size)])
        text = np.zeros(0, np.uint8)
        if len(stay):
            text = w.data[np.minimum(np.repeat(w.start[stay] - upto[:-1], size) + np.arange(int(upto[-1])), len(w.data) - 1)]
            text[upto[1:] - 1] = 0x20
        raw = text.tobytes()
        kept = [raw[a:max(a, z - 1)].decode() for a, z in zip(upto[row[:-1]].tolist(), upto[row[1:]].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(w.counts, pa.int64()), pa.array(total[w.row[1:]] - total[w.row[:-1]]),
             pa.array(kept, pa.string())], ["id", "n_words", "n_removed", "kept"])


def _whole(shared, bits: int):
    """mapInArrow function: (hash, id, text) of the rows whose hash is not in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def others():
            for b in batches:
                yield b.filter(pa.array(~in_bitmap(shared.value, bits, b.column(0).to_numpy()))).select([1, 2])

        return _remove(others())

    return run


def remove_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", gram: int = 8,
                   bits: int = 1 << 26, hot_from: int = 8192) -> DataFrame:
    """``id_col``, ``n_words``, ``n_removed`` and ``kept`` (the words left, joined by one space) of each row.

    A word goes if a window over it has a word sequence that starts anywhere else too, in
    the same text or another, judged on the input. Repeated rows are texts of their own,
    so what they hold twice goes from both. A null or empty text has no words and an empty
    ``kept``; texts shorter than a window stay whole; an empty table gives no rows; other
    columns are ignored, whatever their names.

    Texts without a repeat are finished where they are read; only those with one are
    shuffled, to meet their ranges. See :func:`repeated_ranges` for the rest.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = keyed(docs, id_col, text_col)
    ranges = written(repeated_ranges(rows, window, gram, bits, hot_from), "repeated_ranges")
    few = 1 << 24
    shared = hash_bitmap(ranges.select(F.xxhash64("row_key").alias("h")), "h", few)

    h = F.xxhash64("row_key")
    whole = rows.withColumn("h", h).select("h", "doc_id", "text").mapInArrow(
        _whole(shared, few), f"id {kind}, n_words bigint, n_removed bigint, kept string")
    cut = (in_place(rows, shared, few, h, has=True).join(ranges, "row_key", "left")
           .select(F.col("doc_id").alias("id"), "text", "ranges").mapInArrow(_remove, whole.schema))
    return whole.unionByName(cut).withColumnRenamed("id", id_col)


def repeat_digests(docs: DataFrame) -> DataFrame:
    """Query rows: counts and a digest of the words left of each document."""
    r = remove_repeats(docs)
    return r.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

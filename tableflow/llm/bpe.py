"""Byte-level BPE on length-bucketed numpy matrices.

The distinct pieces of a pass of text are laid out by length in padded matrices. In each
round every row merges its leftmost pair of minimum rank, found by a hashed lookup of
pairs; rows without a pair leave and the matrix is compacted. Ids come back to the texts
by the pieces' order of appearance.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.llm import words as W
from tableflow.llm.common import arrow_batches
from tableflow.llm.pretoken import pieces

NONE = np.int32(2**31 - 1)
#: text of one pass: enough that most of its pieces have been seen before in it
PASS_BYTES = 1 << 20
#: longer pieces are merged one by one with block minima, so that a row costs
#: O(n sqrt n) and not O(n^2)
LONGEST_ROW = 256
_BLOCK = 256


class PairTable:
    """Open-addressing hash table from a pair of ids to the rank (and id) of its merge."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> None:
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(rank)) * 2.5))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        at, todo = self._home(key), np.arange(len(key))
        while len(todo):
            free = todo[self.keys[at[todo]] == -1]
            _, first = np.unique(at[free], return_index=True)  # one writer for each free place
            put = free[first]
            self.keys[at[put]] = key[put]
            self.ranks[at[put]] = rank[put]
            todo = np.setdiff1d(todo, put, assume_unique=True)
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)

    def _home(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        at = self._home(key)
        out = np.full(len(key), NONE, np.int32)
        todo = np.arange(len(key))
        while len(todo):
            there = self.keys[at[todo]]
            same = there == key[todo]
            hit = todo[same]
            out[hit] = self.ranks[at[hit]]
            todo = todo[~same & (there != -1)]
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
        return out


class Vocabulary:
    """Ranks of a tiktoken file: token bytes to rank, which is also the id."""

    def __init__(self, content: bytes) -> None:
        self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in content.splitlines() if x.strip())}
        size = max(self.ranks.values()) + 1
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, rank = [], [], []
        for token, r in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
        self.pairs = PairTable(np.array(left, np.int64), np.array(right, np.int64), np.array(rank, np.int32))
        tokens = [b""] * size
        for token, r in self.ranks.items():
            tokens[r] = token
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.length)])
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the ids, one after another."""
        n = self.length[ids]
        ends = np.cumsum(n)
        shift = np.repeat(self.offset[ids] - (ends - n), n)
        return self.bytes[shift + np.arange(len(shift))]


_loaded: dict[str, Vocabulary] = {}


def vocabulary(content: bytes) -> Vocabulary:
    """One vocabulary is kept in each worker."""
    name = hashlib.sha256(content).hexdigest()
    if name not in _loaded:
        _loaded.clear()
        _loaded[name] = Vocabulary(content)
    return _loaded[name]


def merge_rows(symbols: np.ndarray, length: np.ndarray, pairs: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merge every row to the end.

    ``symbols``: ids, place x row (padded with -1); ``length``: used places of each row.
    Returns the matrix and the lengths after the merges.
    """
    places, n = symbols.shape
    out, out_length = symbols.copy(), length.copy()
    live = np.arange(n)
    s = symbols
    rank = np.full((places, n), NONE, np.int32)
    for j in range(places - 1):
        ok = np.flatnonzero(length > j + 1)
        rank[j, ok] = pairs(s[j, ok], s[j + 1, ok])
    length = length.copy()
    while len(live):
        best = rank.min(axis=0)
        going = best != NONE
        if not going.all():  # compaction: finished rows leave
            done = ~going
            out[:s.shape[0], live[done]] = s[:, done]
            out_length[live[done]] = length[done]
            live, s, rank, best, length = live[going], s[:, going], rank[:, going], best[going], length[going]
            if not len(live):
                break
            used = int(length.max())
            s, rank = s[:used], rank[:used]
        at = (rank == best).argmax(axis=0)
        rows = np.arange(len(live))
        s[at, rows] = best
        for j in range(s.shape[0] - 1):
            moves = at < j
            np.copyto(s[j], s[j + 1], where=moves)
            np.copyto(rank[j], rank[j + 1], where=at <= j)
        last = np.flatnonzero(at == s.shape[0] - 2)  # nothing right of the last pair
        rank[s.shape[0] - 2, last] = NONE
        rank[s.shape[0] - 1] = NONE
        length = length - 1
        has = np.flatnonzero(at + 1 < length)
        rank[at, rows] = NONE
        rank[at[has], has] = pairs(s[at[has], has], s[at[has] + 1, has])
        has = np.flatnonzero(at > 0)
        rank[at[has] - 1, has] = pairs(s[at[has] - 1, has], s[at[has], has])
    return out, out_length


def merge_long(ids: np.ndarray, pairs: PairTable) -> np.ndarray:
    """The same merges for one long piece: minima of blocks lead to the leftmost minimum."""
    n = len(ids)
    s = ids.astype(np.int64)
    nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
    blocks = -(-n // _BLOCK)
    rank = np.full(blocks * _BLOCK, NONE, np.int32)
    rank[:n - 1] = pairs(s[:-1], s[1:])
    low = rank.reshape(blocks, _BLOCK).min(axis=1)

    def put(at: int, value: int) -> None:
        rank[at] = value
        b = at // _BLOCK
        low[b] = rank[b * _BLOCK:(b + 1) * _BLOCK].min()

    while True:
        b = int(low.argmin())
        if low[b] == NONE:
            break
        i = b * _BLOCK + int(rank[b * _BLOCK:(b + 1) * _BLOCK].argmin())
        j = int(nxt[i])
        s[i] = rank[i]
        s[j] = -1
        after = int(nxt[j])
        nxt[i] = after
        put(j, NONE)
        if after < n:
            prv[after] = i
            put(i, int(pairs(s[i:i + 1], s[after:after + 1])[0]))
        else:
            put(i, NONE)
        before = int(prv[i])
        if before >= 0:
            put(before, int(pairs(s[before:before + 1], s[i:i + 1])[0]))
    return s[s >= 0].astype(np.int32)


def encode_pieces(data: np.ndarray, start: np.ndarray, end: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of every piece one after another, and how many each has."""
    first, kind = W.distinct(data, start, end)
    a, size = start[first], end[first] - start[first]
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # (kinds, counts, ids row by row)
    whole = np.fromiter((v.ranks.get(data[x:x + n].tobytes(), -1) for x, n in zip(a.tolist(), size.tolist(), strict=True)),
                        np.int64, len(a))
    known = np.flatnonzero(whole >= 0)
    parts.append((known, np.ones(len(known), np.int64), whole[known].astype(np.int32)))
    todo = np.flatnonzero(whole < 0)
    low = 1
    while len(todo) and low < LONGEST_ROW:
        high = low * 2
        of = todo[(size[todo] > low) & (size[todo] <= high)]
        if len(of):
            places = np.arange(high)[:, None]
            inside = places < size[of][None, :]
            cells = data[np.where(inside, a[of][None, :] + places, 0)]
            matrix = np.where(inside, v.byte_id[cells], -1).astype(np.int32)
            merged, count = merge_rows(matrix, size[of], v.pairs)
            used = np.arange(high)[:, None] < count[None, :]
            parts.append((of, count, merged.T[used.T]))
        low = high
    for k in todo[size[todo] > LONGEST_ROW]:
        ids = merge_long(v.byte_id[data[a[k]:a[k] + size[k]]], v.pairs)
        parts.append((np.array([k]), np.array([len(ids)]), ids))
    kinds, counts, flat = (np.concatenate(x) for x in zip(*parts, strict=True))
    offset = np.zeros(len(first), np.int64)
    count = np.zeros(len(first), np.int64)
    offset[kinds] = np.cumsum(counts) - counts
    count[kinds] = counts
    n = count[kind]
    ends = np.cumsum(n)
    return flat[np.repeat(offset[kind] - (ends - n), n) + np.arange(int(n.sum()))], n


def encode_column(column: pa.Array, v: Vocabulary) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers."""
    data, start, end, row = pieces(column)
    if not len(start):
        return [b""] * (len(row) - 1)
    ids, n = encode_pieces(data, start, end, v)
    edge = np.concatenate([[0], np.cumsum(n)])[row]
    raw = ids.astype("<u4").tobytes()
    return [raw[4 * x:4 * y] for x, y in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]


def _encoder(content):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(content.value)
        for b in W.passes(batches, "__text", PASS_BYTES):
            ids = pa.array(encode_column(b.column(b.num_columns - 1), v), pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], ids], [*b.schema.names[:-1], "ids"])

    return run


def _decoder(content):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(content.value)
        for b in batches:
            out = [None if x is None else v.decode(np.frombuffer(x, "<u4").astype(np.int64)).tobytes()
                   for x in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], [*b.schema.names, "decoded"])

    return run


def _file(df: DataFrame, path: str):
    """The vocabulary (a file of fixed size) for every executor; only the driver reads the path."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and ``ids``: the tokens of each whole text, as packed little-endian uint32.

    ``path``: a tiktoken rank file. Pieces that are a token are taken as such, others
    are merged; there are no special tokens. A null or empty text has no ids; repeated
    rows and an empty table pass through; other columns are ignored, whatever their
    names. One pass of map tasks, no shuffle; memory is bounded by a pass of
    ``PASS_BYTES`` of text, or one longer text.
    """
    arrow_batches(docs.sparkSession)
    content = _file(docs, path)
    rows = docs.select(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keep)], F.col(f"`{text_col}`").alias("__text"))
    out = rows.mapInArrow(_encoder(content), T.StructType([*rows.schema.fields[:-1], T.StructField("ids", T.BinaryType())]))
    return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keep)], "ids")


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """The rows with ``decoded``: the bytes of the ids (null for null, none for none).

    Other columns pass as they are, whatever their names; repeated rows and an empty
    table do, too. A column named ``decoded`` is an error of the caller's.
    """
    content = _file(encoded, path)
    names = encoded.columns
    rows = encoded.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(names) if c != ids_col], F.col(f"`{ids_col}`").alias("ids"))
    out = rows.mapInArrow(_decoder(content), T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())]))
    return out.select(*[F.col("ids" if c == ids_col else f"k{i}").alias(c) for i, c in enumerate(names)], "decoded")


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """Query rows: token counts, and digests of the ids and of the decoded bytes."""
    r = decode(encode(docs, path), path)
    return r.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                    F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

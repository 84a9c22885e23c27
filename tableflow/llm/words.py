"""Vectorised word handling on Arrow string columns: spans, 64-bit word hashes, windows.

A batch is worked on as one UTF-8 byte buffer. Words are maximal runs of word bytes
(every alphabet used here is closed over whole code points, so byte runs equal code
point runs); their hashes come from whole-array arithmetic, so no Python loop touches a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: bytes that separate words of ``[^\x20\x09-\x0D]+``
_BLANKS = np.array([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
BLANK_WORDS = np.ones(256, dtype=bool)
BLANK_WORDS[_BLANKS] = False
#: bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z
ALNUM_WORDS = np.zeros(256, dtype=bool)
ALNUM_WORDS[0x30:0x3A] = True
ALNUM_WORDS[0x61:0x7B] = True
ALNUM_WORDS[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

#: texts of one numpy pass; a longer single text is a pass of its own
PASS_BYTES = 1 << 19

def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every bit of each value."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def string_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64, count=n + 1, offset=column.offset * 8)
    if data is None or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    buf = np.frombuffer(data, np.uint8, count=int(offs[-1] - offs[0]), offset=int(offs[0]))
    return buf, offs - offs[0]


def passes(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = PASS_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``max_bytes`` of text each (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offs = string_buffer(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offs, offs[at] + max_bytes, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


class Words:
    """Words of the rows of one string column.

    ``start``, ``end``: byte spans; ``row``: CSR offsets, row i has the words
    ``row[i]:row[i+1]``; ``hash``: 64-bit word hashes (made on first use).
    """

    def __init__(self, column: pa.Array, alphabet: np.ndarray, lower: bool) -> None:
        raw, self.offsets = string_buffer(column)
        self.data = LOWER[raw] if lower else raw
        inside = alphabet[self.data]
        n = len(inside)
        edge = np.zeros(n + 1, dtype=bool)
        edge[self.offsets] = True
        before = np.zeros(n, dtype=bool)
        before[1:] = inside[:-1]
        before[edge[:-1]] = False
        after = np.zeros(n, dtype=bool)
        after[:-1] = inside[1:]
        after[edge[1:]] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.row = np.searchsorted(self.start, self.offsets)
        self._hash: np.ndarray | None = None

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.row)

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = span_hash(self.data, self.start, self.end)
        return self._hash

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.row) - 1), self.counts)


def _lanes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the spans in lanes of 8 (the last one filled with zeros), each lane's place in its span, and where each span's lanes start."""
    n = (length + 7) >> 3
    first = np.cumsum(n) - n
    place = np.arange(int(n.sum())) - np.repeat(first, n)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    # an 8-byte word at every byte
    words = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    lanes = words[np.repeat(start, n) + 8 * place].astype(np.uint64)
    left = np.repeat(length, n) - 8 * place
    short = left < 8
    lanes[short] &= (np.uint64(1) << (8 * left[short]).astype(np.uint64)) - np.uint64(1)
    return lanes, place.astype(np.uint64), first


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span (none empty).

    Every 8 bytes are mixed with their place before they are added up, so no regular
    pattern of bytes makes two spans meet; different spans have one hash by chance alone.
    """
    if not len(start):
        return np.zeros(0, np.uint64)
    length = (end - start).astype(np.int64)
    lanes, place, first = _lanes(data, start, length)
    lanes = mix(lanes ^ mix(place * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xA0761D6478BD642F)))
    return mix(np.add.reduceat(lanes, first) + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of one span of each kind, and the kind of every span, by their bytes (hashes only propose)."""
    _, first, kind = np.unique(span_hash(data, start, end), return_index=True, return_inverse=True)
    length = (end - start).astype(np.int64)
    of = first[kind]
    equal = length == length[of]
    if equal.all():
        equal = _lanes(data, start, length)[0] == _lanes(data, start[of], length)[0]
    if not equal.all():  # two spans with one hash: by the bytes themselves
        known: dict[bytes, int] = {}
        raw, first = data.tobytes(), []
        for i, (a, b) in enumerate(zip(start.tolist(), end.tolist())):
            kind[i] = known.setdefault(raw[a:b], len(known))
            if kind[i] == len(first):
                first.append(i)
        first = np.array(first)
    return first, kind


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive values (rows are not told apart)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = h[:n].copy()
    for j in range(1, k):
        acc *= np.uint64(0xC2B2AE3D27D4EB4F)
        acc += h[j:j + n]
    return mix(acc + np.uint64(k))


def inside_rows(row: np.ndarray, k: int) -> np.ndarray:
    """For each run of ``k`` consecutive words: does it lie in one row?"""
    n = int(row[-1]) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    ends = np.repeat(row[1:], np.diff(row))[:n]
    return np.arange(n) + k <= ends


def sliding(x: np.ndarray, w: int, op) -> np.ndarray:
    """``op`` (np.minimum, np.maximum) over every ``w`` consecutive values."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    done, acc = 1, x
    while done < w:
        step = min(done, w - done)
        acc = op(acc[:len(acc) - step], acc[step:])
        done += step
    return acc[:n]


def covered(start: np.ndarray, length: np.ndarray | int, n: int) -> np.ndarray:
    """Mask of the positions below ``n`` that lie in a span."""
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, start, 1)
    np.add.at(delta, start + length, -1)
    return np.cumsum(delta[:n]) > 0

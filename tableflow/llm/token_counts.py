"""Token counts by byte-pair merging on a heap and a linked list.

Each distinct piece starts as its bytes. A heap holds its adjacent pairs by merge rank;
the lowest is popped and merged again and again, stale entries are passed over. The
piece's count is its symbols minus its merges; no identifiers are kept.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm import words as W
from tableflow.llm.common import arrow_batches
from tableflow.llm.pretoken import pieces

#: pieces whose counts a worker keeps between passes; beyond it, it starts afresh
CACHE_PIECES = 400_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable
    Latin-1 for itself, the others moved to U+0100 and on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = iter(range(0x100, 0x200))
    return [chr(b) if b in set(shown) else chr(next(moved)) for b in range(256)]


class Merges:
    """Merges of a ``tokenizers`` JSON file (byte-level BPE)."""

    def __init__(self, content: bytes) -> None:
        spec = json.loads(content)
        model, split = spec["model"], spec["pre_tokenizer"]
        plain = (model["type"] == "BPE" and split["type"] == "ByteLevel" and split["use_regex"]
                 and not split["add_prefix_space"] and spec["normalizer"] is None and not model.get("ignore_merges")
                 and not model.get("byte_fallback") and model.get("dropout") is None
                 and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix"))
        if not plain:
            raise ValueError("only byte-level BPE without prefix space, normaliser or affixes is handled")
        letter = byte_letters()
        ids = model["vocab"]
        self.byte = [ids[c] for c in letter]
        #: pair of ids -> (rank, id of the merged symbol), as one number
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("only added tokens that match literally are handled")
        #: longest first: where several start, the longest is taken
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.cache: dict[bytes, int] = {}

    def count(self, piece: bytes) -> int:
        """Tokens of one piece."""
        n = len(piece)
        if n == 1:
            return 1
        pairs = self.pairs
        symbol = [self.byte[b] for b in piece]
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            m = pairs.get((symbol[i], symbol[i + 1]))
            if m is not None:
                heap.append((m[0], i, m[1], symbol[i], symbol[i + 1]))
        heapify(heap)
        merges = 0
        while heap:
            _, i, new, a, b = heappop(heap)
            j = after[i]
            if symbol[i] != a or j >= n or symbol[j] != b:
                continue  # one of the two was merged meanwhile
            symbol[i], symbol[j] = new, -1
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                m = pairs.get((new, symbol[k]))
                if m is not None:
                    heappush(heap, (m[0], i, m[1], new, symbol[k]))
            h = before[i]
            if h >= 0:
                m = pairs.get((symbol[h], new))
                if m is not None:
                    heappush(heap, (m[0], h, m[1], symbol[h], new))
        return n - merges

    def counts(self, column: pa.Array) -> np.ndarray:
        """Tokens of each text of a column without special strings."""
        data, start, end, row = pieces(column)
        if not len(start):
            return np.zeros(len(row) - 1, np.int64)
        first, kind = W.distinct(data, start, end)
        raw, cache = data.tobytes(), self.cache
        if len(cache) > CACHE_PIECES:
            cache.clear()
        each = np.empty(len(first), np.int64)
        for i, (a, b) in enumerate(zip(start[first].tolist(), end[first].tolist(), strict=True)):
            piece = raw[a:b]
            n = cache.get(piece)
            if n is None:
                n = self.count(piece)
                if b - a <= 64:
                    cache[piece] = n
            each[i] = n
        total = np.concatenate([[0], np.cumsum(each[kind])])
        return total[row[1:]] - total[row[:-1]]

    def segments(self, text: str) -> tuple[list[str], int]:
        """What lies between special strings, and how many of them there are."""
        parts, n = [text], 0
        for s in self.special:
            cut = [p.split(s) for p in parts]
            n += sum(len(c) - 1 for c in cut)
            parts = [x for c in cut for x in c]
        return parts, n


_loaded: dict[str, Merges] = {}


def merges(content: bytes) -> Merges:
    name = hashlib.sha256(content).hexdigest()
    if name not in _loaded:
        _loaded.clear()
        _loaded[name] = Merges(content)
    return _loaded[name]


def _counter(content):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merges(content.value)
        for b in W.passes(batches, "text"):
            text = b.column(1).fill_null("") if b.column(1).null_count else b.column(1)
            size = pc.binary_length(text).cast(pa.int64())
            special = np.zeros(b.num_rows, bool)
            for s in m.special:
                special |= pc.match_substring(text, s).to_numpy(zero_copy_only=False)
            n = m.counts(pc.if_else(pa.array(special), "", text))
            for i in np.flatnonzero(special):
                parts, found = m.segments(text[int(i)].as_py())
                n[i] = int(m.counts(pa.array(parts, pa.string())).sum()) + found
            yield pa.RecordBatch.from_arrays([b.column(0), size, pa.array(n)], ["id", "n_bytes", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of each whole text.

    ``path``: a ``tokenizers`` JSON file of byte-level BPE. Special strings of the file
    inside texts count as one token each, as the library has it by default; nothing is
    added, cut or padded. A null or empty text has 0 bytes and 0 tokens; repeated rows
    each get their row; an empty table gives none; other columns are ignored, whatever
    their names. One pass of map tasks, no shuffle.
    """
    arrow_batches(docs.sparkSession)
    with open(path, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(_counter(content), f"id {kind}, n_bytes bigint, n_tokens bigint")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

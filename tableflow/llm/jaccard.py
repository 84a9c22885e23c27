"""N-gram Jaccard join by chosen paths.

A text is the set of hashes of its runs of five words. In each run of the join, a set
starts at a root; at each node it follows the tokens that a pseudo-random interval of the
node chooses from it, 1 / similarity of them on average, and so reaches some leaves. Two
similar sets share a chosen token often enough to share a leaf in some run; two texts
that have only a passage in common lose each other at one of the levels. Sets that meet
in a leaf are compared by brute force on whole sets, large leaves in blocks of pairs.
Runs are repeated until a pair at the threshold is found with the target probability.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm import words as W
from tableflow.llm.common import hash_bitmap, in_bitmap, in_place, keyed, row_key, written

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.9999
DEPTH = 3
#: members, and tokens, of one block of a large leaf; a task compares two blocks at a time
BLOCK = 2048
BLOCK_TOKENS = 1 << 20
_STRIP = 512
_TOKEN_BITS = 40


def runs_for(recall: float, depth: int) -> int:
    """Runs after which a pair at the threshold was found with this probability.

    A pair follows at least a Poisson(1) number of common tokens at each node; it is
    found in a run if that branching process is alive at the leaves.
    """
    alive = 1.0
    for _ in range(depth):
        alive = 1 - math.exp(-alive)
    return math.ceil(math.log(1 - recall) / math.log(1 - alive))


# --- sets and paths -----------------------------------------------------------

def token_sets(column: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, row): distinct tokens of each text, ascending; text i has tokens row[i]:row[i+1].

    A text of fewer words than a shingle, but not none, has one token of all its words.
    """
    w = W.Words(column, W.ALNUM_WORDS, lower=True)
    n = len(w.row) - 1
    rows = w.row_of()
    of = np.flatnonzero(W.inside_rows(w.row, shingle))
    tokens, owner = [W.grams(w.hash, shingle)[of] if len(of) else np.zeros(0, np.uint64)], [rows[of]]
    for k in range(1, shingle):
        short = np.flatnonzero(w.counts == k)
        if len(short):
            tokens.append(W.grams(w.hash, k)[w.row[short]])
            owner.append(short)
    t, r = np.concatenate(tokens), np.concatenate(owner)
    order = np.lexsort((t, r))
    t, r = t[order], r[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (r[1:] != r[:-1])
    t, r = t[new], r[new]
    return t, np.searchsorted(r, np.arange(n + 1))


def leaf_keys(tokens: np.ndarray, row: np.ndarray, similarity: float, runs: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(set, key) of every leaf that each set reaches.

    A node chooses the tokens whose hash lies in a circular interval that starts at the
    node's key and has 1 / (similarity * size) of the range.
    """
    n = len(row) - 1
    size = np.diff(row)
    whole = 1 << _TOKEN_BITS
    short = (tokens >> np.uint64(64 - _TOKEN_BITS)).astype(np.int64)
    place = (np.repeat(np.arange(n), size) << _TOKEN_BITS) | short
    reach = np.minimum(whole / (similarity * np.maximum(size, 1)), whole).astype(np.int64)
    some = np.flatnonzero(size)
    owner = np.tile(some, runs)
    path = np.repeat(W.mix(np.arange(1, runs + 1, dtype=np.uint64)), len(some))
    for _ in range(depth):
        low = (W.mix(path) >> np.uint64(64 - _TOKEN_BITS)).astype(np.int64)
        high = low + reach[owner]
        base = owner << _TOKEN_BITS
        a = np.searchsorted(place, base + low)
        b = np.searchsorted(place, base + np.minimum(high, whole))
        c = row[owner]
        d = np.searchsorted(place, base + np.clip(high - whole, 0, low))
        first, count = np.concatenate([a, c]), np.concatenate([b - a, d - c])
        node = np.repeat(np.tile(np.arange(len(owner)), 2), count)
        ends = np.cumsum(count)
        chosen = np.repeat(first - (ends - count), count) + np.arange(int(count.sum()))
        path = W.mix(path[node] * np.uint64(0x9E3779B97F4A7C15) + tokens[chosen])
        owner = owner[node]
    return owner, path


def _sets(similarity: float, runs: int, depth: int, shingle: int):
    """mapInArrow function: (row_key, id, text) to (row_key, id, set_id, size, leaves)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.passes(batches, "text"):
            t, row = token_sets(b.column(2), shingle)
            owner, key = leaf_keys(t, row, similarity, runs, depth)
            pair = np.unique(np.stack([owner.astype(np.uint64), key], axis=1), axis=0) if len(key) else np.zeros((0, 2), np.uint64)
            edge = np.searchsorted(pair[:, 0], np.arange(b.num_rows + 1, dtype=np.uint64))
            leaves = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)),
                                              pa.array(np.ascontiguousarray(pair[:, 1]).view(np.int64)))
            raw = t.tobytes()
            ids = [hashlib.blake2b(raw[8 * x:8 * y], digest_size=16).digest() if y > x else None
                   for x, y in zip(row[:-1].tolist(), row[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(ids, pa.binary()), pa.array(np.diff(row).astype(np.int64)),
                 leaves.cast(pa.list_(pa.field("element", pa.int64())))], ["row_key", "id", "set_id", "size", "leaves"])

    return run


def _tokens_of(found, bits: int, shingle: int):
    """mapInArrow function: (hash, row_key, text) to (row_key, tokens), of rows in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.passes(batches, "text"):
            mine = b.filter(pa.array(in_bitmap(found.value, bits, b.column(0).to_numpy())))
            t, row = token_sets(mine.column(2), shingle)
            raw = t.tobytes()
            packed = [raw[8 * x:8 * y] for x, y in zip(row[:-1].tolist(), row[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([mine.column(1), pa.array(packed, pa.binary())], ["rep", "tokens"])

    return run


# --- brute force in a leaf ----------------------------------------------------

def linked_pairs(sets: list[np.ndarray], similarity: float, block: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) of the sets whose Jaccard similarity reaches the threshold.

    ``block``: 0 or 1 for each set; then only pairs across the blocks count.
    """
    m = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    if m == 2:
        if block is not None and block[0] == block[1] or size.min() < similarity * size.max():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        hit = both >= similarity * (size.sum() - both) - 1e-9
        return np.zeros(int(hit), np.int64), np.ones(int(hit), np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m), size)
    _, kind, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[kind] > 1
    column, owner = (np.cumsum(count > 1) - 1)[kind[shared]], owner[shared]
    width = int((count > 1).sum())
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    step = max(64, (1 << 21) // m)
    chunks = [(at, *np.searchsorted(column, [at, at + step])) for at in range(0, width, step)]
    found = []
    for low in range(0, m, _STRIP):  # strips of rows bound the matrices
        high = min(low + _STRIP, m)
        common = np.zeros((high - low, m - low), np.float32)  # exact up to 2**24 tokens
        for at, x, z in chunks:
            part = np.zeros((m, min(step, width - at)), np.float32)
            part[owner[x:z], column[x:z] - at] = 1
            common += part[low:high] @ part[low:].T
        either = (size[low:high, None] + size[None, low:]).astype(np.float32) - common
        hit = np.triu(common >= similarity * either - 1e-4, 1)
        i, j = np.nonzero(hit)
        # again in whole numbers' precision for those near the threshold
        both = common[i, j].astype(np.float64)
        ok = both >= similarity * (size[low + i] + size[low + j] - both) - 1e-9
        found.append((low + i[ok], low + j[ok]))
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    if block is not None:
        across = block[i] != block[j]
        i, j = i[across], j[across]
    return i, j


def _forest(i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the pairs connect: one fewer than members at most."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        p, q = top(a), top(b)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((a, b))
    return out


_LINKS = "rep binary, other binary, links bigint, texts bigint"


def _compare(similarity: float):
    """mapInArrow function over rows sorted by unit: links of each set, and connecting edges.

    A pair that meets in several leaves counts in the one of lowest key.
    """

    def solve(unit, rows, out):
        if len(rows) < 2:
            return
        leaf, low, high = unit
        sets = [np.frombuffer(r[3], np.uint64) for r in rows]
        block = None if low == high else np.array([int(r[0] == high) for r in rows])
        i, j = linked_pairs(sets, similarity, block)
        if not len(i):
            return
        for a, b in _forest(i, j):
            out.append((rows[a][1], rows[b][1], 0, 0))
        many = [len(r[4]) > 1 for r in rows]
        links, texts = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        copies = np.array([r[2] for r in rows], np.int64)
        if any(many):
            first = _first_meeting(rows, i, j, leaf)
            i, j = i[first], j[first]
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        np.add.at(texts, i, 1)
        np.add.at(texts, j, 1)
        for k in np.flatnonzero(texts).tolist():
            out.append((rows[k][1], None, int(links[k]), int(texts[k])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rows, out = None, [], []

        def flush():
            cols = list(zip(*out, strict=True)) or [(), (), (), ()]
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.int64())], ["rep", "other", "links", "texts"])

        for b in batches:
            # leaf, low, high | block, rep, copies, tokens, leaves
            units = zip(*(b.column(k).to_pylist() for k in range(3)), strict=True)
            values = zip(*(b.column(k).to_pylist() for k in range(3, 8)), strict=True)
            for u, r in zip(units, values, strict=True):
                if u != unit:
                    solve(unit, rows, out)
                    unit, rows = u, []
                rows.append(r)
            if len(out) > 10_000:
                yield flush()
        solve(unit, rows, out)
        yield flush()

    return run


def _first_meeting(rows: list, i: np.ndarray, j: np.ndarray, leaf: int) -> np.ndarray:
    """Which pairs meet in no leaf of a lower key."""
    lower = [[x for x in r[4] if x < leaf] for r in rows]
    names = sorted({x for of in lower for x in of})
    met = np.zeros(len(i), bool)
    place = {x: k for k, x in enumerate(names)}
    step = 256
    for at in range(0, len(names), step):
        part = np.zeros((len(rows), step), np.float32)
        for k, of in enumerate(lower):
            for x in of:
                c = place[x] - at
                if 0 <= c < step:
                    part[k, c] = 1
        together = part @ part.T
        met |= together[i, j] > 0
    return ~met


# --- components ---------------------------------------------------------------

def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): the least node of each component of the edges (a, b).

    Alternating large-star and small-star steps; each is a minimum for each node and a
    join, so a node of very many edges is split like any skewed join. Every round is
    written to the shared folder.
    """
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), name)
    mark = None
    while True:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(small_least, "a").select(F.col("b").alias("x"), "m").union(small_least.select("a", "m"))
                 .filter("x <> m").distinct())
        now = written(small.select(F.col("x").alias("a"), F.col("m").alias("b")), name)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(state)


# --- the join -----------------------------------------------------------------

def similar(docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE, recall: float = RECALL,
            depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK,
            bits: int = 1 << 24) -> DataFrame:
    """One row for each distinct (id, text): ``row_key``, ``id``, ``rows`` (how often it
    occurs), ``root`` (its class), ``n_links`` and ``n_texts``.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. Rows of
    the same token set are copies: one of them is compared for all. Classes are the
    connected components of the links; ``root`` is a row key of the class. ``n_links`` is
    the number of other rows whose similarity to this one reaches the threshold, copies
    included, and ``n_texts`` that of the different token sets among them. Texts without
    words (null, empty) link with nothing, not even with each other. Repeated rows are
    copies. An empty table gives no rows; other columns are ignored, whatever their names.

    Scale: sets are collapsed to distinct ones first; leaves and links are narrow rows;
    token sets travel only of rows that met another in a leaf. A leaf of more than
    ``block`` sets (or ``BLOCK_TOKENS`` tokens) is compared in pairs of blocks by as many tasks. No pair leaves a task:
    links are counted where they are found, and each unit gives connecting edges, fewer
    than it has sets.
    """
    runs = runs_for(recall, depth)
    rows = keyed(docs, id_col, text_col)
    id_type = docs.schema[id_col].dataType.simpleString()
    table = written(rows.select("row_key", F.col("doc_id").alias("id"), "text").mapInArrow(
        _sets(similarity, runs, depth, shingle),
        f"row_key binary, id {id_type}, set_id binary, size bigint, leaves array<bigint>"), "sets")
    reps = (table.filter("set_id IS NOT NULL").groupBy("set_id")
            .agg(F.min("row_key").alias("rep"), F.count("*").alias("copies"), F.first("size").alias("size"),
                 F.first("leaves").alias("leaves")))
    reached = reps.select("rep", "copies", "size", F.explode("leaves").alias("leaf"))
    counts = (reached.groupBy("leaf").agg(F.count("*").alias("n"), F.sum("size").alias("tokens"),
                                          F.sum(F.xxhash64("rep").cast("decimal(20,0)")).alias("members")).filter("n > 1"))
    # leaves with the same members are compared once
    blocks = F.least("n", F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("tokens") / BLOCK_TOKENS))).cast("int")
    leaves = counts.groupBy("members", "n", "tokens").agg(F.min("leaf").alias("leaf")).select("leaf", blocks.alias("blocks"))
    met = written(reached.join(leaves, "leaf").select("leaf", "blocks", "rep", "copies"), "met")
    own = met.groupBy("rep").agg(F.array_sort(F.collect_list("leaf")).alias("leaves"))
    found = hash_bitmap(met.select(F.xxhash64("rep").alias("h")), "h", bits)
    tokens = (rows.select(F.xxhash64("row_key").alias("h"), "row_key", "text")
              .mapInArrow(_tokens_of(found, bits, shingle), "rep binary, tokens binary").dropDuplicates(["rep"]))
    members = (met.withColumn("block", F.pmod(F.xxhash64("rep", "leaf"), F.col("blocks")).cast("int"))
               .withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    units = (members.join(own.join(tokens, "rep"), "rep")
             .select("leaf", F.least("block", "partner").alias("low"), F.greatest("block", "partner").alias("high"), "block", "rep",
                     "copies", "tokens", "leaves"))
    compared = written(units.repartition("leaf", "low", "high").sortWithinPartitions("leaf", "low", "high")
                       .mapInArrow(_compare(similarity), _LINKS), "links")
    links = compared.filter("other IS NULL").groupBy("rep").agg(F.sum("links").alias("links"), F.sum("texts").alias("texts"))
    roots = components(compared.filter("other IS NOT NULL").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    classes = (reps.select("set_id", "rep", "copies").join(links, "rep", "left")
               .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
               .select("set_id", F.coalesce("root", "rep").alias("root"),
                       (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                       F.coalesce("texts", F.lit(0)).cast("bigint").alias("n_texts")))
    each = table.groupBy("row_key", "set_id").agg(F.first("id").alias("id"), F.count("*").alias("rows"))
    return each.join(classes, "set_id", "left").select(
        "row_key", "id", "rows", F.coalesce("root", "row_key").alias("root"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("n_texts", F.lit(0)).cast("bigint").alias("n_texts"))


def near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """Query rows: for each document the least id of its class, its links, and whether it is that document."""
    s = written(similar(docs, **settings), "similar")
    # as a table of its own, so that a class of very many rows is split in the join
    first = written(s.groupBy("root").agg(F.min("id").alias("class_id"), F.sum("rows").alias("class_size")), "classes")
    return (s.join(first, "root").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "rows")))
            .select(F.col("id").alias("doc_id"), "class_id", "class_size", "n_links", "n_texts"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 1 << 24, **settings) -> DataFrame:
    """One row of ``docs`` from each class, with all its columns: the one of least id, then of least row key.

    Rows with a null id come last. Repeated rows leave one. Rows of no other in their
    class are passed on where they are read; only the others are shuffled.
    """
    s = written(similar(docs, id_col=id_col, text_col=text_col, **settings), "similar")
    # texts without words are no copies of each other, but repeated rows are
    best = s.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"),
                                                F.col("row_key").alias("row_key"))).alias("best"), F.sum("rows").alias("n"))
    best = written(best, "classes")
    shared = written(s.join(best.filter("n > 1"), "root")
                     .select("row_key", (F.col("row_key") == F.col("best.row_key")).alias("stays")), "shared")
    found = hash_bitmap(shared.select(F.xxhash64("row_key").alias("h")), "h", bits)
    names = docs.columns
    rows = docs.select(row_key(id_col, text_col).alias("row_key"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    h = F.xxhash64("row_key")
    alone = in_place(rows, found, bits, h, has=False)
    others = (in_place(rows, found, bits, h, has=True).join(shared, "row_key", "left")
              .filter(F.coalesce("stays", F.lit(True))).drop("stays").dropDuplicates(["row_key"]))
    return alone.unionByName(others).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])

"""Language-model scoring by a hashed maximum-entropy model.

A token's probability is that of its class given the tokens before it, times that of
the token in its class. Both factors are softmaxes over sums of hashed feature weights:
the last token, the last two, and skips to the second and third last. The most frequent
words lie in classes of few members; every other word lies in a class by its ending, and
there at a leaf of a Huffman tree of all words that training counted, whose branches are
learned two-way softmaxes that start from the counts below them. Every counted word is a
feature by itself; the others are features by their ending. Weights are trained by
learners that each walk their own part of the corpus and are averaged after each round;
the number of weights grows with the counted distinct words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.llm import words as W
from tableflow.llm.common import arrow_batches, shuffles_removed, signed, written

#: words whose counts every task knows; the others meet theirs in a join
LOCAL_WORDS = 1 << 18
#: codes of the words that training did not count
ENDINGS = 256
#: classes of frequent words and their members; then classes of endings
LEARNED, MEMBERS, OTHERS = 16, 16, 16
CLASSES = LEARNED + OTHERS
#: least rows of the hashed weight tables, and distinct words that one row stands for at most;
#: half of the rows are for features of one token and half for those of two, and the rows of
#: features without a token come after them
LEAST_BITS, ROW_WORDS = 16, 32
#: least weights of the branches, and weights for each distinct word at least
LEAST_BRANCH_BITS, WORD_BRANCHES = 16, 2
#: tasks that train at the same time; what a round moves is this many models
LEARNERS = 24
ROUNDS = 2
RATE = 0.15
BRANCH_RATE = 0.5
SMOOTH = 0.1

END = np.uint64(0x5851F42D4C957F2D)  # hash of the end token
_BEFORE = np.uint64(ENDINGS)  # code of what stands before a text
_BLOCK = 512  # weight rows of one row of a model's table
_BRANCHES = 1 << 15  # branch weights of one row of a model's table
#: sums of logits are kept within this, so that their exponentials are finite
_LOGIT = np.float32(50)
#: columns that are summed by segments at a time
_COLUMNS = 16


def is_held_out(id_col: str) -> Column:
    """crc32 of the id as text, modulo 10, is 0; a null id goes as the empty text (crc32 0)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 10 == 0


# --- tokens -------------------------------------------------------------------

class Tokens:
    """Lower-cased words of the texts of a column, each text closed by an end token."""

    def __init__(self, column: pa.Array) -> None:
        w = W.Words(column, W.BLANK_WORDS, lower=True)
        n = len(w.row) - 1
        total = len(w.start) + n
        at = np.arange(len(w.start)) + w.row_of()
        self.row = w.row + np.arange(n + 1)
        self.hash = np.full(total, END, np.uint64)
        self.hash[at] = w.hash
        self.ending = np.zeros(total, np.int64)
        last = w.data[w.end - 1].astype(np.uint64) if len(w.end) else np.zeros(0, np.uint64)
        second = np.where(w.end - w.start > 1, w.data[np.maximum(w.end - 2, 0)], 0).astype(np.uint64) if len(w.end) else last
        self.ending[at] = (W.mix(last + np.uint64(256) * second + np.uint64(1)) & np.uint64(ENDINGS - 1)).astype(np.int64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, class, n): counts of a partition, merged before they leave it."""

    def merge(parts):
        word, cls, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        u, first, inverse = np.unique(word, return_index=True, return_inverse=True)
        return u, cls[first], np.bincount(inverse, n, len(u)).astype(np.int64)

    def batch(part):
        return pa.RecordBatch.from_arrays([pa.array(signed(part[0])), pa.array(part[1]), pa.array(part[2])], ["word", "cls", "n"])

    parts, held = [], 0
    for b in W.passes(batches, "text"):
        t = Tokens(b.column(0))
        u, first, n = np.unique(t.hash, return_index=True, return_counts=True)
        parts.append((u, t.ending[first] % OTHERS, n.astype(np.int64)))
        held += len(u)
        if held > 600_000:
            parts = [merge(parts)]
            held = len(parts[0][0])
            if held > 300_000:
                yield batch(parts.pop())
                held = 0
    if parts:
        yield batch(merge(parts))


# --- the model ----------------------------------------------------------------

@dataclass
class Trees:
    """A Huffman tree for each class of endings over its counted words; about 30 bytes a word."""

    hash: np.ndarray  # of all counted words but the learned ones, ascending
    leaf: np.ndarray
    parent: np.ndarray  # of every node; -1 above a root
    right: np.ndarray  # is the node a right child?
    prior: np.ndarray  # of every inner node: log odds of its right child by the counts

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        """Leaf of each word, or -1."""
        if not len(self.hash):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        return np.where(self.hash[at] == hashes, self.leaf[at], -1).astype(np.int64)

    def paths(self, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Branches from each leaf to its root as CSR: offsets, inner nodes, is it the right side."""
        at = np.flatnonzero(leaf >= 0)
        node, parts = leaf[at], []
        depth = np.zeros(len(leaf) + 1, np.int64)
        while len(at):
            up = self.parent[node]
            on = up >= 0
            at, node, up = at[on], node[on], up[on]
            parts.append((at, up, self.right[node]))
            depth[at + 1] += 1
            node = up
        offset = np.cumsum(depth)
        inner, right = np.empty(offset[-1], np.int64), np.empty(offset[-1], bool)
        for level, (at, up, side) in enumerate(parts):
            inner[offset[at] + level], right[offset[at] + level] = up, side
        return offset, inner, right


def huffman(mass: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parents, sides and prior log odds of the nodes: the leaves by ascending mass, then the inner ones."""
    n = len(mass)
    m = mass.tolist()
    parent, right, prior = np.full(2 * n - 1, -1, np.int32), np.zeros(2 * n - 1, bool), np.zeros(2 * n - 1, np.float32)
    leaf, inner, pairs = 0, n, []
    for _ in range(n - 1):
        pair = []
        for _ in range(2):
            if leaf < n and (inner >= len(m) or m[leaf] <= m[inner]):
                pair.append(leaf)
                leaf += 1
            else:
                pair.append(inner)
                inner += 1
        pairs.append(pair)
        m.append(m[pair[0]] + m[pair[1]])
    if pairs:
        pairs, m, top = np.array(pairs), np.array(m), np.arange(n, 2 * n - 1)
        parent[pairs[:, 0]] = parent[pairs[:, 1]] = top
        right[pairs[:, 1]] = True
        prior[top] = np.log(m[pairs[:, 1]] / m[pairs[:, 0]])
    return parent, right, prior


def _tree(pdf):
    """The tree of one class, as bytes."""
    import pandas as pd

    word, n = pdf["word"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
    order = np.lexsort((word, n))
    parts = (word[order], *huffman(n[order] + SMOOTH))
    return pd.DataFrame({k: [x.tobytes()] for k, x in zip(("word", "parent", "rightside", "prior"), parts, strict=True)})


def trees_of(counts: DataFrame) -> Trees:
    """The trees of the words (word, cls, n), each made by a task; the driver gets the arrays only."""
    words, leaves, parents, right, prior, at = [], [], [], [], [], 0
    for r in counts.groupBy("cls").applyInPandas(_tree, "word binary, parent binary, rightside binary, prior binary").toLocalIterator():
        words.append(np.frombuffer(r["word"], np.uint64))
        parent = np.frombuffer(r["parent"], np.int32)
        leaves.append(np.arange(at, at + len(words[-1]), dtype=np.int32))
        parents.append(np.where(parent >= 0, parent + np.int32(at), np.int32(-1)))
        right.append(np.frombuffer(r["rightside"], bool))
        prior.append(np.frombuffer(r["prior"], np.float32))
        at += len(parent)
    if not words:
        return Trees(np.zeros(0, np.uint64), *(np.zeros(0, np.int32),) * 2, np.zeros(0, bool), np.zeros(0, np.float32))
    hashes = np.concatenate(words)
    order = np.argsort(hashes)
    return Trees(hashes[order], np.concatenate(leaves)[order], *(np.concatenate(x) for x in (parents, right, prior)))


@dataclass
class Lexicon:
    """What is known of the corpus before training: counts of a bounded number of words, and the trees of all."""

    hash: np.ndarray  # of the local words, ascending
    count: np.ndarray
    rank: np.ndarray  # by falling count
    tokens: int  # of the training texts
    distinct: int
    class_tokens: np.ndarray  # by class of endings, without the learned words
    class_distinct: np.ndarray
    trees: Trees

    @property
    def bits(self) -> int:
        """Of the rows of the weight tables."""
        return max(LEAST_BITS, int(np.ceil(np.log2(max(self.distinct, 1) / ROW_WORDS))))

    @property
    def branch_bits(self) -> int:
        return max(LEAST_BRANCH_BITS, int(np.ceil(np.log2(max(self.distinct, 1) * WORD_BRANCHES))))

    @property
    def rows(self) -> int:
        return (1 << self.bits) + _BLOCK

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or a large number) and count (or -1) of each word."""
        if not len(self.hash):
            return np.full(len(hashes), 1 << 40), np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        hit = self.hash[at] == hashes
        return np.where(hit, self.rank[at], 1 << 40), np.where(hit, self.count[at], -1)


@dataclass
class Weights:
    classes: np.ndarray  # rows x CLASSES
    members: np.ndarray  # rows x MEMBERS
    branches: np.ndarray


def _key(family: int, a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x += np.atleast_1d(np.asarray(b, dtype=np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
    x += np.uint64(family * 0x165667B19E3779F9 % (1 << 64))
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x


def _slot(key: np.ndarray, bits: int) -> np.ndarray:
    return (key >> np.uint64(64 - bits)).astype(np.int64)


def feature_keys(code: np.ndarray, row: np.ndarray) -> list[np.ndarray]:
    """Keys of the features of every token, from the codes of the tokens before it; the last is of two tokens."""
    n = len(code)
    place = np.arange(n) - np.repeat(row[:-1], np.diff(row))

    def back(k: int) -> np.ndarray:
        out = np.full(n, _BEFORE, np.uint64)
        out[k:] = code[:n - k] if n > k else code[:0]
        out[place < k] = _BEFORE
        return out

    one, two, three = back(1), back(2), back(3)
    return [_key(1, one, 0), _key(2, two, 0), _key(3, three, 0), _key(4, one, two + np.uint64(1))]


def feature_slots(keys: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """Rows of the features; the first is that without a token."""
    low = [0, 0, 0, 1 << (bits - 1)]
    return [np.full(len(keys[0]), 1 << bits), *[_slot(k, bits - 1) + a for k, a in zip(keys, low, strict=True)]]


def member_slots(slots: list[np.ndarray], cls: np.ndarray, bits: int) -> list[np.ndarray]:
    """Slots of the same features for the words of one class; the first is the class's own."""
    return [(1 << bits) + cls if i == 0 else _slot(_key(5, s, cls + 1), bits) for i, s in enumerate(slots)]


class Batch:
    """Codes, classes and features of the tokens of one column."""

    def __init__(self, column: pa.Array, lexicon: Lexicon) -> None:
        t = Tokens(column)
        self.row, self.hash = t.row, t.hash
        u, self.word = np.unique(t.hash, return_inverse=True)
        rank, count = lexicon.look_up(u)
        self.rank, self.count = rank[self.word], count[self.word]
        self.learned = self.rank < LEARNED * MEMBERS
        leaf = np.where(rank < LEARNED * MEMBERS, -1, lexicon.trees.look_up(u))
        self.path, self.inner, self.right = lexicon.trees.paths(leaf)
        code = np.where(self.learned | (leaf >= 0)[self.word], t.hash, t.ending.astype(np.uint64))
        self.cls = np.where(self.learned, self.rank // MEMBERS, LEARNED + t.ending % OTHERS)
        self.member = np.where(self.learned, self.rank % MEMBERS, 0)
        self.keys = feature_keys(code, t.row)
        self.slots = feature_slots(self.keys, lexicon.bits)

    def branches(self, part: slice, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Branches on the ways to the tokens of a part: token, place in ``inner`` and ``right``, weights (features x branches)."""
        word = self.word[part]
        n = self.path[word + 1] - self.path[word]
        token = np.repeat(np.arange(len(word)), n)
        at = np.arange(len(token))
        at += np.repeat(self.path[word] - np.cumsum(n) + n, n)
        salt = (self.inner[at].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        slots = np.empty((len(self.keys), len(token)), np.int64)
        for i, k in enumerate(self.keys):
            x = np.repeat(k[part], n)
            x += salt
            x ^= x >> np.uint64(32)
            x *= np.uint64(0x94D049BB133111EB)
            np.right_shift(x, np.uint64(64 - bits), out=slots[i].view(np.uint64))
        return token, at, slots


def _logits(table: np.ndarray, slots: list[np.ndarray]) -> np.ndarray:
    x = table.take(slots[0], axis=0)
    for s in slots[1:]:
        x += table.take(s, axis=0)
    return np.clip(x, -_LOGIT, _LOGIT, out=x)


def _log_softmax(table: np.ndarray, slots: list[np.ndarray]) -> np.ndarray:
    x = _logits(table, slots)
    x -= np.log(np.exp(x) @ np.ones(x.shape[1], np.float32))[:, None]
    return x


def _log_of(table: np.ndarray, slots: list[np.ndarray], target: np.ndarray) -> np.ndarray:
    """The entry of ``_log_softmax`` that each token has."""
    x = _logits(table, slots)
    own = x[np.arange(len(target)), target]
    return own - np.log(np.exp(x, out=x) @ np.ones(x.shape[1], np.float32))


def _update(table: np.ndarray, squares: np.ndarray, seen: np.ndarray, slots: list[np.ndarray], target: np.ndarray, rate: float) -> None:
    """One AdaGrad step on the gradient of a few thousand tokens. Each row is read once, and summed only where it is met again."""
    n = len(target)
    flat = (np.concatenate(slots) << 16) + np.arange(n * len(slots))  # a step has less than 2**16 features
    flat.sort()
    place = flat & 0xFFFF
    flat >>= 16
    head = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    at = flat[head]
    met = np.diff(np.append(head, len(flat)))
    rows = table.take(at, axis=0)
    of = np.empty(len(flat), np.int64)
    of[place] = np.repeat(np.arange(len(at)), met)
    error = rows.take(of[:n], axis=0)
    for a in range(n, len(of), n):
        error += rows.take(of[a:a + n], axis=0)
    np.exp(np.clip(error, -_LOGIT, _LOGIT, out=error), out=error)
    error /= (error @ np.ones(error.shape[1], np.float32))[:, None]
    error[np.arange(n), target] -= 1
    token = place % n
    g = error.take(token[head], axis=0)
    more = met > 1
    if more.any():
        again, length = token[np.repeat(more, met)], met[more]
        edge = np.cumsum(length) - length
        # a few columns at a time: short rows are summed several times as fast
        sums = np.concatenate([np.add.reduceat(np.ascontiguousarray(error[:, c:c + _COLUMNS]).take(again, axis=0), edge, axis=0)
                               for c in range(0, error.shape[1], _COLUMNS)], axis=1)
        sums /= np.sqrt(length, dtype=np.float32)[:, None]  # rows that are met often take steps of a bounded size
        g[more] = sums
    square = squares.take(at, axis=0)
    square += g * g
    squares[at] = square
    g *= rate
    g /= np.sqrt(square, out=square)
    rows -= g
    table[at] = rows
    seen[at] += met


def _branch_logits(table: np.ndarray, prior: np.ndarray, slots: np.ndarray) -> np.ndarray:
    x = prior.copy()
    for s in slots:
        x += table.take(s)
    return np.clip(x, -_LOGIT, _LOGIT, out=x)


def _update_branches(table: np.ndarray, sums: np.ndarray, prior: np.ndarray, slots: np.ndarray, right: np.ndarray, rate: float) -> None:
    """One AdaGrad step; ``table`` has each weight beside its sum of squares, as one complex number that is read once.

    ``sums`` is all zero before and after. A weight that occurs again is set again to the same.
    """
    flat = slots.ravel()
    own = table.take(flat)
    weight, square = own.real, own.imag
    x = prior.copy()
    for w in weight.reshape(slots.shape):
        x += w
    error = 1 / (1 + np.exp(-np.clip(x, -_LOGIT, _LOGIT, out=x)))
    error -= right
    np.add.at(sums, flat, np.tile(error, len(slots)))
    g = sums.take(flat)
    sums[flat] = 0
    square += g * g
    g *= rate
    g /= np.sqrt(square)
    weight -= g
    table[flat] = own


def _learn(model, lexicon, round_no: int):
    """mapInArrow function: one learner's walk over its texts; out come its weights, by blocks of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, start = lexicon.value, model.value
        classes, members = start.classes.copy(), start.members.copy()
        branches = start.branches.astype(np.complex64)
        branches.imag = 1
        sums = np.zeros(len(branches), np.float32)
        squares = [np.full_like(classes, 1e-3), np.full_like(members, 1e-3)]
        seen = [np.zeros(len(classes), np.float32), np.zeros(len(members), np.float32)]
        branch_rate = np.float32(BRANCH_RATE / (1 + round_no))
        rate = np.float32(RATE / (1 + round_no))
        step = 4096
        for b in W.passes(batches, "text"):
            x = Batch(b.column(0), lex)
            for a in range(0, len(x.cls), step):
                part = slice(a, a + step)
                slots = [s[part] for s in x.slots]
                _update(classes, squares[0], seen[0], slots, x.cls[part], rate)
                of = np.flatnonzero(x.learned[part])
                if len(of):
                    cls = x.cls[part][of]
                    _update(members, squares[1], seen[1], member_slots([s[of] for s in slots], cls, lex.bits), x.member[part][of], rate)
                _, at, slots = x.branches(part, lex.branch_bits)
                if len(at):
                    _update_branches(branches, sums, lex.trees.prior[x.inner[at]], slots, x.right[at], branch_rate)
        # what changed, each weight with how much it was met
        branches.imag -= 1
        for kind, table, old, n, size in (("classes", classes, start.classes, seen[0], _BLOCK), ("members", members, start.members, seen[1], _BLOCK),
                                          ("branches", branches.real, start.branches, branches.imag, _BRANCHES)):
            for a in range(0, len(n), size):
                met = n[a:a + size]
                if met.any():
                    change = (table[a:a + size] - old[a:a + size]).astype(np.float16)
                    if kind == "branches":
                        met = np.minimum(met, 6e4).astype(np.float16)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([kind]), pa.array([a], pa.int64()), pa.array([change.tobytes()], pa.binary()), pa.array([met.tobytes()], pa.binary())],
                        ["kind", "block", "change", "met"])

    return run


_CHANGES = "kind string, block bigint, change binary, met binary"


def _average(pdf):
    """One block of rows of all learners (LEARNERS of them at most) to the mean of their changes."""
    import pandas as pd

    kind = pdf["kind"].iloc[0]
    change, total = 0.0, 0.0
    for x, m in zip(pdf["change"], pdf["met"], strict=True):
        n = np.frombuffer(m, np.float16 if kind == "branches" else np.float32).astype(np.float64)
        change = change + np.frombuffer(x, np.float16).astype(np.float64).reshape(len(n), -1) * n[:, None]
        total = total + n
    change /= np.maximum(total, 1e-9)[:, None]
    return pd.DataFrame({"kind": [kind], "block": [pdf["block"].iloc[0]], "change": [change.astype(np.float32).tobytes()]})


def lexicon_of(training: DataFrame) -> tuple[Lexicon, DataFrame]:
    """The lexicon, and the table (word, cls, n) of all training words."""
    with shuffles_removed(training.sparkSession):
        counts = written(training.select("text").mapInArrow(_count_words, "word bigint, cls bigint, n bigint")
                         .groupBy("word").agg(F.min("cls").alias("cls"), F.sum("n").alias("n")), "word_counts")
    # the words that tasks know are those above a count that leaves LOCAL_WORDS at most
    grade = F.floor(F.log2("n") * 16).cast("int")
    grades = sorted(counts.groupBy(grade.alias("g")).agg(F.count("*").alias("words")).collect(), key=lambda r: -r["g"])
    total, least = 0, 1 << 20
    for r in grades:
        if total + r["words"] > LOCAL_WORDS:
            break
        total, least = total + r["words"], r["g"]
    local = counts.filter((grade >= least) | (F.col("word") == int(END.view(np.int64)))).toPandas()
    order = np.lexsort((local["word"].to_numpy(np.int64), -local["n"].to_numpy(np.int64)))
    word, n = local["word"].to_numpy(np.int64)[order], local["n"].to_numpy(np.int64)[order]
    end = np.flatnonzero(word == END.view(np.int64))
    if len(end) and end[0] >= LEARNED * MEMBERS:  # the end token is always a learned one
        at = np.concatenate([np.arange(LEARNED * MEMBERS - 1), end, np.setdiff1d(np.arange(LEARNED * MEMBERS - 1, len(word)), end)])
        word, n = word[at], n[at]
    hashes = word.view(np.uint64)
    by_hash = np.argsort(hashes)
    sums = counts.groupBy("cls").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    tokens, distinct = np.zeros(OTHERS, np.int64), np.zeros(OTHERS, np.int64)
    for r in sums:
        tokens[r["cls"]], distinct[r["cls"]] = r["n"], r["v"]
    all_tokens, all_distinct = int(tokens.sum()), int(distinct.sum())
    trees = trees_of(counts.filter(~F.col("word").isin(word[:LEARNED * MEMBERS].tolist())))
    learned = dict(zip(local["word"].tolist(), local["cls"].tolist(), strict=True))
    for w, c in zip(word[:LEARNED * MEMBERS].tolist(), n[:LEARNED * MEMBERS].tolist(), strict=True):
        tokens[learned[w]] -= c
        distinct[learned[w]] -= 1
    return Lexicon(hashes[by_hash], n[by_hash], np.arange(len(word))[by_hash], all_tokens, all_distinct, tokens, distinct, trees), counts


def starting_weights(lexicon: Lexicon) -> Weights:
    """Weights that give class and member frequencies whatever the context."""
    top = np.zeros(LEARNED * MEMBERS)
    first = lexicon.rank < LEARNED * MEMBERS
    top[lexicon.rank[first]] = lexicon.count[first]
    slots = 1 << lexicon.bits
    members = np.zeros((lexicon.rows, MEMBERS), np.float32)
    members[slots:slots + LEARNED] = np.log(top.reshape(LEARNED, MEMBERS) + SMOOTH)
    classes = np.zeros((lexicon.rows, CLASSES), np.float32)
    classes[slots] = np.log(np.concatenate([top.reshape(LEARNED, MEMBERS).sum(axis=1), lexicon.class_tokens]) + 1.0)
    return Weights(classes, members, np.zeros(1 << lexicon.branch_bits, np.float32))


def train(training: DataFrame, lexicon: Lexicon) -> Weights:
    """One walk over all training texts (id hash, text), a share of them in each round.

    Each of at most ``LEARNERS`` tasks starts a round from the same weights and sends
    back what it changed, as many bytes as the model has whatever its share; weights are
    averaged, block by block, by how much each learner met them.
    """
    spark = training.sparkSession
    sc = spark.sparkContext
    shared = sc.broadcast(lexicon)
    weights = starting_weights(lexicon)
    for k in range(ROUNDS):
        share = training.filter(F.pmod(F.xxhash64("share"), F.lit(ROUNDS)) == k).select("text").coalesce(LEARNERS)
        start = sc.broadcast(weights)
        learned = share.mapInArrow(_learn(start, shared, k), _CHANGES)
        with shuffles_removed(spark):  # the models of a round are not kept beside those of the next
            rows = written(learned.groupBy("kind", "block").applyInPandas(_average, "kind string, block bigint, change binary"), "round")
        for r in rows.toLocalIterator():
            table = getattr(weights, r["kind"])
            change = np.frombuffer(r["change"], np.float32).reshape(-1, *table.shape[1:])
            table[r["block"]:r["block"] + len(change)] += change
        start.destroy()  # its files too
    shared.destroy()
    return weights


def _log_aside(logit: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Minus the log probability of each branch's side."""
    x = logit * np.where(right, np.float32(-1), np.float32(1))
    return np.log1p(np.exp(x, out=x), out=x)


def log10_probabilities(x: Batch, weights: Weights, lexicon: Lexicon, step: int = 8192) -> np.ndarray:
    """log10 of each token's probability, for words of other classes without the factor of their count.

    That factor is (count + SMOOTH); what it is divided by is in here, and so is what the
    context changes on the way to the word's leaf.
    """
    out = np.zeros(len(x.cls))
    spread = np.log10(lexicon.class_tokens + SMOOTH * (lexicon.class_distinct + 1))
    by_counts = _log_aside(lexicon.trees.prior[x.inner], x.right)  # once for each word, not for each token
    for a in range(0, len(out), step):
        part = slice(a, a + step)
        slots = [s[part] for s in x.slots]
        cls = x.cls[part]
        p = _log_of(weights.classes, slots, cls) / np.log(10)
        of = np.flatnonzero(x.learned[part])
        if len(of):
            p[of] += _log_of(weights.members, member_slots([s[of] for s in slots], cls[of], lexicon.bits), x.member[part][of]) / np.log(10)
        others = ~x.learned[part]
        p[others] -= spread[cls[others] - LEARNED]
        token, at, slots = x.branches(part, lexicon.branch_bits)
        if len(token):
            logit = _branch_logits(weights.branches, lexicon.trees.prior[x.inner[at]], slots)
            p += np.bincount(token, by_counts[at] - _log_aside(logit, x.right[at]), len(p)) / np.log(10)
        out[part] = p
    return out


def _score(model, lexicon):
    """mapInArrow function: (id, held_out, text) to sums over the local words, and the other words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, weights = lexicon.value, model.value
        number = TaskContext.get().partitionId() << 33
        scale = np.log10(lex.tokens + SMOOTH * (lex.distinct + 1)) if lex.distinct else np.log10(SMOOTH)
        for b in W.passes(batches, "text"):
            x = Batch(b.column(2), lex)
            local = x.count >= 0
            own = np.where(local, np.log10(np.maximum(x.count, 0) + SMOOTH), 0.0)
            p = log10_probabilities(x, weights, lex)
            p += np.where(x.learned, 0.0, own)

            def per_row(v):
                return np.add.reduceat(v, x.row[:-1])  # every text has its end token  # noqa: B023

            n = np.diff(x.row)
            rest = np.flatnonzero(~local)
            edge = np.searchsorted(rest, x.row)
            others = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(signed(x.hash[rest])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(number + np.arange(b.num_rows)), b.column(0), b.column(1), pa.array(n),
                 pa.array(per_row(local.astype(np.int64))), pa.array(per_row(own) - n * scale), pa.array(per_row(p)),
                 others.cast(pa.list_(pa.field("element", pa.int64())))],
                ["row", "id", "held_out", "n_tokens", "n_known", "base", "score", "others"])
            number += b.num_rows

    return run


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score of every whole text by the model of the texts that are not held out.

    Returns ``id_col``, ``held_out``, ``n_tokens`` (words and one end), ``n_known`` (tokens
    seen in training), ``train_tokens``, ``base_score`` (smoothed unigrams) and ``score``
    (log10 probability by the model; over all words and one unknown it sums to 1).

    A null or empty text is an end token alone. Repeated rows are scored each and train
    each. If nothing is left to train on, no word is known, and the model is that of its
    starting weights. An empty table gives no rows; other columns are ignored, whatever
    their names.

    All training texts count and train. Counts are summed before each shuffle; the words
    of highest counts (``LOCAL_WORDS`` at most) are broadcast; every other word meets its
    count in a join, where no key is frequent. The trees of all counted words and the
    weights are broadcast too: they grow with the distinct words of the corpus, and the
    driver and every learner hold them whole.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    rows = docs.select(F.col(id_col).alias("id"), is_held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    training = rows.filter("NOT held_out").select(F.col("id").cast("string").alias("share"), "text")
    lexicon, counts = lexicon_of(training)
    weights = train(training, lexicon)
    shared = [spark.sparkContext.broadcast(x) for x in (weights, lexicon)]
    kind = docs.schema[id_col].dataType.simpleString()
    scored = written(rows.mapInArrow(
        _score(*shared),
        f"row bigint, id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, others array<bigint>"), "scored")
    for x in shared:
        x.destroy()  # the scores are on storage: nothing reads the model again
    rest = (scored.select("row", F.explode("others").alias("word")).join(counts.select("word", "n"), "word", "left")
            .groupBy("row").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + SMOOTH)).alias("own"), F.count("n").alias("known")))
    own = F.coalesce("own", F.lit(0.0))
    return scored.join(rest, "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(lexicon.tokens).cast("bigint").alias("train_tokens"), (F.col("base") + own).alias("base_score"),
        (F.col("score") + own).alias("score"))

r"""Conversation structure repair by weighted interval parsing.

A repaired conversation's role initials read ``(s?(ua)+)?``. The rows of a conversation are
the word to parse, and the grammar derives the edits of a row from its symbols:

* The symbols are pairs (p, q) of places in the expression: 0 at its start, 1 after the
  ``s``, 2 between a ``u`` and its ``a``, 3 after an ``a``. A pair derives the spans that
  lead from p to q, so every binary rule is (p, q) -> (p, r) (r, q): Chomsky normal form.
* A row is a terminal of (p, p) deleted, of (p, q) kept if its initial leads there, and of
  (p, q) reroled if ``u`` or ``a`` does.
* Insertions span no rows. Their closure, the cheapest insertions that lead from p to q,
  stands on both sides of every cell.

A cell holds for each pair the least (cost, audit). As every derivation of a span passes
each point inside it at some place r, and costs and audits compose (two audits of a span
with one cost and one pair are never one the start of the other), one split of a span
gives what all splits would. Spans are joined bottom-up by length: 1, 2, 4, ... rows.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.llm.common import arrow_batches, written

#: fixed values of the contract: costs of the edits, and what a truncated row adds
RETAG, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: place -> (initial -> place)
MOVES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: places where a conversation may end
ENDS = (0, 3)
_PLACES = range(len(MOVES))
_BLANKS = " \t\n\x0b\x0c\r"

Cell = dict  # (p, q) -> (cost, audit)


def _least(cell: Cell, pair: tuple[int, int], derived: tuple[int, str]) -> None:
    known = cell.get(pair)
    if known is None or derived < known:
        cell[pair] = derived


def join(left: Cell, right: Cell) -> Cell:
    """Cell of two adjacent spans: (p, q) -> (p, r) (r, q)."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in _PLACES:
            other = right.get((r, q))
            if other is not None:
                _least(out, (p, q), (cost + other[0], audit + other[1]))
    return out


def _closure() -> Cell:
    """Cheapest insertions, spanning no rows, that lead from one place to another."""
    out: Cell = {(p, p): (0, "") for p in _PLACES}
    step: Cell = dict(out)
    for p in _PLACES:
        for initial in "ua":
            if initial in MOVES[p]:
                _least(step, (p, MOVES[p][initial]), (INSERT, "I"))
    for _ in _PLACES:
        out = join(out, step)
    return out


CLOSURE = _closure()
_units: dict[tuple, Cell] = {}


def unit(initial: str, fault: str) -> Cell:
    """Cell of one row by its role's initial and its fault."""
    known = _units.get((initial, fault))
    if known is None:
        row: Cell = {}
        extra = TRUNCATED if fault == "truncated" else 0
        for p in _PLACES:
            _least(row, (p, p), (DELETE, "D"))
            if fault in ("blank", "duplicate"):
                continue
            if initial in MOVES[p]:
                _least(row, (p, MOVES[p][initial]), (extra, "K"))
            for other in "ua":
                if other in MOVES[p]:
                    _least(row, (p, MOVES[p][other]), (RETAG + extra, "R"))
        known = join(join(CLOSURE, row), CLOSURE)
        if len(_units) < 4096:  # roles are free text
            _units[(initial, fault)] = known
    return known


class Chart:
    """Cells of adjacent spans, shortest last; two of one length become one of twice it."""

    def __init__(self) -> None:
        self.spans: list[tuple[int, Cell]] = []

    def add(self, cell: Cell) -> None:
        size = 1
        while self.spans and self.spans[-1][0] == size:
            cell, size = join(self.spans.pop()[1], cell), 2 * size
        self.spans.append((size, cell))

    def whole(self) -> Cell:
        out = CLOSURE
        for _, cell in reversed(self.spans):
            out = join(cell, out)
        return out


def cheapest(cell: Cell) -> tuple[int, str]:
    return min(cell[(0, q)] for q in ENDS if (0, q) in cell)


def damage(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text`` of the rows after a damage that their own name decides.

    crc32 of ``conv:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 takes its
    ``.!?`` away, 3 repeats it, 4 makes it a user's. A null id or turn is one space in the
    name, a null role or text is one space.
    """
    name = F.concat(F.coalesce(F.col(conv_col).cast("string"), F.lit(" ")), F.lit(":"),
                    F.coalesce(F.col(turn_col).cast("string"), F.lit(" ")))
    kind, text = F.crc32(name) % 20, F.coalesce(F.col(text_col), F.lit(" "))
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(F.coalesce(F.col(role_col), F.lit(" "))).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        kind.alias("kind"))
    return (rows.where(F.col("kind") != 0)
            .withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .select("conv", "turn", "role", "text"))


def _said(role: Column, text: Column) -> Column:
    """Identity of a role and a text, of a fixed size."""
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))


def faulty(rows: DataFrame) -> DataFrame:
    """The rows with ``fault``: blank, duplicate (said at an earlier turn) or truncated, else empty.

    Equal rows of one turn are told apart later, where they stand side by side. The first
    turn of a role and text is a partial aggregate on a digest, joined back, so a text that
    a conversation repeats without end is no group of its own anywhere.
    """
    bare = F.rtrim("text", F.lit(_BLANKS))
    rows = rows.select("*", bare.alias("bare"), _said(F.col("role"), F.col("text")).alias("said"))
    nulls_first = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = (rows.where(F.col("bare") != "").groupBy(F.col("conv").alias("conv_"), F.col("said").alias("said_"))
             .agg(F.min(nulls_first)["turn"].alias("first")))
    joined = rows.join(first, F.col("conv").eqNullSafe(F.col("conv_")) & (F.col("said") == F.col("said_")), "left")
    fault = (F.when(F.col("bare") == "", F.lit("blank")).when(~F.col("turn").eqNullSafe(F.col("first")), F.lit("duplicate"))
             .when(~F.right("bare", F.lit(1)).isin(".", "!", "?"), F.lit("truncated")).otherwise(F.lit("")))
    return joined.select("conv", "turn", "role", "text", fault.alias("fault"))


_ORDER = ("conv", "turn", "role", "text")


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of sorted batches; equal rows side by side after the first are duplicates."""
    before = None
    for batch in batches:
        for row in batch.to_pylist():
            if row.get("kind", 1):
                key = (row["conv"], row["turn"], row["role"], row["text"])
                if key == before and row["fault"] != "blank":
                    row["fault"] = "duplicate"
                before = key
            yield row


class _Piece:
    def __init__(self) -> None:
        self.chart = Chart()
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.turns = 0
        self.first = self.last = None  # initials
        self.least = self.most = None  # turns

    def add(self, row: dict) -> None:
        initial, fault, turn = row["role"][:1], row["fault"], row["turn"]
        self.chart.add(unit(initial, fault))
        if fault:
            self.counts[fault] += 1
        if self.last is None:
            self.first = initial
        elif self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        if turn is not None:
            self.turns += turn != self.most
            self.least = turn if self.least is None else self.least
            self.most = turn

    def summary(self) -> str:
        return json.dumps({**self.counts, "illegal": self.illegal, "turns": self.turns, "first": self.first, "last": self.last,
                           "least": self.least, "most": self.most,
                           "cell": [[p, q, cost, audit] for (p, q), (cost, audit) in self.chart.whole().items()]})


def _pieces(schema: pa.Schema):
    def run(batches):
        number, conv, piece = TaskContext.get().partitionId(), None, None
        done: list[tuple] = []
        for row in _in_order(batches):
            if piece is None or row["conv"] != conv:
                if piece is not None:
                    done.append((conv, piece.summary()))
                conv, piece = row["conv"], _Piece()
            piece.add(row)
            if len(done) >= 1024:
                yield _piece_batch(schema, done, number)
                done = []
        if piece is not None:
            done.append((conv, piece.summary()))
            yield _piece_batch(schema, done, number)

    return run


def _piece_batch(schema: pa.Schema, done: list[tuple], number: int) -> pa.RecordBatch:
    return pa.record_batch([pa.array([c for c, _ in done], schema.field(0).type), pa.array([number] * len(done), pa.int32()),
                            pa.array([s for _, s in done], pa.string())], schema=schema)


class _Verdict:
    """Pieces of one conversation, in order, put together."""

    def __init__(self) -> None:
        self.chart = Chart()
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        self.last = self.least = self.most = None
        self.rows = 0

    def add(self, summary: str) -> None:
        s = json.loads(summary)
        self.chart.add({(p, q): (cost, audit) for p, q, cost, audit in s["cell"]})
        for k in self.sums:
            self.sums[k] += s[k]
        if self.last is not None:
            self.sums["illegal"] += self.last + s["first"] not in ("su", "ua", "au")
        self.last = s["last"]
        if s["least"] is not None:
            self.sums["turns"] -= s["least"] == self.most
            self.least = s["least"] if self.least is None else self.least
            self.most = s["most"]

    def values(self) -> dict:
        cost, audit = cheapest(self.chart.whole())
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.sums["turns"]
        return {"gaps": gaps, **{k: self.sums[k] for k in ("blank", "duplicate", "truncated", "illegal")}, "cost": cost, "audit": audit}


class _Repaired:
    """Walks an audit along the rows of its conversation and gives the repaired turns."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.place = audit, 0, 0

    def _put(self, initial: str) -> None:
        self.place = MOVES[self.place][initial]

    def _next(self) -> str:
        return "a" if self.place == 2 else "u"

    def inserted(self) -> Iterator[tuple]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            initial = self._next()
            self._put(initial)
            yield ("turn", "I", "user" if initial == "u" else "assistant", "")

    def row(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._put(role[0])
            yield ("turn", "K", role, text)
        elif edit == "R":
            initial = self._next()
            self._put(initial)
            yield ("turn", "R", "user" if initial == "u" else "assistant", text)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair(rows: DataFrame, conversations: DataFrame, output: str = "verdicts") -> DataFrame:
    """Repair of ``rows`` (conv, turn, role, text), for every ``conv`` of ``conversations``.

    ``output`` "verdicts": per conversation ``conv``, ``gaps``, ``blank``, ``duplicate``,
    ``truncated``, ``illegal``, ``cost``, ``audit``, ``repaired_sha256`` (of ``role:text``
    lines). "turns": the repaired turns, ``conv``, ``place`` (0, 1, ...), ``edit`` (K, R or
    I), ``role``, ``text``.

    Rows go by turn, a null turn first; ties by role, then text; equal rows are duplicates
    of the first. Rows with a null id are one conversation. A role without an initial (the
    empty text) or with another than s, u, a can be reroled or deleted, not kept. A null
    role or text is taken as one space. A conversation without rows, and an empty table of
    rows, give zeros, an empty audit and the hash of nothing; rows of conversations that
    ``conversations`` lacks give nothing. Ids are bigint or string.

    Rows are dealt by ranges of (conversation, turn, role, text), so a conversation that
    holds a third of them is parsed by many tasks, each giving one cell; a second deal by
    conversation joins the cells and walks the rows once in order, streamed, holding the
    audit alone. The audit is one value of the result, and the hash is taken in order.
    """
    spark = rows.sparkSession
    arrow_batches(spark)
    rows = rows.select("conv", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"))
    conv = rows.schema["conv"].dataType.simpleString()
    if conv not in ("bigint", "string"):
        raise TypeError(f"conversation ids of type {conv}; cast them to bigint or string")
    id_field = pa.field("conv", pa.int64() if conv == "bigint" else pa.string())
    rows = written(faulty(rows), "repair_rows")
    piece = pa.schema([id_field, ("piece", pa.int32()), ("summary", pa.string())])
    pieces = (rows.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
              .mapInArrow(_pieces(piece), f"conv {conv}, piece int, summary string"))
    asked = conversations.select("conv").distinct().withColumn("piece", F.lit(-1))
    told = asked.unionByName(written(pieces, "repair_pieces"), allowMissingColumns=True).withColumn("kind", F.lit(0))
    stream = (told.unionByName(rows.withColumn("kind", F.lit(1)), allowMissingColumns=True)
              .repartition("conv").sortWithinPartitions("conv", "kind", "piece", *_ORDER[1:]))
    if output == "turns":
        schema = pa.schema([id_field, ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
        return stream.mapInArrow(_in_batches(_turns, schema), f"conv {conv}, place bigint, edit string, role string, text string")
    schema = pa.schema([id_field, *[(k, pa.int64()) for k in _COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])
    return stream.mapInArrow(_in_batches(_verdicts, schema), f"conv {conv}, " + ", ".join(f"{k} bigint" for k in _COUNTS)
                             + ", audit string, repaired_sha256 string")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """("begin", conv, verdict), ("turn", edit, role, text) for each repaired turn, ("end",), for each asked conversation."""
    conv = verdict = walker = None

    def begin():
        nonlocal walker
        if walker is None:
            values = verdict.values()
            walker = _Repaired(values["audit"])
            yield ("begin", conv, values)

    def close():
        if verdict is not None:
            yield from begin()
            yield from walker.inserted()
            yield ("end",)

    for row in _in_order(batches):
        if row["kind"] == 0 and row["piece"] < 0:
            yield from close()
            conv, verdict, walker = row["conv"], _Verdict(), None
        elif verdict is None or row["conv"] != conv:
            continue  # a conversation that was not asked for
        elif row["kind"] == 0:
            verdict.add(row["summary"])
        else:
            yield from begin()
            yield from walker.row(row["role"], row["text"])
    yield from close()


def _verdicts(events: Iterator[tuple]) -> Iterator[tuple]:
    for kind, *what in events:
        if kind == "begin":
            (conv, values), sha, between = what, hashlib.sha256(), b""
        elif kind == "turn":
            sha.update(between + f"{what[1]}:{what[2]}".encode())
            between = b"\n"
        else:
            yield (conv, *[values[k] for k in _COUNTS], values["audit"], sha.hexdigest())


def _turns(events: Iterator[tuple]) -> Iterator[tuple]:
    for kind, *what in events:
        if kind == "begin":
            conv, place = what[0], 0
        elif kind == "turn":
            yield (conv, place, *what)
            place += 1


def _in_batches(rows_of, schema: pa.Schema):
    """Arrow function that puts the rows of ``rows_of`` into batches."""
    def run(batches):
        rows = rows_of(_walk(batches))
        while some := list(itertools.islice(rows, 1024)):
            yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*some), schema)], schema=schema)

    return run


def repair_damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """Damages the rows (:func:`damage`), repairs them (:func:`repair`) and reports every original conversation."""
    rows = damage(turns, conv_col, turn_col, role_col, text_col)
    return repair(rows, turns.select(F.col(conv_col).alias("conv"))).withColumnRenamed("conv", conv_col)

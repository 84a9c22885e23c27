r"""Records of delimited files read by many tasks, quoted line breaks and all.

A file with line breaks inside quoted fields cannot be cut at any line: whether a line
starts a record depends on the quotes of every line before it. Each line is therefore
taken for what it does to the reader: a function of two states (outside or inside a
quoted field) to two states. Such functions compose, so

1. a first scan gives one row for each split: what its lines do to either state, and how
   many records start in it after either;
2. a window over these rows, in the order of the splits, gives the state that each split
   is entered in and the number of records before it;
3. a second scan gives the records that start and end in one split, in place: no line is
   shuffled. Only the ends of records that lie across splits are grouped, and only splits
   with such ends are read for them.

Lines are handled in Arrow batches; Python looks only at lines that hold a quote. Fields
are cut by Spark's own CSV parser.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow import spec as S
from tableflow.session import scratch_path

FILE, BLOCK, NUMBER, RECORD = "_tf_file", "_tf_block", "_tf_number", "_tf_record"
_LINE = "_tf_line"


def line_moves(sep: bytes) -> Callable[[bytes, int], int]:
    """The state after a line that was reached in state 0 (outside) or 1 (inside a quoted field).

    Doubled quotes never change the state, so they go first. A field that begins with a
    quote ends at the separator after its next quote; one that does not is plain text up
    to the separator, quotes and all.
    """
    opening, past = sep + b'"', len(sep)

    def move(line: bytes, state: int) -> int:
        if b'""' in line:
            line = line.replace(b'""', b"")
        at = 0
        while True:
            if state or line.startswith(b'"', at):
                closing = line.find(b'"', at if state else at + 1)
                if closing < 0:
                    return 1
                state, at = 0, line.find(sep, closing + 1)
            else:
                at = line.find(opening, at)
            if at < 0:
                return 0
            at += past

    return move


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines with a number for their file and the start of their split, in the order of the file within a task."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").cast("binary").alias(_LINE), F.xxhash64("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK))


def _files(spark: SparkSession, path: str) -> DataFrame:
    """``_tf_file`` and ``path`` of each file; no content is read."""
    files = spark.read.format("binaryFile").load(path).select(F.xxhash64("_metadata.file_path").alias(FILE), F.col("_metadata.file_path").alias("path"))
    twice = files.groupBy(FILE).agg(F.sort_array(F.collect_set("path")).alias("paths")).where(F.size("paths") > 1).first()
    if twice is not None:
        raise ValueError(f"two file names have one hash; rename one of them: {twice['paths']}")
    return files


def _runs(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[tuple, pa.Array]]:
    """Lines of the batches, cut where one of the named columns changes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]
        lines = batch.column(batch.schema.get_field_index(_LINE))
        change = np.zeros(batch.num_rows, bool)
        for c in columns[:2]:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            yield tuple(c[a].item() for c in columns), lines.slice(a, b - a)


def _shape(lines: pa.Array) -> tuple[list[int], list[bytes], np.ndarray]:
    """Places and bytes of the lines with a quote, and which lines are not empty (a carriage return is)."""
    quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
    length = pc.binary_length(lines).to_numpy(zero_copy_only=False)
    filled = length > 0
    one = np.flatnonzero(length == 1)
    if len(one):
        filled[one] = [b != b"\r" for b in lines.take(pa.array(one)).to_pylist()]
    return quoted.tolist(), lines.take(pa.array(quoted)).to_pylist(), filled


def _summaries(sep: bytes):
    move = line_moves(sep)
    schema = pa.schema([(FILE, pa.int64()), (BLOCK, pa.int64()), *[(c, pa.int64()) for c in ("f0", "f1", "n0", "n1")]])

    def run(batches):
        now, state, n = None, [0, 1], [0, 0]

        def told():
            return pa.record_batch([[v] for v in (*now, *state, *n)], schema=schema)

        for split, lines in _runs(batches, (FILE, BLOCK)):
            if split != now:
                if now is not None:
                    yield told()
                now, state, n = split, [0, 1], [0, 0]
            quoted, texts, filled = _shape(lines)
            count, at = np.concatenate([[0], np.cumsum(filled)]).tolist(), 0
            for q, text in zip(quoted, texts):
                for h in (0, 1):
                    if state[h] == 0:
                        n[h] += count[q] - count[at] + 1
                after = move(text, state[0])
                state = [after, after if state[0] == state[1] else move(text, state[1])]
                at = q + 1
            for h in (0, 1):
                if state[h] == 0:
                    n[h] += count[-1] - count[at]
        if now is not None:
            yield told()

    return run


def _running(df: DataFrame, by: str, order: str) -> DataFrame:
    """Adds ``state``, which each row is entered in if its group begins in state 0; ``f0`` and ``f1`` say what a row makes of either.

    A row that gives one state whatever it got fixes it; after the last such row only the
    number of rows that exchange the states counts.
    """
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = df.withColumn("swaps", F.coalesce(F.sum(F.when(F.col("f0") > F.col("f1"), 1)).over(w), F.lit(0)))
    out = out.withColumn("fixed", F.when(F.col("f0") == F.col("f1"), (F.col("f0") + F.col("swaps")) % 2))
    out = out.withColumn("fixed", F.last("fixed", ignorenulls=True).over(w))
    return out.withColumn("state", (F.coalesce(F.col("fixed"), F.lit(0)) + F.col("swaps")) % 2).drop("swaps", "fixed")


def splits(spark: SparkSession, path: str, sep: str = S.BULK_SEPARATOR, encoding: str = S.BULK_ENCODING, header: bool = True) -> DataFrame:
    """One row for each split of the files: the ``state`` it is entered in and the state ``ends`` it is left in, ``before``: records
    of its file that start before it, ``first``: their number over all files, without headers, ``head``: the number that the
    file's header would have (-1 without one).

    Files go by path; the records of each count on from those of the file before. Written
    as a table of some 60 bytes for each split (one for 128 MB of text, by Spark's default).
    """
    found = _lines(spark, path).mapInArrow(_summaries(sep.encode(encoding)), f"{FILE} bigint, {BLOCK} bigint, f0 bigint, f1 bigint, n0 bigint, n1 bigint")
    entered = _running(found, FILE, BLOCK)
    entered = entered.withColumn("n", F.when(F.col("state") == 0, F.col("n0")).otherwise(F.col("n1")))
    w = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    entered = entered.select(FILE, BLOCK, "n", "state", F.when(F.col("state") == 0, F.col("f0")).otherwise(F.col("f1")).alias("ends"),
                             F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    place = scratch_path(spark, "splits")
    entered.write.parquet(place)
    entered = spark.read.parquet(place)
    skip = 1 if header else 0
    files = entered.groupBy(FILE).agg(F.greatest(F.sum("n") - skip, F.lit(0)).alias("data")).join(_files(spark, path), FILE)
    w = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(F.col(FILE).alias("file_"), (F.coalesce(F.sum("data").over(w), F.lit(0)) - skip).alias("offset"))
    return entered.join(files, F.col(FILE) == F.col("file_")).select(FILE, BLOCK, "state", "ends", "before", (F.col("before") + F.col("offset")).alias("first"),
                                                                            (F.col("offset") + 1 if header else F.lit(-1)).cast("bigint").alias("head"))


class _Split:
    """The record that is open in a split, line by line."""

    def __init__(self, state: int, number: int, head: int, block: int) -> None:
        self.state, self.number, self.head, self.block = state, number, head, block
        self.lines: list[bytes] = []
        self.whole = not state  # the record started in this split

    def left(self) -> bool:
        return bool(self.lines) and self.number != self.head


def _records(sep: bytes, ends: bool):
    """The records that lie in one split, or (``ends``) the parts of those that do not."""
    move = line_moves(sep)
    schema = pa.schema([(NUMBER, pa.int64()), (BLOCK, pa.int64()), (RECORD, pa.binary())])

    def batch(numbers, block, records):
        return pa.record_batch([pa.array(numbers, pa.int64()), pa.array(np.full(len(numbers), block), pa.int64()), records], schema=schema)

    def run(batches):
        now, split = None, None
        for (file, block, state, first, head), lines in _runs(batches, (FILE, BLOCK, "state", "first", "head")):
            if (file, block) != now:
                if ends and split is not None and split.left():
                    yield batch([split.number], split.block, pa.array([b"\n".join(split.lines)]))
                now, split = (file, block), _Split(state, first, head, block)
            quoted, texts, filled = _shape(lines)
            n, at = len(filled), 0
            place = np.full(n, -1, np.int64)  # the number of each line that is a record
            many, many_numbers = [], []
            count = np.cumsum(filled)
            for q, text in zip([*quoted, n], [*texts, None]):
                if split.state:
                    if q > at:
                        split.lines.extend(lines.slice(at, q - at).to_pylist())
                elif q > at:
                    base = split.number - (int(count[at - 1]) if at else 0)
                    place[at:q] = np.where(filled[at:q], base + count[at:q], -1)
                    split.number = base + int(count[q - 1])
                at = q + 1
                if text is None:
                    break
                before, split.state = split.state, move(text, split.state)
                if before == 0:
                    split.number += 1
                    split.whole = True
                    if split.state == 0:
                        place[q] = split.number
                        continue
                split.lines.append(text)
                if split.state == 0:
                    if split.whole != ends and split.number != head:
                        many.append(b"\n".join(split.lines))
                        many_numbers.append(split.number)
                    split.lines = []
            kept = np.flatnonzero((place >= 0) & (place != head))
            if len(kept) and not ends:
                yield batch(place[kept], block, lines.take(pa.array(kept)))
            if many:
                yield batch(many_numbers, block, pa.array(many))
        if ends and split is not None and split.left():
            yield batch([split.number], split.block, pa.array([b"\n".join(split.lines)]))

    return run


def record_texts(spark: SparkSession, path: str, sep: str = S.BULK_SEPARATOR, encoding: str = S.BULK_ENCODING, header: bool = True) -> DataFrame:
    """``_tf_number`` (from 1 over all files) and ``_tf_record``, the text of each data record."""
    table = splits(spark, path, sep, encoding, header)
    # one small row for each split, whatever the rows are like
    table = F.broadcast(table.select(F.col(FILE).alias("file_"), F.col(BLOCK).alias("block_"), "state", "ends", "first", "head"))
    lines = _lines(spark, path).join(table, (F.col(FILE) == F.col("file_")) & (F.col(BLOCK) == F.col("block_"))).drop("file_", "block_")
    schema = f"{NUMBER} bigint, {BLOCK} bigint, {RECORD} binary"
    whole = lines.drop("ends").mapInArrow(_records(sep.encode(encoding), ends=False), schema).select(NUMBER, RECORD)
    parts = lines.where("state = 1 OR ends = 1").drop("ends").mapInArrow(_records(sep.encode(encoding), ends=True), schema)
    parts = parts.groupBy(NUMBER).agg(F.array_sort(F.collect_list(F.struct(BLOCK, RECORD))).alias("p"))
    across = parts.select(NUMBER, F.array_join(F.transform("p", lambda p: F.decode(p[RECORD], "ISO-8859-1")), "\n").alias(RECORD))
    across = across.withColumn(RECORD, F.encode(RECORD, "ISO-8859-1"))
    text = F.col(RECORD).cast("string") if encoding.upper().replace("-", "") == "UTF8" else F.decode(RECORD, encoding)
    rows = whole.unionByName(across).select(NUMBER, text.alias(RECORD))
    ended = F.when(F.endswith(RECORD, F.lit("\r")), F.expr(f"substring({RECORD}, 1, length({RECORD}) - 1)")).otherwise(F.col(RECORD))
    return rows.select(NUMBER, ended.alias(RECORD))


def read_records(spark: SparkSession, path: str, sep: str = S.BULK_SEPARATOR, encoding: str = S.BULK_ENCODING,
                 normalise: bool = True, drop_quotes: bool = False, corrupt_column: str | None = None,
                 number: str | None = None, after: int = 0) -> DataFrame:
    """What :func:`tableflow.sources.delimited.read_delimited` gives with ``multi_line``, by as many tasks as the files have splits.

    Records end at a line break (``\\n`` or ``\\r\\n``) outside quotes; every file starts
    with a header, and the first file's names count. Quotes double inside a quoted
    field; a quote inside an unquoted field is text. Empty lines between records are
    skipped. Encodings are those that keep ASCII as it is. ``number`` names a column with
    the record's number over all files (from 1, as a reader counts that goes through them
    in order of their names); ``after`` leaves out the records up to that number, to
    resume there. The rows come in no order: sort by ``number`` where it matters.
    """
    from tableflow.operators.records import normalise_headers

    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    names = spark.read.options(**options).option("header", True).option("multiLine", True).option("encoding", encoding).csv(path).columns
    if normalise:
        plain = T.StructType([T.StructField(n, T.StringType()) for n in names])
        names = normalise_headers(spark.createDataFrame([], plain), drop_quotes).columns
    fields = [f"_{i}" for i in range(len(names))]
    schema = ", ".join(f"{c} string" for c in [*fields, *(["_corrupt"] if corrupt_column else [])])
    # the parser must keep line breaks inside quotes as they are, and take no carriage return for one
    options |= {"multiLine": "true", "lineSep": "\n", **({"columnNameOfCorruptRecord": "_corrupt"} if corrupt_column else {})}
    texts = record_texts(spark, path, sep, encoding)
    if after:
        texts = texts.where(F.col(NUMBER) > after)
    # a generator: one parse a record, whatever columns are asked for
    parsed = texts.select(NUMBER, F.inline(F.array(F.from_csv(RECORD, schema, options))))
    columns = [F.col(c).alias(n) for c, n in zip(fields, names)]
    if corrupt_column:
        columns.append(F.col("_corrupt").alias(corrupt_column))
    return parsed.select(*columns, *([F.col(NUMBER).alias(number)] if number else []))

"""Merkle fixity audit of WARC stores.

Each record is hashed; the records of an ordered range of offsets hash into a leaf,
leaves into nodes of ``fanout`` consecutive ranges up to a root for each archive, and
the archives' roots into shelves up to one root of the store. Replicas are compared from
the root down, and only below nodes that differ, to the records that differ. Ranges are
cut by byte offset, so a record that is lost changes its own range alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableflow.llm.common import written

RANGE_BYTES = 1 << 15
FANOUT = 8
SIDES = ("primary", "replica")


def warc_record(record_id: Column, uri: Column, payload: Column) -> Column:
    """One WARC/1.0 response record, as text."""
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), record_id,
        F.lit(">\r\nWARC-Target-URI: "), uri, F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"), payload, F.lit("\r\n\r\n"))


def lay_out(records: DataFrame) -> DataFrame:
    """(archive, offset, length, record_id, digest) of records (archive, place, record_id, record).

    Records of an archive lie one after another by place, then by id and digest. Only
    lengths and hashes are shuffled, not the records; equal records of one place are laid
    out as one row with their number before, so that the window over an archive holds
    distinct records only. A null record is of no bytes; a null archive or id is ``""``.
    """
    record = F.coalesce(F.col("record"), F.lit(""))
    rows = records.select(F.coalesce(F.col("archive").cast("string"), F.lit("")).alias("archive"), "place",
                          F.coalesce(F.col("record_id").cast("string"), F.lit("")).alias("record_id"),
                          F.octet_length(record).cast("bigint").alias("length"), F.sha2(record, 256).alias("digest"))
    same = rows.groupBy("archive", "place", "record_id", "length", "digest").agg(F.count("*").alias("n"))
    before = Window.partitionBy("archive").orderBy("place", "record_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum(F.col("length") * F.col("n")).over(before), F.lit(0))
    return (same.withColumn("first", first).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
            .select("archive", (F.col("first") + F.col("copy") * F.col("length")).alias("offset"), "length", "record_id", "digest"))


def _joined(parts: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(parts), "\n"), 256)


def _steps(n: int, fanout: int) -> int:
    """Levels above the lowest until ``n`` nodes are one."""
    steps = 0
    while n > 1:
        n, steps = -(-n // fanout), steps + 1
    return steps


def merkle_levels(indexed: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels of the trees of all sides, lowest first: rows (side, node, parent, hash).

    ``indexed``: (side, archive, offset, length, digest). A node hashes ``fanout`` children
    at most (a leaf: the records that start in its range); every level is a group-by of
    the one below and is written to the shared folder.
    """
    span = indexed.agg(F.max("offset").alias("end"), F.approx_count_distinct("archive").alias("archives")).first()
    high = _steps((span["end"] or 0) // range_bytes + 1, fanout)
    # enough shelves that each has few archives; an estimate does, since every archive lands on a shelf
    shelves = max(1, _steps(span["archives"] or 1, fanout))
    name = lambda level, n: F.concat_ws("|", F.col("archive"), F.lit(str(level)), n.cast("string"))
    shelf = lambda level, n: F.concat_ws("|", F.lit("shelf"), F.lit(str(level)), n.cast("string"))
    place = F.floor(F.col("offset") / range_bytes)
    part = F.concat_ws(":", F.lpad(F.col("offset").cast("string"), 20, "0"), "length", "digest")
    level = (indexed.groupBy("side", "archive", place.alias("n")).agg(_joined(F.collect_list(part)).alias("hash")))
    levels = []
    child = F.concat_ws(":", F.lpad(F.col("n").cast("string"), 20, "0"), "hash")
    for k in range(high + 1):
        up = F.floor(F.col("n") / fanout)
        top = shelf(0, F.pmod(F.xxhash64("archive"), F.lit(fanout ** shelves)))
        kept = written(level.select("side", "archive", "n", name(k, F.col("n")).alias("node"),
                                    (name(k + 1, up) if k < high else top).alias("parent"), "hash"), f"ranges_{k}")
        levels.append(kept.select("side", "node", "parent", "hash"))
        if k < high:
            level = kept.groupBy("side", "archive", up.alias("n")).agg(_joined(F.collect_list(child)).alias("hash"))
    level = (kept.withColumn("n", F.pmod(F.xxhash64("archive"), F.lit(fanout ** shelves)))
             .groupBy("side", "n").agg(_joined(F.collect_list(F.concat_ws(":", "archive", "hash"))).alias("hash")))
    for k in range(shelves + 1):
        up = F.floor(F.col("n") / fanout)
        kept = written(level.select("side", "n", shelf(k, F.col("n")).alias("node"), shelf(k + 1, up).alias("parent"), "hash"), f"shelves_{k}")
        levels.append(kept.select("side", "node", "parent", "hash"))
        level = kept.groupBy("side", up.alias("n")).agg(_joined(F.collect_list(child)).alias("hash"))
    return levels


def differing(level: DataFrame) -> DataFrame:
    """Nodes of a level that one side lacks or hashes otherwise."""
    return (level.groupBy("node").agg(F.count("*").alias("sides"), F.min("hash").alias("a"), F.max("hash").alias("b"))
            .filter("sides < 2 OR a <> b").select("node"))


def audit(primary: DataFrame, replica: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """Records that differ between two stores (archive, offset, length, record_id, digest).

    Returns ``archive``, ``offset``, ``record_id``, ``status`` and both digests: ``missing``
    (at an offset of the primary, the replica has no record), ``extra`` (the other way
    round) or ``altered``. ``record_id`` is the primary's where it has one.

    Several records at one offset of an archive are compared as one, in the order of
    their digests. Two empty stores are equal; against an empty store every record is
    missing or extra. Other columns are ignored, whatever their names. The root decides
    first: below equal nodes nothing is joined.
    """
    columns = ["archive", "offset", "length", "record_id", "digest"]
    tagged = [df.select(F.lit(side).alias("side"), *columns) for side, df in zip(SIDES, (primary, replica), strict=True)]
    indexed = written(tagged[0].unionByName(tagged[1]).groupBy("side", "archive", "offset").agg(
        F.array_sort(F.collect_list(F.struct("digest", "length", "record_id"))).alias("r")).select(
        "side", "archive", "offset", F.aggregate("r", F.lit(0).cast("bigint"), lambda a, x: a + x["length"]).alias("length"),
        F.get("r", F.lit(0))["record_id"].alias("record_id"),
        F.when(F.size("r") == 1, F.get("r", F.lit(0))["digest"]).otherwise(
            F.sha2(F.array_join(F.transform("r", lambda x: x["digest"]), ","), 256)).alias("digest")), "indexed")
    levels = merkle_levels(indexed, range_bytes, fanout)
    bad = differing(levels[-1])
    for level in reversed(levels[:-1]):
        bad = differing(level.join(bad.withColumnRenamed("node", "parent"), "parent", "left_semi"))
    place = F.concat_ws("|", "archive", F.lit("0"), F.floor(F.col("offset") / range_bytes).cast("string"))
    near = indexed.withColumn("node", place).join(bad, "node", "left_semi")
    side = lambda s, c: F.max(F.when(F.col("side") == s, F.col(c)))
    found = near.groupBy("archive", "offset").agg(
        side("primary", "digest").alias("expected"), side("replica", "digest").alias("found"),
        F.coalesce(side("primary", "record_id"), side("replica", "record_id")).alias("record_id"),
        side("primary", "length").alias("a"), side("replica", "length").alias("b"))
    return found.filter("expected IS NULL OR found IS NULL OR expected <> found OR a <> b").select(
        "archive", "offset", "record_id", F.when(F.col("found").isNull(), "missing").when(F.col("expected").isNull(), "extra")
        .otherwise("altered").alias("status"), "expected", "found")


def damaged_replica(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pages' store, and a replica of it with damage that the page ids decide.

    Of 101 pages, by a hash of the id: one has a character of its payload changed, one is
    cut short, one is lost, and one is followed by a stray record.
    """
    pick = F.conv(F.substring(F.md5(F.col("page_id").cast("string")), 1, 6), 16, 10).cast("bigint") % 101
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.floor(F.col("page_id") / 1024).cast("string").alias("archive"), F.col("page_id").alias("place"),
                        F.col("page_id").cast("string").alias("record_id"), pick.alias("pick"),
                        F.coalesce(F.col("url"), F.lit("")).alias("url"), html.alias("html"))
    record = warc_record(F.col("record_id"), F.col("url"), F.col("html"))
    primary = lay_out(rows.select("archive", "place", "record_id", record.alias("record")))
    # the replica keeps the offsets; its bytes are hashed anew
    middle = F.floor(F.length("html") / 2).cast("int") + 1
    changed = F.overlay("html", F.when(F.substring("html", middle, F.lit(1)) == "X", "Y").otherwise("X"), middle, F.lit(1))
    other = F.when(F.col("pick") == 0, warc_record(F.col("record_id"), F.col("url"), changed)).when(
        F.col("pick") == 1, F.substring(record, F.lit(1), F.length(record) - 7)).otherwise(record)
    held = rows.withColumn("own", F.sha2(record, 256)).select(
        "archive", "record_id", "pick", "own", F.octet_length(other).cast("bigint").alias("l2"), F.sha2(other, 256).alias("d2")).distinct()
    base = primary.withColumnRenamed("digest", "own").join(held, ["archive", "record_id", "own"]).filter("pick <> 2 OR pick IS NULL")
    replica = base.select("archive", "offset", F.col("l2").alias("length"), "record_id", F.col("d2").alias("digest"))
    stray = base.filter("pick = 3").select("archive", (F.col("offset") + 1).alias("offset"), F.lit(5).cast("bigint").alias("length"),
                                          F.lit("stray").alias("record_id"), F.sha2(F.lit("stray"), 256).alias("digest"))
    return primary, replica.unionByName(stray)

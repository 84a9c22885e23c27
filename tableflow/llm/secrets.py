"""Secret scans over an incremental ledger of content-addressed texts.

Every version of a text is a blob, addressed by the SHA-256 of its bytes. The ledger
notes which rule versions each blob was scanned with and what they found. A run scans
only pairs of blob and rule version that the ledger lacks, appends them, and joins the
findings back to all paths (rows) that hold the blob.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.llm.common import arrow_batches
from tableflow.session import path_exists, scratch_path


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters at least."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def version(self) -> str:
        """Changes with anything that can change what the rule finds."""
        return hashlib.sha256(repr((self.kind, self.pattern, self.group, self.least)).encode()).hexdigest()[:16]


#: the listed kinds, in the order that ties are reported in
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: what stands between the lines of a key: blanks, quote marks, escaped line breaks
_GAP = r"""(?:[\s>|"'#*,]|\\+[nrt])"""
#: a whole private key: to its END line, whatever lies between; without one, over header fields
#: and base64 (long runs, or short ones alone on their line) to the end of that body
_PRIVATE_KEY = (
    r"-----BEGIN ((?:[A-Z]+ )*)PRIVATE KEY-----(?:"
    r"[^-]*+(?:-(?!----(?:BEGIN|END) )[^-]*+)*+-----END \1PRIVATE KEY-----|"
    rf"(?:{_GAP}++(?:Proc-Type|DEK-Info|Version|Comment):[^\r\n\\]*+)*+"
    rf"""(?:{_GAP}*+[A-Za-z0-9+/=]{{20,}}+|{_GAP}++[A-Za-z0-9+/=]++(?=[ \t]*(?:\Z|[\r\n\\"'])))*+)""")
#: further published formats
EXTRA_RULES = (
    Rule("private_key", _PRIVATE_KEY),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("host_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
RULES = BASE_RULES + EXTRA_RULES

FINDING = "struct<start:int,rank:int,end:int,kind:string>"
LEDGER = f"blob string, versions array<string>, findings array<{FINDING}>"


def find(text: str, rules: tuple[tuple[int, str, re.Pattern, int, int], ...]) -> list[dict]:
    """Findings of one whole text, in code points."""
    out = []
    for rank, kind, pattern, group, least in rules:
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append({"start": m.start(), "rank": rank, "end": m.end(), "kind": kind})
    return out


def _scanner(rules: tuple[Rule, ...]):
    """mapInArrow function: (blob, text, missing versions) to ledger rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # without re.ASCII, "s" and "k" in either case would also match U+017F and U+212A
        compiled = {r.version: (i, r.kind, re.compile(r.pattern, re.ASCII), r.group, r.least) for i, r in enumerate(rules)}
        struct = pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
        for b in batches:
            found = []
            for text, versions in zip(b.column(1), b.column(2), strict=True):
                use = tuple(compiled[v] for v in versions.as_py())
                found.append(find(text.as_py() or "", use))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(found, pa.list_(struct))],
                                             ["blob", "versions", "findings"])

    return run


def blob_address(text_col: str) -> Column:
    """SHA-256 of the text's bytes; null is the empty text."""
    return F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)


def scan_unseen(texts: DataFrame, ledger: str, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> None:
    """Scan what the ledger lacks and append it.

    A blob's text travels once from each input partition at most (copies collapse before
    the shuffle), so one text that a third of the rows hold is scanned once and gathers
    nowhere. Rows of the ledger are one blob and the rule versions it was scanned with.
    """
    spark = texts.sparkSession
    arrow_batches(spark)
    current = F.array(*[F.lit(r.version) for r in rules])
    blobs = texts.select(blob_address(text_col).alias("blob"), F.col(text_col).alias("text"))
    if path_exists(spark, ledger):
        seen = (spark.read.schema(LEDGER).parquet(ledger).groupBy("blob")
                .agg(F.array_distinct(F.flatten(F.collect_list("versions"))).alias("known")))
        blobs = (blobs.join(seen, "blob", "left")
                 .withColumn("missing", F.array_except(current, F.coalesce("known", F.array().cast("array<string>"))))
                 .filter(F.size("missing") > 0).drop("known"))
    else:
        blobs = blobs.withColumn("missing", current)
    fresh = blobs.dropDuplicates(["blob"]).select("blob", "text", "missing")
    fresh.mapInArrow(_scanner(rules), LEDGER).write.mode("append").parquet(ledger)


def findings_of(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, findings) of the blobs in which the current rule versions found anything.

    Findings of older versions of a rule stay in the ledger and are left out here: a row
    counts only for the versions it was scanned with that are current.
    """
    version = F.create_map(*[x for r in rules for x in (F.lit(r.kind), F.lit(r.version))])
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    hits = (ledger.filter(F.size("findings") > 0)
            .select("blob", "versions", F.explode("findings").alias("f"))
            .filter(F.array_contains(F.col("versions"), version[F.col("f.kind")])))
    # a replayed append may hold a finding twice: a set holds it once
    return hits.groupBy("blob").agg(F.array_sort(F.collect_set(F.struct(
        F.col("f.start").alias("start"), rank[F.col("f.kind")].alias("rank"), F.col("f.end").alias("end"),
        F.col("f.kind").alias("kind")))).alias("findings"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES,
                 ledger: str | None = None) -> DataFrame:
    """Secrets of every row: ``id_col``, ``blob`` and ``findings``.

    ``findings`` holds structs (start, rank, end, kind): code points, end exclusive,
    by start and then by the order of the rules. ``ledger`` is a folder that all
    executors share and that later runs pass again; without it, a new one below
    ``spark.checkpoint.dir`` is used, so everything is unseen.

    A null text is the empty blob and has no findings; repeated rows and copies under
    other ids each get the blob's findings; an empty table gives no rows. Other columns
    are ignored, whatever their names.
    """
    spark = docs.sparkSession
    ledger = ledger or scratch_path(spark, "llm", "ledger")
    scan_unseen(docs, ledger, text_col, rules)
    found = findings_of(spark.read.schema(LEDGER).parquet(ledger), rules)
    paths = docs.select(F.col(id_col).alias("path_id"), blob_address(text_col).alias("blob"))
    return (paths.join(found, "blob", "left")
            .select(F.col("path_id").alias(id_col), "blob",
                    F.coalesce("findings", F.array().cast(f"array<{FINDING}>")).alias("findings")))


def spans_text(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def secret_digests(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """Query rows: counts and digests of each document's findings."""
    r = scan_secrets(docs, ledger=ledger)
    base = F.filter("findings", lambda f: f["rank"] < len(BASE_RULES))
    count = lambda k: F.size(F.filter("findings", lambda f: f["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return r.select("doc_id", count("assign"), count("access"), count("hex"),
                    F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(F.col("findings")).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]",
           ledger: str | None = None, size_col: str | None = None) -> DataFrame:
    """The documents with every found span replaced by ``mark`` (overlapping spans by one).

    ``size_col``, if given, becomes the number of characters of each text that changes.
    All rows and columns stay, whatever their names; texts without findings, null and
    empty ones included, stay as they are; repeated rows change alike; an empty table
    stays empty. Only blobs with findings are joined back, by address.
    """
    spark = docs.sparkSession
    ledger = ledger or scratch_path(spark, "llm", "ledger")
    scan_unseen(docs, ledger, text_col)
    found = findings_of(spark.read.schema(LEDGER).parquet(ledger))
    names = docs.columns
    own = {c: f"c{i}" for i, c in enumerate(names)}
    rows = docs.toDF(*own.values())
    text = own[text_col]
    tagged = rows.select("*", blob_address(text).alias("blob")).join(found.select("blob", F.col("findings").alias("found")), "blob", "left")
    # text between the spans: each step appends what lies between the last end and the next start
    t = F.col(text)
    state = F.aggregate(
        "found", F.struct(F.lit("").alias("out"), F.lit(0).alias("to")),
        lambda a, f: F.struct(
            F.when(f["start"] >= a["to"], F.concat(a["out"], t.substr(a["to"] + 1, f["start"] - a["to"]), F.lit(mark)))
            .otherwise(a["out"]).alias("out"), F.greatest(a["to"], f["end"]).alias("to")),
        lambda a: F.concat(a["out"], t.substr(a["to"] + 1, F.length(t))))
    changed = F.col("found").isNotNull()
    out = tagged.withColumn(text, F.when(changed, state).otherwise(t))
    if size_col:
        kind = docs.schema[size_col].dataType
        out = out.withColumn(own[size_col], F.when(changed, F.length(text).cast(kind)).otherwise(F.col(own[size_col])))
    return out.select(*own.values()).toDF(*names)

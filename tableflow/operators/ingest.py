"""Insert-ignore loading: keep the first row per key, skip keys the target already has.

Keys are "nulls not distinct". Each key column becomes two that hold no null,
``(coalesce(k, default), k is null)``; the grouping and the anti-join both use these, so
one shuffle of the incoming rows serves both.

Skew: "first row per key" is a ``min(struct(order..., payload...))`` aggregation, so a
key holding a third of the input is reduced map-side to one row per task before the
shuffle. After that step both join sides are unique on the key: the anti-join cannot
skew. A very large target is kept as a table bucketed by the same columns
(:func:`bucket_table`), and then its side of the join needs no shuffle.
"""

from __future__ import annotations

import time as _time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tableflow import spec as S
from tableflow.functions import rules as R
from tableflow.operators import quarantine as Q
from tableflow.operators import records as REC
from tableflow.session import path_exists, scratch_path

_FIRST = "_tf_first"


_DEFAULTS = {"string": "", "boolean": False, "date": "1970-01-01", "timestamp": "1970-01-01 00:00:00",
             "timestamp_ntz": "1970-01-01 00:00:00"}


def key_names(key) -> list[str]:
    """Names of the null-free columns that stand for the key."""
    return [f"_tf_{part}{i}" for i in range(len(key)) for part in ("k", "z")]


def key_columns(df: DataFrame, key) -> list[Column]:
    """The null-free columns of a key; taken as they are from a table that stores them."""
    out = []
    for i, k in enumerate(key):
        if f"_tf_k{i}" in df.columns:
            out += [F.col(f"_tf_k{i}"), F.col(f"_tf_z{i}")]
            continue
        kind = df.schema[k].dataType.simpleString()
        default = F.lit(_DEFAULTS.get(kind, 0)).cast(kind)
        out += [F.coalesce(F.col(k), default).alias(f"_tf_k{i}"), F.isnull(F.col(k)).alias(f"_tf_z{i}")]
    return out


def _firsts(df: DataFrame, key, order) -> DataFrame:
    """One row per key with the key's null-free columns before it."""
    key, order, names = list(key), list(order), key_names(key)
    payload = [c for c in df.columns if c not in key and c not in order]   # sorted rows hold a column once
    tagged = df.select(*key_columns(df, key), F.struct(
        *[F.col(o).alias(f"_tf_o{i}") for i, o in enumerate(order)], *[F.col(c) for c in payload]).alias(_FIRST))
    agg = tagged.groupBy(*names).agg(F.min(_FIRST).alias(_FIRST))
    own = {o: F.col(f"{_FIRST}._tf_o{i}") for i, o in enumerate(order)}
    own |= {k: F.when(~F.col(f"_tf_z{i}"), F.col(f"_tf_k{i}")) for i, k in enumerate(key)}
    return agg.select(*names, *[(own[c] if c in own else F.col(f"{_FIRST}.{c}")).alias(c) for c in df.columns])


def first_per_key(df: DataFrame, key, order) -> DataFrame:
    """One row per key (nulls equal): the smallest by ``order``, ties broken by the other columns."""
    return _firsts(df, key, order).select(*df.columns)


def insert_ignore(target: DataFrame, incoming: DataFrame, key, order, key_range=None) -> DataFrame:
    """Rows to append: first row per key of ``incoming`` that the target does not hold.

    ``key_range=(lo, hi)`` of the first key column over ``incoming`` restricts the target
    side to that range (plus null keys): a pushed-down filter that lets Parquet skip the
    row groups of a target clustered by key. The result is the same.
    """
    if key_range is not None and key_range[0] is not None:
        k = F.col(list(key)[0])
        target = target.filter(k.between(F.lit(key_range[0]), F.lit(key_range[1])) | k.isNull())
    known = target.select(*key_columns(target, key))
    return _firsts(incoming, key, order).join(known, key_names(key), "left_anti").select(*incoming.columns)


def insert_new(fresh: DataFrame, incoming: DataFrame, key, order) -> DataFrame:
    """First row per key of ``incoming`` whose key is in ``fresh`` (the key's null-free columns, unique)."""
    return _firsts(incoming, key, order).join(fresh, key_names(key), "left_semi").select(*incoming.columns)


def key_range(df: DataFrame, key) -> tuple:
    """(min, max) of the first key column (one small aggregate)."""
    k = list(key)[0]
    r = df.agg(F.min(k).alias("lo"), F.max(k).alias("hi")).first()
    return r["lo"], r["hi"]


def with_load_time(df: DataFrame, column: str, at=None) -> DataFrame:
    """Fill the load-time column: ``at`` (tests) or the current timestamp."""
    ts = F.lit(at).cast("timestamp") if at is not None else F.current_timestamp()
    return df.withColumn(column, ts)


def empty_target(spark: SparkSession, spec: S.TableSpec) -> DataFrame:
    return spark.createDataFrame([], spec.target_schema())


def is_table(target: str) -> bool:
    """A catalog table's name, not a path."""
    return "/" not in target and ":" not in target


def target_exists(spark: SparkSession, target: str) -> bool:
    """Is the target there (a catalog table, or a readable Parquet path)?"""
    return spark.catalog.tableExists(target) if is_table(target) else path_exists(spark, target)


def _stored(spark: SparkSession, target: str, spec: S.TableSpec) -> DataFrame:
    return spark.table(target) if is_table(target) else spark.read.parquet(target)


def check_target(spark: SparkSession, target: str, spec: S.TableSpec) -> None:
    """Refuse a load into a target that is missing or whose columns are not the spec's."""
    if not target_exists(spark, target):
        raise ValueError(f"target {target} does not exist; create it with create_target")
    want = {f.name: f.dataType.simpleString() for f in spec.target_schema().fields}
    have = {f.name: f.dataType.simpleString() for f in _stored(spark, target, spec).schema.fields if not f.name.startswith("_tf_")}
    wrong = sorted(c for c in want.keys() | have.keys() if want.get(c) != have.get(c))
    if wrong:
        raise ValueError(f"target {target}: " + ", ".join(f"{c} is {have.get(c, 'missing')}, not {want.get(c, 'expected')}" for c in wrong))


def read_target(spark: SparkSession, target: str, spec: S.TableSpec) -> DataFrame:
    """The target's rows; empty if there is none yet. A bucketed table brings its stored key columns."""
    if not target_exists(spark, target):
        return empty_target(spark, spec)
    return spark.table(target) if is_table(target) else spark.read.schema(spec.target_schema()).parquet(target)


def append_target(df: DataFrame, target: str, spec: S.TableSpec) -> None:
    """Append rows of the target's columns; a bucketed table also gets its key columns."""
    if not is_table(target):
        df.write.mode("append").parquet(target)
        return
    stored = df.sparkSession.table(target).columns
    full = df.select("*", *key_columns(df, spec.key)) if "_tf_k0" in stored else df
    full.select(*stored).write.insertInto(target)


def truncate_target(spark: SparkSession, target: str, spec: S.TableSpec) -> None:
    """Empty the target, keeping its columns."""
    if is_table(target):
        spark.sql(f"TRUNCATE TABLE {target}")
    else:
        empty_target(spark, spec).write.mode("overwrite").parquet(target)


def bucket_table(df: DataFrame, table: str, key, buckets: int) -> None:
    """Save as a catalog table that stores the key's null-free columns and is bucketed and sorted by
    them. Keep ``buckets`` equal to the shuffle partitions of the loads, so their one shuffle fits."""
    names = key_names(key)
    full = df.select("*", *key_columns(df, key))
    full.write.mode("append").format("parquet").bucketBy(buckets, *names).sortBy(*names).saveAsTable(table)


@dataclass
class LoadReport:
    filas_procesadas: int
    enviadas: int
    insertadas: int
    conflictos: int
    rechazadas: int
    total_en_destino: int
    segundos: float = 0.0

    @property
    def filas_por_segundo(self) -> float:
        """Throughput over the submitted rows (0 when no time was measured)."""
        return round(self.enviadas / self.segundos, 1) if self.segundos > 0 else 0.0

    def as_row(self, with_time: bool = False) -> dict:
        row = {k: v for k, v in self.__dict__.items() if k != "segundos"}
        if with_time:
            row.update(segundos=self.segundos, filas_por_segundo=self.filas_por_segundo)
        return row


def prepare_load(raw: DataFrame, spec: S.TableSpec, ordinal: str) -> tuple[DataFrame, DataFrame]:
    """Clean each record by its spec, then split rows the target can hold from those it cannot."""
    return Q.conform_to_target(REC.clean_record(raw, spec, keep=[ordinal]), spec, keep=[ordinal])


def tag_load(raw: DataFrame, spec: S.TableSpec, ordinal: str) -> DataFrame:
    """Cleaned records with the reason the target would refuse them (null if it holds them)."""
    cleaned = REC.clean_record(raw, spec, keep=[ordinal])
    return cleaned.withColumn(Q.PROBLEM, R.fence(Q.target_tag(cleaned, spec)))


def conform(accepted: DataFrame, spec: S.TableSpec, ordinal: str) -> DataFrame:
    """Accepted records in the target's types."""
    return accepted.select(ordinal, *[F.col(r.name).cast(r.target).alias(r.name) for r in spec.columns])


STATUS = "_estado"
ACCEPTED, REJECTED = "aceptada", "rechazada"


def bulk_load(spark: SparkSession, raw: DataFrame, spec: S.TableSpec, target_path: str, ordinal: str,
              staging_path: str | None = None, load_time=None) -> LoadReport:
    """Scan -> clean -> target checks -> insert-ignore -> append, with a load report.

    ``target_path`` is a path or a table name; a target that is missing or of other
    columns is refused before anything is read (see :func:`create_target`).

    Job 1 reads and cleans the source once and writes every row, tagged, to a staging
    table partitioned by outcome (``_estado=aceptada|rechazada``); the rejected
    partition is the reject table. Job 2 inserts from the accepted partition. The
    staging table cuts the lineage: a lost executor in job 2 never re-reads the source.
    Counts come from observations taken while the data is written.
    """
    check_target(spark, target_path, spec)
    started = _time.perf_counter()
    staging_path = staging_path or scratch_path(spark, "staging")
    cleaned = REC.clean_record(raw, spec, keep=[ordinal])
    present = [r.name for r in spec.columns if r.name in raw.columns]   # absent ones are all null
    tagged = cleaned.select(ordinal, *present, R.fence(Q.target_tag(cleaned, spec)).alias(Q.PROBLEM))
    tagged = tagged.withColumn(STATUS, F.when(F.col(Q.PROBLEM).isNull(), F.lit(ACCEPTED)).otherwise(F.lit(REJECTED)))
    obs_in = Observation("tf_in")
    (tagged.observe(obs_in, F.count(F.lit(1)).alias("n"),
                    F.sum((F.col(STATUS) == REJECTED).cast("long")).alias("rej"))
     .write.mode("overwrite").partitionBy(STATUS).parquet(staging_path))
    read_n, rejected_n = obs_in.get["n"], obs_in.get["rej"] or 0
    accepted = spark.read.parquet(staging_path).filter(F.col(STATUS) == ACCEPTED).select(
        ordinal, *[(F.col(r.name) if r.name in present else F.lit(None)).cast(r.target).alias(r.name)
                   for r in spec.columns])
    target = read_target(spark, target_path, spec)
    obs_new = Observation("tf_new")
    new = insert_ignore(target, accepted, spec.key, [ordinal]).drop(ordinal)
    if spec.load_time_column:
        new = with_load_time(new, spec.load_time_column, load_time)
    new = new.select(*spec.target_schema().fieldNames()).observe(obs_new, F.count(F.lit(1)).alias("n"))
    append_target(new, target_path, spec)
    submitted, inserted = read_n - rejected_n, obs_new.get["n"]
    total = _stored(spark, target_path, spec).count()
    return LoadReport(filas_procesadas=read_n, enviadas=submitted, insertadas=inserted,
                      conflictos=submitted - inserted, rechazadas=rejected_n, total_en_destino=total,
                      segundos=round(_time.perf_counter() - started, 3))


def rejects_of(spark: SparkSession, staging_path: str) -> DataFrame:
    """The rows a load set aside, with the reason."""
    return spark.read.parquet(staging_path).filter(F.col(STATUS) == REJECTED).drop(STATUS)


def create_target(spark: SparkSession, spec: S.TableSpec, path: str | None = None, table: str | None = None,
                  bucket_by_key: int | None = None) -> None:
    """Create the empty target from its declaration (types, load-time column).

    Uniqueness is enforced by :func:`insert_ignore`, text lengths and integer ranges by
    :func:`tableflow.operators.quarantine.conform_to_target`.
    """
    empty = empty_target(spark, spec)
    if table and not target_exists(spark, table):
        if bucket_by_key and spec.key:
            bucket_table(empty, table, spec.key, bucket_by_key)
        else:
            empty.write.format("parquet").saveAsTable(table)
    elif path and not path_exists(spark, path):
        empty.write.parquet(path)

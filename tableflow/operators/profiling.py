"""Column profiles, file inspection and quality summaries.

Wide tables are profiled by unpivoting to (column, value) and aggregating twice:
first per (column, value) -- partial aggregation collapses frequent values in every
map task -- then per column. That is one shuffle of distinct pairs instead of one
``Expand`` per distinct count, and no value is ever gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow import spec as S  # noqa: I001
from tableflow.functions import rules as R
from tableflow.operators import selection

_KIND_RANK = {"int": 1, "float": 2, "str": 3}


def _as_text(f: T.StructField) -> Column:
    """A value as text; equal values have equal texts: NaN is no value, -0.0 is 0.0."""
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
        c = F.when(~F.isnan(c), c + F.lit(0.0).cast(f.dataType))
    return c.cast("string")


def _long(df: DataFrame, value_expr=None, keep=()) -> DataFrame:
    """(keep..., posicion, columna, valor) for every cell, values as text."""
    cells = [F.struct(F.lit(i).alias("posicion"), F.lit(f.name).alias("columna"),
                      (value_expr(F.col(f"`{f.name}`")) if value_expr else _as_text(f)).alias("valor"))
             for i, f in enumerate(f for f in df.schema.fields if f.name not in keep)]
    return df.select(*keep, F.explode(F.array(*cells)).alias("_c")).select(*keep, "_c.*")


def _value_key(valor):
    """Values are grouped by their SHA-256, so wide text columns shuffle keys of a fixed size."""
    return F.unhex(F.sha2(valor, 256))


def _column_catalogue(spark: SparkSession, df: DataFrame) -> DataFrame:
    """One row per column of the schema (metadata, bounded by the column count)."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    schema = "posicion int, columna string, tipo string"
    return spark.createDataFrame(rows, schema)


def profile_table(df: DataFrame, name: str, approximate: bool = False) -> DataFrame:
    """Per column: nulls, percent of nulls, repeated values, type, distinct non-null values.

    ``duplicados`` counts rows whose value already appeared (null is one value; NaN is
    null, and -0.0 equals 0.0).
    ``approximate=True`` uses HyperLogLog sketches (one pass, no shuffle of values).
    """
    spark = df.sparkSession
    cat = _column_catalogue(spark, df)
    long = _long(df)
    if approximate:
        per_col = long.groupBy("columna").agg(
            F.count(F.lit(1)).alias("total"),
            F.sum(F.col("valor").isNull().cast("long")).alias("nulos"),
            F.approx_count_distinct("valor").alias("unicos"))
        per_col = per_col.withColumn(
            "duplicados", F.col("total") - F.col("unicos") - (F.col("nulos") > 0).cast("long"))
    else:
        per_value = long.groupBy("columna", _value_key(F.col("valor")).alias("valor")).agg(
            F.count(F.lit(1)).alias("n"))
        per_col = per_value.groupBy("columna").agg(
            F.sum("n").alias("total"),
            F.coalesce(F.sum(F.when(F.col("valor").isNull(), F.col("n"))), F.lit(0)).alias("nulos"),
            F.count("valor").alias("unicos"),
            (F.sum("n") - F.count(F.lit(1))).alias("duplicados"))
    # per_col has one row per column: broadcasting it is bounded by the schema, not the data
    joined = cat.join(F.broadcast(per_col), "columna", "left")
    out = joined.select(
        F.lit(name).alias("tabla"), "columna", "posicion", "tipo",
        F.coalesce(F.col("total"), F.lit(0)).cast("long").alias("total_filas"),
        F.lit(len(df.columns)).cast("long").alias("total_cols"),
        F.coalesce(F.col("nulos"), F.lit(0)).cast("long").alias("nulos"),
        F.coalesce(F.col("duplicados"), F.lit(0)).cast("long").alias("duplicados"),
        F.coalesce(F.col("unicos"), F.lit(0)).cast("long").alias("unicos"))
    return out.withColumn("pct_nulos", R.percent(F.col("nulos"), F.col("total_filas")))


def profile_tables(df: DataFrame, table_col: str) -> DataFrame:
    """:func:`profile_table` for many tables in one job: ``table_col`` names each row's table."""
    data = df.drop(table_col)
    spark = df.sparkSession
    cat = _column_catalogue(spark, data)
    long = _long(df, keep=(table_col,)).withColumnRenamed(table_col, "tabla")
    per_value = long.groupBy("tabla", "columna", _value_key(F.col("valor")).alias("valor")).agg(
        F.count(F.lit(1)).alias("n"))
    per_col = per_value.groupBy("tabla", "columna").agg(
        F.sum("n").alias("total_filas"),
        F.coalesce(F.sum(F.when(F.col("valor").isNull(), F.col("n"))), F.lit(0)).alias("nulos"),
        F.count("valor").alias("unicos"),
        (F.sum("n") - F.count(F.lit(1))).alias("duplicados"))
    # the column catalogue is bounded by the schema
    out = per_col.join(F.broadcast(cat), "columna")
    return out.select(
        "tabla", "columna", "posicion", "tipo", F.col("total_filas").cast("long").alias("total_filas"),
        F.lit(len(data.columns)).cast("long").alias("total_cols"), F.col("nulos").cast("long").alias("nulos"),
        F.col("duplicados").cast("long").alias("duplicados"), F.col("unicos").cast("long").alias("unicos"),
        R.percent(F.col("nulos"), F.col("total_filas")).alias("pct_nulos"))


def quality_summary(profile: DataFrame) -> DataFrame:
    """Per table: rows, columns with any null, largest percent of nulls (0 when none)."""
    return profile.groupBy("tabla").agg(
        F.max("total_filas").alias("total_filas"),
        F.count(F.when(F.col("nulos") > 0, 1)).alias("columnas_con_nulos"),
        F.coalesce(F.max("pct_nulos"), F.lit(0.0)).alias("max_pct_nulos"))


def first_n(df: DataFrame, n: int, ordinal: str, buckets: int = 10_000, narrow: bool = False) -> DataFrame:
    """The first ``n`` records by ``ordinal`` (exact; null ordinals first; ties in any order).

    A numeric ordinal's range is cut into ``buckets``. How many rows lie in each (one
    partial aggregate) tells the bucket in which the n-th record lies: the buckets below
    it pass by a plain filter, and only that bucket's rows are ranked. All of it is one
    lazy plan. An ordinal of another type is merged by a top-n, whose n rows meet in one
    task: for reports of a few rows.

    Buckets are of equal width, so values far from all others leave most rows in one
    bucket, and that bucket's rows to one task. ``narrow`` runs a few small aggregates
    now and bounds that task whatever the values are
    (:func:`tableflow.operators.selection.first_n`).
    """
    if narrow:
        return selection.first_n(df, n, ordinal)
    kind = df.schema[ordinal].dataType
    if not isinstance(kind, T.NumericType):
        return df.orderBy(F.col(ordinal)).limit(n)
    ends = df.agg(F.min(ordinal).cast("double").alias("lo"), F.max(ordinal).cast("double").alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    at = F.floor((F.col(ordinal).cast("double") - lo) / F.greatest(hi - lo, F.lit(1e-300)) * buckets)
    bucket = F.coalesce(F.least(F.greatest(at, F.lit(0)), F.lit(buckets)), F.lit(-1)).cast("int")
    placed = df.withColumn("_tf_bucket", bucket)
    counts = placed.groupBy("_tf_bucket").agg(F.count(F.lit(1)).alias("n"))
    # at most buckets + 2 rows
    upto = counts.withColumn("upto", F.sum("n").over(Window.orderBy("_tf_bucket")))
    last = upto.filter(F.col("upto") >= n).agg(F.min("_tf_bucket")).scalar()
    edge = F.coalesce(last, F.lit(buckets + 1))
    before = upto.filter(F.col("upto") < n).agg(F.coalesce(F.max("upto"), F.lit(0))).scalar()
    whole = placed.filter(F.col("_tf_bucket") < edge)
    part = (placed.filter(F.col("_tf_bucket") == edge)
            .withColumn("_tf_rank", F.row_number().over(Window.orderBy(ordinal))).filter(F.col("_tf_rank") <= F.lit(n) - before))
    return whole.unionByName(part.drop("_tf_rank")).drop("_tf_bucket")


def row_cap(df: DataFrame, cap: int, ordinal: str, narrow: bool = False) -> tuple[DataFrame, DataFrame]:
    """(the first ``cap`` rows, a one-row report saying whether the cap cut any row).

    Off by default in the loaders; when used, the cut is reported instead of silent.
    """
    report = df.agg(F.count(F.lit(1)).alias("filas_fuente")).select(
        "filas_fuente", F.lit(cap).cast("long").alias("tope"), (F.col("filas_fuente") > cap).alias("recortado"))
    return first_n(df, cap, ordinal, narrow=narrow), report


def inspect_columns(sample: DataFrame, ordinal: str | None = None) -> DataFrame:
    """Per column of a text sample: inferred kind (int < float < str) and percent of nulls.

    Null tokens ('', 'null', 'none' after strip + lower) count as nulls; a column with
    no value at all is 'str'.
    """
    data = sample.drop(ordinal) if ordinal else sample
    long = _long(data, lambda c: R.null_token(c))
    ranked = long.select("posicion", "columna", "valor",
                         F.when(F.col("valor").isNotNull(), R.value_kind(F.col("valor"))).alias("kind"))
    rank = (F.when(F.col("kind") == "int", 1).when(F.col("kind") == "float", 2)
             .when(F.col("kind") == "str", 3))
    per_col = ranked.groupBy("posicion", "columna").agg(
        F.count(F.lit(1)).alias("filas_analizadas"),
        F.sum(F.col("valor").isNull().cast("long")).alias("nulos"),
        F.max(rank).alias("_rank"))
    return per_col.select(
        "columna", "posicion",
        (F.when(F.col("_rank") == 1, "int").when(F.col("_rank") == 2, "float").otherwise("str")).alias("tipo_inferido"),
        R.percent(F.col("nulos"), F.col("filas_analizadas")).alias("porcentaje_nulos"),
        F.col("filas_analizadas").cast("long").alias("filas_analizadas"))


def critical_columns(inspection: DataFrame, threshold: float = S.CRITICAL_NULL_PERCENT) -> DataFrame:
    """Columns above the null threshold, most empty first."""
    return inspection.filter(F.col("porcentaje_nulos") > threshold).orderBy(F.desc("porcentaje_nulos"))


def head_tail(sample: DataFrame, ordinal: str, k: int = 5) -> DataFrame:
    """First and last ``k`` rows with null tokens applied, each value's kind, and its value as a number
    if it is one (``_int``, ``_float``)."""
    cols = [c for c in sample.columns if c != ordinal]
    shaped = sample.select(ordinal, *[R.null_token(c).alias(c) for c in cols])
    typed = shaped.select(ordinal, *cols, *[F.when(F.col(c).isNotNull(), R.value_kind(F.col(c))).alias(f"{c}_kind")
                                            for c in cols],
                          *[R.typed_value(c)[f"as_{t}"].alias(f"{c}_{t}") for c in cols for t in ("int", "float")])
    head = typed.orderBy(F.col(ordinal)).limit(k).withColumn("lado", F.lit("head"))
    tail = typed.orderBy(F.col(ordinal).desc()).limit(k).withColumn("lado", F.lit("tail"))
    return head.unionByName(tail)


def inspect_file(spark: SparkSession, path: str, sample_rows: int | None = None, ignored=(), report_path: str | None = None,
                 sep: str = S.BULK_SEPARATOR, encoding: str = S.BULK_ENCODING) -> dict[str, DataFrame]:
    """Inspect a raw delimited file: line count and header width, per-column kind and nulls, critical
    columns, first and last rows. Quoted line breaks belong to their record.

    All records are judged; ``sample_rows`` restricts it to the first ones on request.

    Returns the frames (nothing is collected); with ``report_path`` the column report is
    written as JSON (one row per column).
    """
    from tableflow.operators.records import drop_columns
    from tableflow.sources import delimited as DL
    from tableflow.sources.file_records import read_records

    raw = read_records(spark, path, sep=sep, encoding=encoding, drop_quotes=True, number=DL.ORDINAL)
    width = len(raw.columns) - 1
    sample = drop_columns(raw, ignored)
    if sample_rows is not None:
        sample = sample.where(F.col(DL.ORDINAL) <= sample_rows)  # the ordinal counts the records
    columns = inspect_columns(sample, ordinal=DL.ORDINAL)
    if report_path:
        columns.coalesce(1).write.mode("overwrite").json(report_path)
    return {
        "lineas": DL.line_count(spark, path).withColumn("columnas", F.lit(width).cast("long")),
        "columnas": columns,
        "criticas": critical_columns(columns),
        "extremos": head_tail(sample, DL.ORDINAL),
    }

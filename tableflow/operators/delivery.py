"""Delivery: final file names, content digests and the integrity manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow import spec as S


def delivery_name(table: Column, start: str, end: str) -> Column:
    """``TABLE_YYYY_MM-MM.csv``: upper-case table, start year, start and end month."""
    return F.concat(F.upper(table), F.lit(f"_{start[:4]}_{start[5:7]}-{end[5:7]}.csv"))


def delivery_file_name(table: str, start: str, end: str) -> str:
    """The same name for one table given on the driver (for the output path)."""
    return f"{table.upper()}_{start[:4]}_{start[5:7]}-{end[5:7]}.csv"


def row_text(df: DataFrame, columns=None) -> Column:
    """Canonical text of a row: each field as its length and its text, ``-`` for null, so that no two
    different rows share a text."""
    fields = [F.col(c).cast("string") for c in columns or df.columns]
    return F.concat(*[F.coalesce(F.concat(F.length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in fields])


def content_digest(df: DataFrame, by=None, columns=None) -> DataFrame:
    """Layout-independent digest: row count and the sum of 60 bits of each row's MD5.

    The same rows give the same digest whatever the partitioning or file split; a
    sum (not xor) so that duplicate rows do not cancel.
    """
    h = F.conv(F.substring(F.md5(row_text(df, columns)), 1, 15), 16, 10).cast("decimal(38,0)")
    aggs = [F.count(F.lit(1)).alias("filas"), F.sum(h).cast("string").alias("digest")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def part_file_md5(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """MD5 and length of every delivered part file's bytes (what a receiver checks per file).

    A part is read whole by one task, so deliver parts of a bounded size.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select(F.col("path"), F.col("length"), F.md5("content").alias("md5"))


def parts_by_table(parts: DataFrame, pattern: str = r"/tabla=([^/]+)/") -> DataFrame:
    """(tabla, partes): the delivered parts of each table by name, with their length and MD5."""
    return (parts.withColumn("tabla", F.regexp_extract("path", pattern, 1))
            .groupBy("tabla").agg(F.array_sort(F.collect_list(F.struct(
                F.regexp_extract("path", r"([^/]+)$", 1).alias("archivo"), F.col("length").alias("bytes"), "md5"))).alias("partes")))


def manifest(counts: DataFrame, digests: DataFrame, summary: DataFrame | None, start: str, end: str,
             columns: dict[str, list[str]] | None = None, version: str = S.ETL_VERSION,
             parts: DataFrame | None = None) -> DataFrame:
    """One manifest row per delivered table.

    counts: (tabla, filas_oracle, filas_csv); digests: (tabla, digest) of the rows read
    back from the delivered files; parts: (tabla, partes) of :func:`parts_by_table`;
    summary: the quality summary (tabla, total_filas, columnas_con_nulos, max_pct_nulos)
    or None.
    """
    m = counts.join(digests.select("tabla", "digest"), "tabla", "left")
    m = m.join(parts, "tabla", "left") if parts is not None else m.withColumn("partes", F.lit(None))
    if summary is not None:
        q = summary.select("tabla", F.struct("total_filas", "columnas_con_nulos", "max_pct_nulos")
                           .alias("problemas_calidad"))
        m = m.join(q, "tabla", "left")
    else:
        m = m.withColumn("problemas_calidad", F.lit(None))
    out = m.select(
        "tabla", F.lit(start).alias("periodo_inicio"), F.lit(end).alias("periodo_fin"),
        delivery_name(F.col("tabla"), start, end).alias("archivo"),
        F.col("filas_oracle").cast("long").alias("filas_oracle"), F.col("filas_csv").cast("long").alias("filas_csv"),
        "digest", "partes", "problemas_calidad", F.lit(version).alias("generado_por"))
    if columns:
        cmap = F.create_map(*[x for t, cs in columns.items() for x in (F.lit(t.upper()), F.lit(",".join(cs)))])
        out = out.withColumn("columnas", cmap[F.col("tabla")])
    return out


def write_manifest(df: DataFrame, path: str) -> None:
    """Manifest rows as JSON lines, stamped with the generation time."""
    df.withColumn("generado_en", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")) \
      .coalesce(1).write.mode("overwrite").json(path)

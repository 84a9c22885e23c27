"""Period files: ``{table}_{start}_{end}.csv`` per table, found by name."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.sources.delimited import TIMESTAMP_TEXT, write_csv


def period_label(start: str, end: str) -> str:
    return f"{start}_{end}"


def period_path(root: str, table: str, start: str, end: str, suffix: str = "") -> str:
    return f"{root.rstrip('/')}/{table.lower()}_{period_label(start, end)}{suffix}.csv"


def write_period_table(df: DataFrame, root: str, table: str, start: str, end: str, suffix: str = "") -> str:
    path = period_path(root, table, start, end, suffix)
    write_csv(df, path)
    return path


def write_period_tables(df: DataFrame, root: str, table_col: str, start: str, end: str) -> None:
    """Rows of many tables in one write, each in the folder of its name and period.

    The folder name is a partition column: ``<table>_<start>_<end>.csv`` under ``archivo=``.
    """
    name = F.concat(F.lower(table_col), F.lit(f"_{period_label(start, end)}.csv"))
    (df.withColumn("archivo", name).drop(table_col).write.mode("overwrite").partitionBy("archivo")
       .option("header", True).option("encoding", "UTF-8").option("timestampFormat", TIMESTAMP_TEXT)
       .option("timestampNTZFormat", TIMESTAMP_TEXT).option("ignoreLeadingWhiteSpace", False)
       .option("ignoreTrailingWhiteSpace", False).csv(root))


def read_period_files(spark: SparkSession, root: str, start: str, end: str, schema=None,
                      suffix: str = "") -> DataFrame:
    """All tables of a period in one scan, with the table name (upper case) from the file path."""
    glob = f"{root.rstrip('/')}/*_{period_label(start, end)}{suffix}.csv"
    reader = (spark.read.option("header", True).option("timestampFormat", TIMESTAMP_TEXT)
              .option("timestampNTZFormat", TIMESTAMP_TEXT))
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", False)
    df = reader.csv(glob)
    pattern = r"/(?:archivo=)?([^/]+)_" + re.escape(period_label(start, end) + suffix) + r"\.csv(/|$)"
    name = F.upper(F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))
    return df.withColumn("tabla", name)

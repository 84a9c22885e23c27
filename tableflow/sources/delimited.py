"""Delimited text files (the bulk file and the period CSVs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow import spec as S
from tableflow.functions import rules as R
from tableflow.operators.records import normalise_headers

ORDINAL = "_tf_ordinal"
LINE = "_tf_linea"


def read_delimited(spark: SparkSession, path: str, sep: str = S.BULK_SEPARATOR,
                   encoding: str = S.BULK_ENCODING, multi_line: bool = False,
                   normalise: bool = True, drop_quotes: bool = False,
                   corrupt_column: str | None = None) -> DataFrame:
    """Text records with a header, every field a string.

    Quoting with ``"`` and doubled quotes, blank lines skipped, extra fields ignored,
    short records filled with null. ``multi_line`` only when fields hold line breaks:
    Spark's reader does not split such a file, so it is one task for each file. That fits
    many files of moderate size; :func:`tableflow.sources.file_records.read_records` reads
    a large one by many tasks. ``corrupt_column`` names a column that holds the whole text
    of a record of too few or too many fields (else null).
    """
    reader = (spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
              .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
              .option("mode", "PERMISSIVE"))
    if corrupt_column:
        # the column appears only if the schema names it
        names = reader.csv(path).columns
        fields = ", ".join(f"`{c}` string" for c in [*names, corrupt_column])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column).schema(fields)
    df = reader.csv(path)
    return normalise_headers(df, drop_quotes) if normalise else df


def write_delimited(df: DataFrame, path: str, sep: str = S.BULK_SEPARATOR, encoding: str = S.BULK_ENCODING,
                    mode: str = "overwrite") -> None:
    """Text records with a header; values written exactly (no trimming), null as empty."""
    (df.write.mode(mode).option("header", True).option("sep", sep).option("encoding", encoding)
       .option("quote", '"').option("escape", '"').option("quoteAll", False)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))


def split_records(spark: SparkSession, path: str, out: str, files: int, sep: str = S.BULK_SEPARATOR,
                  encoding: str = S.BULK_ENCODING) -> None:
    """Land files with quoted line breaks once as ``files`` files of whole records in the same format.

    The original is read by as many tasks as it has splits, so a single huge file is too.
    Records keep their fields and each carries ``_tf_linea``, its number in the original,
    so order-dependent rules (first row of a key wins) still hold; streams, which never
    split a file, then take the parts as batches.
    """
    from tableflow.sources.file_records import read_records

    placed = read_records(spark, path, sep=sep, encoding=encoding, normalise=False, number=LINE)
    write_delimited(placed.withColumn(LINE, F.col(LINE).cast("string")).repartition(files), out, sep=sep, encoding=encoding)


def with_file_ordinal(df: DataFrame) -> DataFrame:
    """A sort key that follows file order: (file, block start, increasing id within the split)."""
    return df.withColumn(ORDINAL, F.struct(F.col("_metadata.file_path").alias("file"),
                                           F.col("_metadata.file_block_start").alias("block"),
                                           F.monotonically_increasing_id().alias("id")))


# Texts of an unquoted or quoted CSV field that mean "no value" (case counts)
CSV_NULLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
             "NULL", "NaN", "None", "n/a", "nan", "null")
_INT_RE, _FLOAT_RE = r"^[+-]?[0-9]{1,18}$", r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def null_csv_tokens(df: DataFrame, tokens=CSV_NULLS) -> DataFrame:
    """Text columns with the null tokens as null."""
    return df.select(*[F.when(~F.col(f"`{c}`").isin(*tokens), F.col(f"`{c}`")).alias(c) for c in df.columns])


def infer_types(df: DataFrame) -> DataFrame:
    """Text columns cast to bigint, double or boolean where every value of all rows is one.

    The kinds are one partial aggregate over the whole table (a schema is needed before
    a plan can be built, so this runs a job, like any inferred schema).
    """
    fits = {"bigint": lambda c: c.rlike(_INT_RE), "double": lambda c: c.rlike(_FLOAT_RE),
            "boolean": lambda c: F.lower(c).isin("true", "false")}
    aggs = [F.coalesce(F.every(F.coalesce(test(F.col(f"`{c}`")), F.lit(True))), F.lit(True)).alias(f"{i}_{t}")
            for i, c in enumerate(df.columns) for t, test in fits.items()]
    aggs += [F.count(F.col(f"`{c}`")).alias(f"{i}_n") for i, c in enumerate(df.columns)]
    r = df.agg(*aggs).first()
    out = []
    for i, c in enumerate(df.columns):
        kind = next((t for t in fits if r[f"{i}_n"] and r[f"{i}_{t}"]), "string")
        out.append(F.col(f"`{c}`").cast(kind).alias(c))
    return df.select(*out)


def read_csv_inferred(spark: SparkSession, path: str, tokens=CSV_NULLS) -> DataFrame:
    """CSV with a header: the null tokens become null first, then types are inferred from what is left."""
    reader = spark.read.option("header", True).option("inferSchema", False).option("escape", '"')
    return infer_types(null_csv_tokens(reader.csv(path), tokens))


TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """UTF-8 CSV with a header (one directory per table and period); timestamps keep microseconds."""
    (df.write.mode(mode).option("header", True).option("encoding", "UTF-8")
       .option("timestampFormat", TIMESTAMP_TEXT).option("timestampNTZFormat", TIMESTAMP_TEXT)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return (spark.read.option("header", True).option("timestampFormat", TIMESTAMP_TEXT)
            .option("timestampNTZFormat", TIMESTAMP_TEXT).schema(schema).csv(path))


def write_csv_by_table(df: DataFrame, root: str, table_col: str) -> None:
    """Rows of many tables as CSV, one folder ``<table_col>=<name>`` each, in one write."""
    (df.write.mode("overwrite").partitionBy(table_col).option("header", True).option("encoding", "UTF-8")
       .option("timestampFormat", TIMESTAMP_TEXT).option("timestampNTZFormat", TIMESTAMP_TEXT).option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(root))


def read_csv_by_table(spark: SparkSession, root: str, schema, table_col: str) -> DataFrame:
    """What :func:`write_csv_by_table` wrote, the table's name as a column."""
    full = T.StructType([*schema.fields, T.StructField(table_col, T.StringType())])
    return (spark.read.option("header", True).option("escape", '"').option("timestampFormat", TIMESTAMP_TEXT)
            .option("timestampNTZFormat", TIMESTAMP_TEXT).schema(full).csv(root))


def line_count(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines after each file's header line (a line count, not a record count)."""
    per_file = spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(
        (F.count(F.lit(1)) - 1).alias("n"))
    return per_file.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_filas"))

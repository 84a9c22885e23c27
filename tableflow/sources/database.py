"""Database tables read for a date window.

The reference pages through ``ORDER BY pk OFFSET .. FETCH NEXT ..`` one page at a
time. On Spark the same rows are read as parallel range partitions of the key
(``partitionColumn/lowerBound/upperBound/numPartitions``) and the window stays a
DataFrame filter, which the JDBC and Parquet sources push down into the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow import spec as S


def window_predicate(column: str, start: str, end: str, dtype: str = "timestamp") -> Column:
    """Half-open day window ``[start, end + 1 day)``.

    The bounds are literals of the column's own type, so the comparison is pushed
    into the scan (Parquet row-group statistics, JDBC WHERE clause).
    """
    c = F.col(column)
    cast = "timestamp_ntz" if dtype == "timestamp_ntz" else ("date" if dtype == "date" else "timestamp")
    lo = F.lit(start).cast(cast)
    hi = F.lit(end).cast("date") + F.expr("INTERVAL 1 DAY") if cast == "date" else \
        F.lit(end).cast(cast) + F.expr("INTERVAL 1 DAY")
    return (c >= lo) & (c < hi)


def extract_window(df: DataFrame, column: str | None, start: str, end: str) -> DataFrame:
    """Rows of the period; a catalogue table (no date column) is read whole."""
    if column is None:
        return df
    dtype = df.schema[column].dataType.simpleString()
    return df.filter(window_predicate(column, start, end, dtype))


def count_window(df: DataFrame, column: str | None, start: str, end: str, by=None) -> DataFrame:
    """Source row count under the same predicate as the extract (per ``by`` when given)."""
    w = extract_window(df, column, start, end)
    agg = F.count(F.lit(1)).alias("filas")
    return w.groupBy(*by).agg(agg) if by else w.agg(agg)


def page_slice(df: DataFrame, key: str, page: int, page_rows: int, narrow: bool = False) -> DataFrame:
    """One page of the table in the order of a unique numeric key: its rows after ``page * page_rows`` of them.

    The page's ends are found by counting (:func:`tableflow.operators.profiling.first_n`),
    so a deep page is as cheap as the first and no task holds the pages before it. With
    ``narrow`` that holds whatever the keys' spread is, for a few small jobs now.
    """
    from tableflow.operators.profiling import first_n

    upto = first_n(df, (page + 1) * page_rows, key, narrow=narrow)
    if page == 0:
        return upto
    return upto.filter(F.col(key) > first_n(df, page * page_rows, key, narrow=narrow).agg(F.max(key)).scalar())


def range_predicates(column: str, lower: int, upper: int, partitions: int) -> list[str]:
    """Predicates that split a numeric column into ranges, like the JDBC reader's partitions.

    The first range also takes nulls and values below ``lower``, the last one values
    above ``upper``: together they cover every row exactly once.
    """
    partitions = max(1, min(partitions, max(upper - lower, 1)))
    stride = (upper - lower) // partitions or 1
    bounds = [lower + i * stride for i in range(1, partitions)]
    if not bounds:
        return ["1 = 1"]
    preds = [f"{column} < {bounds[0]} OR {column} IS NULL"]
    preds += [f"{column} >= {a} AND {column} < {b}" for a, b in zip(bounds, bounds[1:])]
    preds.append(f"{column} >= {bounds[-1]}")
    return preds


def union_pages(df: DataFrame, predicates: list[str]) -> DataFrame:
    """Bag union of disjoint range partitions in one scan: the rows that any of them takes."""
    return df.filter(" OR ".join(f"({p})" for p in predicates))


def jdbc_options(url: str, table: str, partition_column: str | None = None, lower: int | None = None,
                 upper: int | None = None, partitions: int | None = None, fetch_size: int = 10_000,
                 **extra) -> dict:
    """Options of ``spark.read.format("jdbc")`` for a parallel, paged read of one table."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column:
        opts.update(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
                    numPartitions=str(partitions or 1))
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_jdbc(spark: SparkSession, options: dict) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def jdbc_reader(spark: SparkSession, url: str, partitions: int = 8, load=read_jdbc, **extra):
    """A reader for the extract phase: ``reader(table, key)``.

    With a numeric key the table is read as ranges between the key's ends (one query of
    one row); otherwise, and for a table without a key, as one partition. ``load`` takes
    (spark, options).
    """
    def read(table: str, key: str | None = None) -> DataFrame:
        if not key or key == S.DEFAULT_KEY:
            return load(spark, jdbc_options(url, table, **extra))
        ends = load(spark, jdbc_options(url, f"(SELECT min({key}) AS lo, max({key}) AS hi FROM {table}) e", **extra))
        if not isinstance(ends.schema["lo"].dataType, T.NumericType):
            return load(spark, jdbc_options(url, table, **extra))
        r = ends.first()
        return load(spark, jdbc_options(url, table, key, int(r["lo"] or 0), int(r["hi"] or 0) + 1, partitions, **extra))

    return read


def key_catalogue_queries(owner_filter: str | None = None) -> dict[str, str]:
    """Queries for the constraint catalogue views read by :func:`tableflow.operators.ledger.detect_keys`."""
    where = ""
    if owner_filter:
        name = owner_filter.replace("'", "''")
        where = f" WHERE owner = '{name}'"
    return {
        "constraints": f"(SELECT constraint_name, owner, constraint_type, table_name FROM all_constraints{where}) c",
        "columns": f"(SELECT constraint_name, owner, column_name, position FROM all_cons_columns{where}) k",
    }

"""Inputs derived from the driver tables by expression.

The driver tables hold clean, typed values. The operators of this package exist for
dirty text, so each input here rewrites a whole table into the text a source system
would hand over (mixed date layouts, padded and mixed-case text, code 0, junk, null
tokens, natural duplicates). Every derivation is a narrow projection or one join of
whole tables: it grows with the data and adds no shuffle beyond that join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow import spec as S
from tableflow.operators.ledger import mismatch_message

NBSP, NEL, TAB, LF, CR = "\u00a0", "\u0085", "\t", "\n", "\r"

# Spark layouts of the date texts, selected by key modulus (same order as in the oracle SQL)
_SPARK_LAYOUTS = ("dd/MM/yyyy", "yyyy-MM-dd", "dd-MM-yyyy", "yy-MM-dd", "dd-MM-yy", "d/M/yyyy")


#: rows that a task gets at most where rows are dealt out
SPREAD_ROWS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A driver table. ``spread=True`` deals its rows out evenly before a CPU-heavy derivation,
    since a driver table is one file of one row group; the operators themselves never
    redistribute their input."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if not spread:
        return df
    return df.repartition(max(spark.sparkContext.defaultParallelism, -(-df.count() // SPREAD_ROWS)))   # counted from the footers


def _s(c: Column) -> Column:
    return c.cast("string")


def _date_text(d: Column, selector: Column) -> Column:
    out = None
    for i, layout in enumerate(_SPARK_LAYOUTS):
        arm = F.date_format(d, layout)
        out = F.when(selector == i, arm) if out is None else out.when(selector == i, arm)
    return out


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as a delimited-file extract: every field is text, most of it dirty.

    Columns use the bulk file's names, so the bulk spec applies; the other bulk columns
    are absent and become null when projected onto the spec.
    """
    o = table(spark, sf_dir, "orders", spread=True)
    k, ck, d = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    ks = _s(k)
    idpersona = (F.when(k % 97 == 5, F.concat(F.lit("7" * 38), ks))    # more digits than any column holds
                  .when(k % 6 == 0, F.concat(F.lit("+"), ks))
                  .when(k % 6 == 1, F.concat(F.lit(" "), ks, F.lit(" ")))
                  .when(k % 6 == 2, F.concat(ks, F.lit(".0")))
                  .when(k % 6 == 3, F.concat(ks, F.lit("_0")))
                  .when(k % 6 == 4, F.concat(F.lit("--"), ks))
                  .otherwise(ks))
    occurred = _date_text(d, k % 6)
    occurred = (F.when(k % 17 == 0, F.lit(None).cast("string"))
                 .when(k % 13 == 0, F.lit("no-date"))
                 .when(k % 11 == 0, F.lit("01/01/1900"))
                 .when(k % 7 == 0, F.concat(F.lit(TAB), occurred, F.lit(" ")))
                 .otherwise(occurred))
    reported = _date_text(F.date_add(d, (ck % 30).cast("int")), (k + 3) % 6)
    reported = F.when(k % 19 == 0, F.lit("31/02/1999")).otherwise(reported)
    p = F.col("o_orderpriority")
    hecho = (F.when(k % 4 == 0, F.concat(F.lit("  "), F.upper(p), F.lit(" ")))
              .when(k % 4 == 1, F.concat(F.lit(NBSP), p, F.lit(TAB)))
              .when(k % 4 == 2, F.replace(p, F.lit("-"), F.lit(LF + " - " + CR)))
              .otherwise(F.concat(F.lower(p), F.lit(NEL))))
    code = (F.when(ck % 5 == 0, F.lit("0"))
             .when(ck % 5 == 1, F.lit("00"))
             .when(ck % 5 == 2, F.lit("-0"))
             .when(ck % 5 == 3, F.lpad(_s(ck), 5, "0"))
             .otherwise(_s(ck)))
    st = F.col("o_orderstatus")
    codigohecho = (F.when(st == "F", F.lit("1")).when(st == "O", F.lit(" 2 ")).otherwise(F.lit("3")))
    nombre = (F.when(k % 9 == 0, F.lit("   "))
               .when(k % 9 == 1, F.lit("NULL"))
               .when(k % 9 == 2, F.lit(" none"))
               .otherwise(F.concat(F.lit("Cliente "), _s(ck))))
    return o.select(
        k.alias("row_no"),
        idpersona.alias("idpersona"),
        codigohecho.alias("codigohecho"),
        occurred.alias("fechaocurrencia"),
        reported.alias("fechareporte"),
        code.alias("coddanemunicipioocurrencia"),
        _s(F.col("o_totalprice").cast("bigint")).alias("discapacidad"),
        hecho.alias("hecho"),
        nombre.alias("primernombre"),
        F.when(k % 3 == 0, F.lower(st)).otherwise(st).alias("tipodocumento"),
        F.repeat(p, 4).alias("origen"),
        F.concat(F.lit("Calle "), _s(ck % 100), F.lit(" # "), ks).alias("direccion"),
    )


def wide_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`dirty_orders` with a value in every column of the bulk file, by the column's rule."""
    d = dirty_orders(spark, sf_dir)
    own = {S.DATE: "fechareporte", S.DATE_TEXT: "fechaocurrencia", S.CODE: "coddanemunicipioocurrencia", S.INT: "codigohecho"}
    text = F.concat(F.lit(" "), F.col("hecho"), F.lit(TAB), F.col("tipodocumento"))
    return d.select("row_no", *[F.col(r.name) if r.name in d.columns else
                                (F.col(own[r.kind]) if r.kind in own else text).alias(r.name) for r in S.BULK_SPEC.columns])


def raw_header_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dirty_orders`` with the header a text file would carry (blanks, quotes, case)."""
    df = dirty_orders(spark, sf_dir)
    return df.toDF(*[f' "{c.upper()}" ' if i % 2 else f"  {c.title()}" for i, c in enumerate(df.columns)])


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A period table shaped like PACIENTES, extracted once per order of the patient.

    ``customer`` joined to ``orders``: each customer row repeats once per order, so
    full-row duplicates arise naturally (and skew with the order count). Names are
    padded, some missing; birth dates are text, some invalid.
    """
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders", spread=True).select("o_custkey")
    ck = F.col("c_custkey")
    birth = F.date_format(F.date_add(F.lit("1940-01-01").cast("date"),
                                     F.abs(F.col("c_acctbal")).cast("int")), "yyyy-MM-dd")
    birth = (F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("no-es-fecha"))
              .when(F.col("c_nationkey") == 3, F.lit(None).cast("string"))
              .otherwise(birth))
    name = (F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
             .when(ck % 2 == 0, F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
             .otherwise(F.concat(F.col("c_name"), F.lit(TAB))))
    created = F.concat(F.lit("2024-01-"), F.lpad(_s(ck % 28 + 1), 2, "0"),
                       F.when(ck % 10 == 0, F.lit("T08:30:00")).otherwise(F.lit(" 10:15:00")))
    created = F.when(F.col("c_nationkey") == 7, F.lit("2024-13-01")).otherwise(created)
    return c.join(o, c.c_custkey == o.o_custkey, "inner").select(
        F.when(F.col("c_nationkey") == 11, F.lit(None).cast("bigint")).otherwise(ck).alias("PACIENTE_ID"),
        name.alias("NOMBRE"),
        birth.alias("FECHA_NACIMIENTO"),
        created.alias("CREATED_AT"),
        F.concat(F.lit(" "), F.col("c_mktsegment")).alias("SEGMENTO"),
        F.col("c_nationkey").alias("MUNICIPIO_ID"),
    )


def customer_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` with holes driven by the data itself (negative balance, some nations)."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("c_name"),
        F.when(F.col("c_nationkey") < 10, F.lit(None).cast("int")).otherwise(F.col("c_nationkey")).alias("c_nationkey"),
        F.when(F.col("c_acctbal") > 9000, F.lit(None).cast("double")).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_nationkey") < 24, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )


def customer_floats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer_holes`` with the float values that compare oddly: NaN, 0.0 and -0.0."""
    k = F.col("c_custkey")
    odd = (F.when(k % 50 == 1, F.lit(float("nan"))).when(k % 50 == 2, F.lit(0.0)).when(k % 50 == 3, F.lit(-0.0))
            .otherwise(F.col("c_acctbal")))
    return customer_holes(spark, sf_dir).withColumn("c_acctbal", odd)


def customer_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as text with texts that CSV readers take for nulls, and some that only look like them."""
    k = F.col("c_custkey")
    pick = lambda c, *words: F.when(k % 7 < len(words), F.element_at(F.array(*map(F.lit, words)), (k % 7 + 1).cast("int"))).otherwise(_s(F.col(c)))
    return table(spark, sf_dir, "customer").select(
        _s(k).alias("c_custkey"), pick("c_name", "NA", "N/A", "NONE", "none", "Null").alias("c_name"),
        pick("c_nationkey", "<NA>", "", "null").alias("c_nationkey"), pick("c_acctbal", "NaN", "#N/A").alias("c_acctbal"),
        F.when(k % 2 == 0, "True").when(k % 3 == 0, "nan").otherwise("False").alias("c_active"),
        pick("c_mktsegment", "None", "n/a").alias("c_mktsegment"))


def customer_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer_holes`` as the text a file inspector reads: null tokens, padding, case."""
    c = customer_holes(spark, sf_dir)
    ck = F.col("c_custkey")
    return c.select(
        ck.alias("row_no"),
        # one late row makes a column of integers a text column
        F.when(ck % 1000 == 999, F.concat(_s(ck), F.lit("x"))).otherwise(_s(ck)).alias("c_custkey"),
        F.when(F.col("c_name").isNull() & (ck % 2 == 0), F.lit("NULL"))
         .when(F.col("c_name").isNull(), F.lit(" none ")).otherwise(F.col("c_name")).alias("c_name"),
        F.coalesce(_s(F.col("c_nationkey")), F.lit("")).alias("c_nationkey"),
        F.coalesce(_s(F.col("c_acctbal")), F.lit("Null")).alias("c_acctbal"),
        F.when(ck % 3 == 0, F.concat(F.lit(" "), F.lit("-"), _s(ck % 7))).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )


LINEITEM_KEY = ("l_orderkey", "l_linenumber", "ship_day")
LINEITEM_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag",
                  "l_linestatus")
LOADED_BEFORE = "1998-01-01"


def lineitem_incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as rows to load, keyed by (order, line, ship day); returned lines have no ship day."""
    li = table(spark, sf_dir, "lineitem", spread=True)
    ship_day = F.when(F.col("l_returnflag") == "N", F.lit(None).cast("date")).otherwise(F.col("l_shipdate").cast("date"))
    return li.select("l_orderkey", "l_linenumber", ship_day.alias("ship_day"), "l_partkey", "l_suppkey",
                     "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")


def event_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run ledger made from ``events``: one run per event, table = type + user."""
    e = table(spark, sf_dir, "events")
    tabla = F.concat(F.upper("event_type"), F.lit("_"), _s(F.col("user_id")))
    day = F.date_format(F.col("ts"), "yyyy-MM-dd")
    bad = F.col("value") < 5
    source = F.col("user_id") * 100 + 7
    extracted = source - bad.cast("long")
    return e.select(
        F.col("event_id").alias("id"), tabla.alias("tabla"), day.alias("fecha_inicio"), day.alias("fecha_fin"),
        source.alias("filas_oracle"), extracted.alias("filas_extraidas"),
        F.when(bad, F.lit("ERROR")).otherwise(F.lit("OK")).alias("estado"),
        F.when(bad, mismatch_message(source, extracted))
         .otherwise(F.lit("")).alias("mensaje"),
        F.col("ts").alias("ejecutado_en"))


def event_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table catalogue of the event ledger: every (type, user) seen in ``events``."""
    e = table(spark, sf_dir, "events")
    return e.select(F.concat(F.upper("event_type"), F.lit("_"), _s(F.col("user_id"))).alias("tabla")).distinct()


def run_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark-style results made from ``events``: method, batch, time, memory, speed."""
    e, v = table(spark, sf_dir, "events"), F.col("value")
    # a run that took no time has infinite speed, with the sign of its zero
    endless = F.when(_s(v) == "-0.0", F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    speed = F.when(v == 0, endless).otherwise(F.lit(50000.0) / v)
    return e.select(F.col("event_type").alias("metodo"), F.col("user_id").alias("lote"),
                    v.alias("tiempo_s"), (v * 0.5 + F.col("user_id")).alias("ram_mb"), speed.alias("filas_s"))


def key_catalogue(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tables, constraints, constraint columns) made from customer, orders and lineitem."""
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    tables = c.select(F.concat(F.lit("t"), _s(F.col("c_custkey"))).alias("table_name"))
    ctype = (F.when(F.col("o_orderstatus") == "F", F.lit("P")).when(F.col("o_orderstatus") == "O", F.lit("U"))
              .otherwise(F.lit("R")))
    constraints = o.select(F.concat(F.lit("C"), _s(F.col("o_orderkey"))).alias("constraint_name"),
                           F.lit("HOSP").alias("owner"), ctype.alias("constraint_type"),
                           F.concat(F.lit("T"), _s(F.col("o_custkey"))).alias("table_name"))
    columns = li.select(F.concat(F.lit("C"), _s(F.col("l_orderkey"))).alias("constraint_name"),
                        F.lit("HOSP").alias("owner"), F.concat(F.lit("COL_"), _s(F.col("l_partkey"))).alias("column_name"),
                        F.col("l_linenumber").alias("position"))
    return tables, constraints, columns

"""Set bad and duplicate rows aside with a reason, keep the rest.

Design for skew: a group of identical rows may hold a third of the table. Copies are
counted by one partial aggregate, which collapses a hot group in every map task to one
counted row; where the copies themselves are asked for, large counts are split into
chunks that many tasks emit. No group is ever gathered whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow import spec as S
from tableflow.functions import rules as R
from tableflow.operators.records import strip_columns

PROBLEM = "_problema"
_N, _TAG, _DATES = "_tf_n", "_tf_tag", "_tf_dates"
#: copies that one task emits from one row; more are dealt out in chunks of this many
CHUNK = 1 << 20


def counted_rows(df: DataFrame) -> DataFrame:
    """Every distinct row (nulls equal) with its number: one aggregate, one shuffle."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(_N))


def chunks(n: Column, chunk: int) -> Column:
    """Sizes of the chunks that ``n`` copies fall into (``n`` >= 1)."""
    whole = F.floor((n - 1) / chunk).cast("bigint")
    return F.transform(F.sequence(F.lit(0).cast("bigint"), whole),
                       lambda i: F.when(i < whole, F.lit(chunk)).otherwise(n - whole * chunk).cast("bigint"))


def emit_copies(rows: DataFrame, n: Column, chunk: int = CHUNK) -> DataFrame:
    """Each row ``n`` times. Rows of more copies than a chunk are split into chunks that are dealt out to
    tasks, so neither an array nor a task holds a group of copies."""
    counted = rows.withColumn("_tf_left", n).filter("_tf_left > 0")
    few = counted.filter(F.col("_tf_left") <= chunk)
    many = counted.filter(F.col("_tf_left") > chunk).withColumn("_tf_left", F.explode(chunks(F.col("_tf_left"), chunk)))
    dealt = few.unionByName(many.repartition(many.sparkSession.sparkContext.defaultParallelism))
    return dealt.withColumn("_tf_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_tf_left")))).drop("_tf_i", "_tf_left")


def split_duplicates(df: DataFrame, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """(one copy of every distinct row, every further copy). Nulls compare equal."""
    counted = counted_rows(df)
    return counted.drop(_N), emit_copies(counted, F.col(_N) - 1, chunk).drop(_N)


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct (partial aggregation collapses copies map-side)."""
    return df.dropDuplicates()


def required_tag(df: DataFrame, required) -> Column:
    """Reason of the first required column (in rule order) that is null, else null."""
    present = [c for c in required if c in df.columns]
    if not present:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(S.REQUIRED_TAG.format(col=c))) for c in present])


def split_required(df: DataFrame, required) -> tuple[DataFrame, DataFrame]:
    tagged = df.withColumn(PROBLEM, R.fence(required_tag(df, required)))
    return (tagged.filter(F.col(PROBLEM).isNull()).drop(PROBLEM),
            tagged.filter(F.col(PROBLEM).isNotNull()))


def coerce_dates(df: DataFrame, date_columns, formats=None) -> DataFrame:
    fmts = formats or R.DEFAULT_TIMESTAMP_FORMATS
    return df.select(*[R.coerce_timestamp(F.col(c), fmts).alias(c) if c in date_columns else F.col(c)
                       for c in df.columns])


def date_problem_tags(df: DataFrame, date_columns, formats=None) -> Column:
    """Array with one reason per date column that holds a value but does not parse."""
    fmts = formats or R.DEFAULT_TIMESTAMP_FORMATS
    present = [c for c in date_columns if c in df.columns]
    tags = [F.when(R.is_invalid(F.col(c), R.coerce_timestamp(F.col(c), fmts)),
                   F.lit(S.BAD_DATE_TAG.format(col=c))) for c in present]
    if not tags:
        return F.array().cast("array<string>")
    return F.filter(F.array(*tags), lambda t: t.isNotNull())


def date_problems(df: DataFrame, date_columns, formats=None) -> DataFrame:
    """Rows with an unparseable date, once per bad column (raw text kept)."""
    return (df.withColumn("_tf_tags", date_problem_tags(df, date_columns, formats))
              .select(*df.columns, F.explode("_tf_tags").alias(PROBLEM)))


@dataclass
class CleanResult:
    clean: DataFrame
    problems: DataFrame

    def __iter__(self):
        return iter((self.clean, self.problems))


def tag_table(df: DataFrame, spec: S.TableSpec, blank_as_null: bool = False) -> DataFrame:
    """Every distinct stripped row with its number of copies and its reasons, before dates are coerced.

    Both outputs of the cleaning come from this one table: write it once and read it for
    :func:`clean_of` and :func:`problems_of` when both are wanted.
    """
    base = strip_columns(df)
    if blank_as_null:  # by default a blank-only text stays "" and passes the required check
        base = base.select(*[F.nullif(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType)
                             else F.col(f.name) for f in base.schema.fields])
    counted = counted_rows(base)
    dates = [c for c in spec.date_columns if c in base.columns]
    return (counted.withColumn(_TAG, R.fence(required_tag(counted, spec.required)))
            .withColumn(_DATES, F.when(F.col(_TAG).isNull(), date_problem_tags(counted, dates, spec.date_formats))))


def clean_of(tagged: DataFrame, spec: S.TableSpec) -> DataFrame:
    """Rows that no required column rules out; a date that does not parse is null."""
    cols = [c for c in tagged.columns if c not in (_N, _TAG, _DATES)]
    passed = tagged.filter(F.col(_TAG).isNull()).select(*cols)
    return coerce_dates(passed, [c for c in spec.date_columns if c in cols], spec.date_formats)


def problems_of(tagged: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Further copies, rows without a required value, and rows once for each bad date; raw text kept."""
    cols = [c for c in tagged.columns if c not in (_N, _TAG, _DATES)]
    copies = emit_copies(tagged.select(*cols, _N), F.col(_N) - 1, chunk).drop(_N).withColumn(PROBLEM, F.lit(S.DUPLICATE_TAG))
    missing = tagged.filter(F.col(_TAG).isNotNull()).select(*cols, F.col(_TAG).alias(PROBLEM))
    bad_dates = tagged.select(*cols, F.explode(_DATES).alias(PROBLEM))
    return copies.unionByName(missing).unionByName(bad_dates)


def clean_table(df: DataFrame, spec: S.TableSpec, blank_as_null: bool = False) -> CleanResult:
    """Strip text -> duplicates out -> required nulls out -> dates coerced.

    ``clean`` keeps rows with an unparseable date (the date becomes null); those rows
    are also reported in ``problems``, once per bad date column. ``problems`` holds the
    stripped input text and the reason in ``_problema``.
    """
    tagged = tag_table(df, spec, blank_as_null)
    return CleanResult(clean_of(tagged, spec), problems_of(tagged))


def problem_counts(problems: DataFrame) -> DataFrame:
    return problems.groupBy(PROBLEM).agg(F.count(F.lit(1)).alias("filas"))


def count_problems(tagged: DataFrame, spec: S.TableSpec) -> DataFrame:
    """:func:`problem_counts` of a tagged table, from the numbers of copies: no copy is emitted."""
    reasons = F.concat(
        F.array(F.struct(F.lit(S.DUPLICATE_TAG).alias(PROBLEM), (F.col(_N) - 1).alias("n"))),
        F.array(F.struct(F.col(_TAG).alias(PROBLEM), F.lit(1).cast("bigint").alias("n"))),
        F.transform(F.coalesce(_DATES, F.array().cast("array<string>")),
                    lambda t: F.struct(t.alias(PROBLEM), F.lit(1).cast("bigint").alias("n"))))
    return (tagged.select(F.explode(reasons).alias("r")).select("r.*").filter(F.col(PROBLEM).isNotNull() & (F.col("n") > 0))
            .groupBy(PROBLEM).agg(F.sum("n").alias("filas")))


# --- target constraints ------------------------------------------------------

OUT_OF_RANGE_TAG = "{col}: fuera de rango para {target}"
TOO_LONG_TAG = "{col}: texto mayor a {n}"


def target_tag(df: DataFrame, spec: S.TableSpec) -> Column:
    """Reason of the first column whose value the target column cannot hold."""
    arms = []
    for rule in spec.columns:
        if rule.name not in df.columns:
            continue
        c = F.col(rule.name)
        t = S.spark_type(rule.target)
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)):
            arms.append(F.when(c.isNotNull() & c.try_cast(rule.target).isNull(),
                               F.lit(OUT_OF_RANGE_TAG.format(col=rule.name, target=rule.target))))
        if rule.max_length is not None:
            arms.append(F.when(F.length(c) > rule.max_length,
                               F.lit(TOO_LONG_TAG.format(col=rule.name, n=rule.max_length))))
    return F.coalesce(*arms) if arms else F.lit(None).cast("string")


def conform_to_target(df: DataFrame, spec: S.TableSpec, keep=()) -> tuple[DataFrame, DataFrame]:
    """(rows cast to the target types, rows the target would refuse with the reason)."""
    tagged = df.withColumn(PROBLEM, R.fence(target_tag(df, spec)))
    ok = tagged.filter(F.col(PROBLEM).isNull()).select(
        *[F.col(k) for k in keep],
        *[F.col(r.name).cast(r.target).alias(r.name) for r in spec.columns if r.name in df.columns])
    bad = tagged.filter(F.col(PROBLEM).isNotNull())
    return ok, bad

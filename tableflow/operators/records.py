"""Row-level record shaping: header normalisation, projection onto a spec, rule dispatch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow import spec as S
from tableflow.functions import rules as R
from tableflow.functions import sql as SQ


def normalise_header(name: str, drop_quotes: bool = True) -> str:
    """Header cell -> column name: strip, lower case and (inspector style) no quotes."""
    out = name.replace('"', "") if drop_quotes else name
    return out.strip().lower()


def normalise_headers(df: DataFrame, drop_quotes: bool = True) -> DataFrame:
    return df.toDF(*[normalise_header(c, drop_quotes) for c in df.columns])


def drop_columns(df: DataFrame, ignored) -> DataFrame:
    return df.drop(*[c for c in ignored if c in df.columns])


def _source(df: DataFrame, name: str) -> Column:
    """The input column, or a null text when the record does not carry it."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


_STRIPPED_KINDS = (S.DATE, S.DATE_TEXT, S.CODE, S.INT)
# type each rule produces (an absent column becomes a null of that type)
_RULE_OUTPUT_TYPE = {S.DATE: "date", S.DATE_TEXT: "string", S.CODE: "decimal(38,0)", S.INT: "decimal(38,0)",
                     S.TEXT: "string", S.RAW: "string"}


def rule_expr(rule: S.ColumnRule, c: Column, stripped: bool = False) -> Column:
    """The cleaning expression for one column of a spec (``stripped``: input already stripped)."""
    if rule.kind == S.DATE:
        return R.clean_date(c, stripped)
    if rule.kind == S.DATE_TEXT:
        return R.clean_date_text(c, stripped)
    if rule.kind == S.CODE:
        return R.clean_code(c, stripped=stripped)
    if rule.kind == S.INT:
        return R.clean_int(c, stripped=stripped)
    if rule.kind == S.TEXT:
        return R.clean_text(c)
    return c


def project_spec(df: DataFrame, spec: S.TableSpec, keep=()) -> DataFrame:
    """Project onto the spec's ordered column list; absent columns become null."""
    return df.select(*[F.col(k) for k in keep], *[_source(df, c).alias(c) for c in spec.column_names])


def _fields(name: str) -> list[str]:
    return [f"_tf_{name}_{i}" for i in range(4)]


def _parts(name: str) -> list[str]:
    return [f"_tf_{name}_{p}" for p in ("y", "m", "d")]


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _with_date_stages(df: DataFrame, texts: dict) -> DataFrame:
    """Add the date fields, then the date parts, each in its own projection.

    ``texts`` maps a name to a stripped text column already in ``df``. Nesting these
    expressions in one projection makes the generated code re-evaluate them many
    times per row; one projection per stage keeps each value computed once.
    """
    with_fields = df.select("*", *[F.expr(e).alias(n) for name, col in texts.items()
                                   for e, n in zip(SQ.date_fields_sql(_q(col)), _fields(name))])
    return with_fields.select("*", *[F.expr(e).alias(n) for name in texts
                                     for e, n in zip(SQ.date_parts_sql([_q(x) for x in _fields(name)]), _parts(name))])


def _date_value(name: str, text_col: str) -> str:
    return SQ.date_final_sql(_q(text_col), [_q(x) for x in _fields(name)], [_q(x) for x in _parts(name)])


def _rule_sql(kind: str, col: str) -> str:
    """SQL text of a non-date rule on the staged column (stripped for int and code)."""
    if kind == S.CODE:
        return SQ.code_sql(col)
    if kind == S.INT:
        return SQ.int_sql(col)
    if kind == S.TEXT:
        return SQ.text_sql(col)
    return col


def clean_record(df: DataFrame, spec: S.TableSpec, keep=()) -> DataFrame:
    """Apply each column's rule (date / integer / code / text).

    Narrow projections in one stage: strip the fields whose rules look at them several
    times; split date texts into numbers and a layout; pick year, month and day; apply
    the rules. Each intermediate value sits in its own column, so it is computed once
    per row (the optimizer does not inline a costly expression used many times), and
    the generated code of each projection stays small. Expressions are built from the
    rules' SQL text, one call per column, so even a wide spec plans in milliseconds.
    """
    present = [r for r in spec.columns if r.name in df.columns]
    dates = [r.name for r in present if r.kind in (S.DATE, S.DATE_TEXT)]
    keep_cols = [F.col(k) for k in keep]
    stage1 = df.select(*keep_cols, *[
        (F.expr(SQ.strip_sql(_q(r.name))) if r.kind in _STRIPPED_KINDS else F.col(_q(r.name))).alias(f"_tf_{r.name}")
        for r in present])
    staged = _with_date_stages(stage1, {c: f"_tf_{c}" for c in dates})
    out = []
    for r in spec.columns:
        if r.name not in df.columns:
            out.append(F.lit(None).cast(_RULE_OUTPUT_TYPE.get(r.kind, "string")).alias(r.name))
            continue
        staged_col = _q(f"_tf_{r.name}")
        if r.kind in (S.DATE, S.DATE_TEXT):
            d = _date_value(r.name, f"_tf_{r.name}")
            out.append(F.expr(d if r.kind == S.DATE else f"date_format({d}, 'yyyy-MM-dd')").alias(r.name))
        else:
            out.append(F.expr(_rule_sql(r.kind, staged_col)).alias(r.name))
    return staged.select(*keep_cols, *out)


def clean_dates(df: DataFrame, columns: dict, as_text: bool = False) -> DataFrame:
    """Add cleaned dates: ``columns`` maps output name -> input text column (staged like clean_record)."""
    base = df.select("*", *[F.expr(SQ.strip_sql(_q(src))).alias(f"_tf_{out}") for out, src in columns.items()])
    staged = _with_date_stages(base, {out: f"_tf_{out}" for out in columns})
    adds = []
    for out in columns:
        d = _date_value(out, f"_tf_{out}")
        adds.append(F.expr(f"date_format({d}, 'yyyy-MM-dd')" if as_text else d).alias(out))
    return staged.select(*[c for c in df.columns if c not in columns], *adds)


def clean_record_by_name(df: DataFrame, columns, keep=(),
                         blank_null_ids=S.BULK_BLANK_NULL_IDS) -> DataFrame:
    """Rule chosen from the column name: '*fecha*' date (ISO text), '*coddane*' text '0' -> null,
    everything else collapsed lower-case text (integers stay text)."""
    dated = [n for n in columns if "fecha" in n and n in df.columns]
    base = df
    if dated:  # the staged date rule replaces each date text by its ISO text
        base = clean_dates(base, {n: n for n in dated}, as_text=True)
    out = []
    for name in columns:
        c = _source(base, name)
        if "fecha" in name:
            e = c
        elif "coddane" in name:
            e = F.when(R.strip(c) == "0", F.lit(None).cast("string")).otherwise(R.clean_text(c))
        elif name in blank_null_ids:
            e = F.when(R.strip(c) == "", F.lit(None).cast("string")).otherwise(R.clean_text(c))
        else:
            e = R.clean_text(c)
        out.append(e.alias(name))
    return base.select(*[F.col(k) for k in keep], *out)


def strip_columns(df: DataFrame) -> DataFrame:
    """Strip every text column; other types and inner blanks/case are left alone."""
    return df.select(*[R.strip(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
                       for f in df.schema.fields])


def null_tokens(df: DataFrame, columns=None, keep=()) -> DataFrame:
    cols = columns or [c for c in df.columns if c not in keep]
    return df.select(*[F.col(k) for k in keep], *[R.null_token(c).alias(c) for c in cols])


def copy_text_lines(df: DataFrame, columns, keep=()) -> DataFrame:
    """Each row as one line of the bulk text format (tab separated, \\N for null)."""
    fields = [R.copy_escape(F.col(c)) for c in columns]
    return df.select(*[F.col(k) for k in keep], F.concat_ws(R.COPY_SEPARATOR, *fields).alias("line"))



def write_copy_text(df: DataFrame, columns, path: str, mode: str = "overwrite") -> None:
    """Write rows in the bulk text format (one line per row), ready for a database bulk load."""
    copy_text_lines(df, columns).write.mode(mode).text(path)

"""Driver contract: the flagship runs on sf0.001 and every query has an oracle or a reason not to."""

import __spark_entry__ as E

LLM = ("op", "pipeline")   # the optional subpackage's queries have tests of their own


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0


def test_every_query_has_oracle():
    qs, sql = E.queries(), E.oracle_sql()
    assert not [q for q in set(qs) - set(sql) if not q.startswith(LLM)]
    assert set(sql) <= set(qs)


def test_some_queries_on_small_data(spark, sf):
    qs = E.queries()
    for name in ("clean_record", "profile_table", "insert_ignore", "detect_keys", "manifest"):
        assert qs[name](spark, sf).count() > 0

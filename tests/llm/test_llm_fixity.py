import hashlib

from tableflow.llm import fixity as X


def store(spark, rows, clash=True):
    df = spark.createDataFrame(rows, "archive string, place bigint, record_id string, record string")
    return X.lay_out(df)


def records(n=300, archives=3):
    return [(f"a{i % archives}", i, f"r{i}", f"record {i} " + "x" * (i % 97)) for i in range(n)]


def test_layout_and_digests(spark):
    rows = {(r.archive, r.offset): r for r in store(spark, records()).collect()}
    for a in range(3):
        at = 0
        for archive, _, rid, text in [r for r in records() if r[0] == f"a{a}"]:
            r = rows[(archive, at)]
            assert (r.record_id, r.length, r.digest) == (rid, len(text), hashlib.sha256(text.encode()).hexdigest())
            at += len(text)


def test_differences_are_located(spark):
    primary = store(spark, records())
    rows = primary.collect()
    bad = {rows[5][:2], rows[17][:2]}
    lost = rows[100][:2]
    other = [(r.archive, r.offset, r.length, r.record_id, "0" * 64 if r[:2] in bad else r.digest) for r in rows if r[:2] != lost]
    other.append(("a9", 7, 3, "stray", "f" * 64))
    replica = spark.createDataFrame(other, primary.schema)
    for range_bytes, fanout in ((64, 2), (1 << 15, 8), (1 << 40, 4)):
        got = {(r.archive, r.offset): (r.status, r.record_id) for r in X.audit(primary, replica, range_bytes, fanout).collect()}
        assert {k for k, v in got.items() if v[0] == "altered"} == bad
        assert got[lost][0] == "missing" and got[("a9", 7)] == ("extra", "stray") and len(got) == 4


def test_equal_and_empty_stores(spark):
    primary = store(spark, records(50))
    assert X.audit(primary, primary).count() == 0
    assert X.audit(primary.limit(0), primary.limit(0)).count() == 0
    assert {r.status for r in X.audit(primary, primary.limit(0)).collect()} == {"missing"}
    assert X.audit(primary.limit(0), primary).filter("status = 'extra'").count() == 50


def test_nulls_repeated_and_empty_records(spark):
    rows = [(None, None, None, None), ("a", 1, "r", ""), ("a", 1, "r", "same"), ("a", 1, "r", "same"), ("a", 2, None, "é" * 1000)]
    primary = store(spark, rows)
    got = sorted((r.archive, r.offset, r.length) for r in primary.collect())
    assert got[0] == ("", 0, 0) and len(got) == 5 and got[-1][2] == 2000
    assert X.audit(primary, primary).count() == 0
    more = primary.withColumn("node", primary.archive).withColumn("side", primary.archive)  # clashing names
    assert X.audit(more, primary).count() == 0


def test_levels_have_bounded_nodes(spark):
    primary = store(spark, records())
    from pyspark.sql import functions as F

    levels = X.merkle_levels(primary.withColumn("side", F.lit("primary")), 256, 4)
    assert levels[-1].count() == 1
    for low, high in zip(levels, levels[1:]):
        assert {r.parent for r in low.select("parent").distinct().collect()} == {r.node for r in high.collect()}

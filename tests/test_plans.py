"""Plan shape: no cross or nested-loop joins, pushed-down windows, partial aggregation before shuffles."""

from pyspark.sql import functions as F

from tableflow.plans import derived as DV
from tableflow.plans.registry import QUERIES

# queries whose callables only build a plan (the others write files or run streams when called)
LAZY = ["clean_date", "clean_int", "clean_code", "clean_text", "clean_record", "clean_record_by_name",
        "project_spec", "drop_columns", "header_normalise", "copy_text_lines", "null_tokens", "value_kind",
        "strip_columns", "coerce_date", "dedupe_rows", "duplicate_rejects", "required_clean", "required_rejects",
        "date_problems", "clean_table", "clean_table_problems", "problem_counts", "profile_table",
        "quality_summary", "inspect_columns", "critical_columns", "head_tail", "sample_first_n", "row_cap",
        "extract_window", "count_window", "extract_catalogue_table", "page_slice", "insert_ignore",
        "load_default", "target_accepts", "target_rejects", "ledger_latest_ok", "pending_extractions",
        "detect_keys", "best_run", "delivery_name", "content_digest", "row_cap_report", "union_pages"]


def _plan(spark, sf, name):
    return QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


def test_no_cross_or_nested_loop_joins(spark, sf):
    for name in LAZY:
        plan = _plan(spark, sf, name)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_window_pushed_into_scan(spark, sf):
    plan = _plan(spark, sf, "extract_window")
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-10T00:00), LessThan(ts,2024-01-16T00:00)]" in plan


def test_partial_aggregation_before_shuffle(spark, sf):
    for name, marker in (("duplicate_rejects", "partial_count"), ("profile_table", "partial_count"),
                         ("ledger_latest_ok", "partial_max"), ("detect_keys", "partial_min"),
                         ("insert_ignore", "partial_min")):
        assert marker in _plan(spark, sf, name), name


def test_no_job_starts_while_a_query_is_built(spark, sf):
    tracker = spark.sparkContext.statusTracker()
    DV.customer_text(spark, sf).count()  # file listings and schemas are cached by now
    for name in LAZY:
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        QUERIES[name](spark, sf)
        jobs = tracker.getJobIdsForGroup(f"build-{name}")
        # reading a Parquet schema may take a job; nothing else may
        assert len(jobs) <= 3 * 2, name
    spark.sparkContext.setJobGroup("tests", "tests")


def test_one_row_exchange_for_a_clean_table(spark, sf):
    from tableflow import spec as S
    from tableflow.operators import quarantine as Q
    df = spark.range(100).repartition(3).selectExpr("id AS PACIENTE_ID", "'x' AS NOMBRE", "'2020-01-01' AS FECHA_NACIMIENTO", "'2020-01-01' AS CREATED_AT")
    plan = Q.clean_table(df, S.PERIOD_SPECS["PACIENTES"]).clean._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_one_exchange_for_the_incoming_side(spark):
    from tableflow.operators import ingest as ING
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        inc, target = spark.range(100).selectExpr("id AS a", "id AS b", "id AS o"), spark.range(10).selectExpr("id AS a", "id AS b")
        plan = ING.insert_ignore(target, inc, ["a", "b"], ["o"])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2   # one for each side
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_chunks_of_a_huge_group(spark):
    from tableflow.operators import quarantine as Q
    r = spark.createDataFrame([(2**31 * 4 + 5,), (1,), (7,), (8,)], "n bigint").select("n", Q.chunks(F.col("n"), 1 << 20).alias("c"))
    for n, c in ((x["n"], x["c"]) for x in r.collect()):
        assert sum(c) == n and max(c) <= 1 << 20 and len(c) == -(-n // (1 << 20))

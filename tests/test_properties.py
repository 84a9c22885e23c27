"""Properties of the integer and text rules on generated texts."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableflow.functions import rules as R

_TEXTS = st.lists(st.text(alphabet=st.sampled_from(list("0123456789+-_ .eA\t\u00a0\u001c")), max_size=8), min_size=1, max_size=60)


@settings(max_examples=5, deadline=None)
@given(_TEXTS)
def test_text_rule_is_stable(spark, values):
    """Cleaning twice equals cleaning once; a clean text has no outer or double blank and is never empty."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    once = df.select("i", R.clean_text("v").alias("t"))
    for r in once.withColumn("again", R.clean_text("t")).collect():
        assert r["again"] == r["t"] and r["t"] != ""
        assert r["t"] is None or (r["t"] == r["t"].lower().strip(" ") and "  " not in r["t"] and "\t" not in r["t"])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-10**30, 10**30), min_size=1, max_size=40))
def test_integers_come_back_from_their_texts(spark, numbers):
    rows = [(i, pad + sign + str(n) + pad) for i, n in enumerate(numbers) for pad, sign in [("", ""), (" \t", "")]]
    df = spark.createDataFrame(rows, "i int, v string").select("i", R.clean_int("v").alias("n"))
    for r in df.withColumn("text", F.col("n").cast("string")).collect():
        assert int(r["n"]) == numbers[r["i"]]

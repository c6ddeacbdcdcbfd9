"""Randomised properties (hypothesis, few examples: each one runs Spark jobs)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerflow.operators.patterns import distributed_row_number
from ledgerflow.streaming.sync import cursor_page_tie_safe

SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(cursors=st.lists(st.integers(min_value=1, max_value=12), min_size=1, max_size=40),
       size=st.integers(min_value=1, max_value=9))
def test_tie_safe_pages_cover_every_row_once(spark, cursors, size):
    df = spark.createDataFrame(list(enumerate(cursors)), "id long, cbmarq long")
    seen, cursor = [], 0
    for _ in range(len(cursors) + 1):
        page = cursor_page_tie_safe(df, cursor, size=size).collect()
        if not page:
            break
        remaining = sum(1 for c in cursors if c > cursor)
        assert min(size, remaining) <= len(page) <= remaining      # never short, never past the end
        seen += [r["id"] for r in page]
        cursor = max(r["cbmarq"] for r in page)
    assert sorted(seen) == list(range(len(cursors)))


@SETTINGS
@given(values=st.lists(st.integers(min_value=-3, max_value=3), min_size=1, max_size=60),
       parts=st.integers(min_value=1, max_value=6))
def test_distributed_row_number_with_ties(spark, values, parts):
    df = spark.createDataFrame(list(enumerate(values)), "id long, v long")
    order = [F.col("v").desc(), F.col("id").asc()]
    got = {r["id"]: r["rn"] for r in distributed_row_number(df, order, "rn", num_partitions=parts).collect()}
    want = {r["id"]: r["rn"] for r in df.select("id", F.row_number().over(Window.orderBy(*order)).alias("rn"))
            .collect()}
    assert got == want

"""The scale patterns give the same result as the naive windows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerflow.operators.patterns import (distributed_row_number, forward_range_sums, scalar, scalars, value_rank,
                                           without_null_skew)


def _frame(spark, n=2000, seed=7):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["a", "b", "c", None]), rnd.randint(0, 60), rnd.randint(-50, 50)) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, k string, d int, v long")
    return df.withColumn("day", F.date_add(F.lit("2001-01-01").cast("date"), F.col("d")))


def test_distributed_row_number_matches_window(spark):
    df = _frame(spark)
    order = [F.col("v").desc(), F.col("id").asc()]
    got = {r["id"]: r["rn"] for r in distributed_row_number(df, order, "rn", num_partitions=5).collect()}
    want = {r["id"]: r["rn"] for r in df.select("id", F.row_number().over(Window.orderBy(*order)).alias("rn"))
            .collect()}
    assert got == want


def test_value_rank_matches_window(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, f"C{i}", f"S{i % 40}x{i}"]), rnd.choice([0, 0, 0, rnd.randint(-99, 99), rnd.randint(0, 10 ** 9)]) / 100)
            for i in range(1500)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, k string, v double") \
        .withColumn("k", F.when(F.col("k").isNotNull(), F.concat("k", F.lit("-"), "id"))).dropDuplicates(["k"])
    got = {r["id"]: r["rn"] for r in value_rank(df, "v", "k", "rn").collect()}
    w = Window.orderBy(F.col("v").desc(), F.col("k").asc_nulls_last())
    assert got == {r["id"]: r["rn"] for r in df.select("id", F.row_number().over(w).alias("rn")).collect()}


def test_join_around_null_keys(spark):
    df = spark.createDataFrame([(i, None if i % 3 else f"k{i % 7}") for i in range(200)], "id long, k string")
    other = spark.createDataFrame([(f"k{i}", i) for i in range(5)], "k string, v int")
    got = {tuple(r) for r in without_null_skew(df, other, "k", "id").select("id", "k", "v").collect()}
    assert got == {tuple(r) for r in df.join(other, "k", "left").select("id", "k", "v").collect()}


def test_forward_range_sum_matches_correlated_definition(spark):
    df = _frame(spark, 400).filter(F.col("k").isNotNull())
    daily = df.groupBy("k", "day").agg(F.sum("v").alias("__day_sum"))
    got = {(r["k"], r["day"]): r["f30"] for r in forward_range_sums(daily, ["k"], "day", {"f30": 30}).collect()}
    rows = df.collect()
    for (k, day), value in got.items():
        want = sum(r["v"] for r in rows if r["k"] == k and 0 <= (r["day"] - day).days <= 30)
        assert value == want


def test_scalar_subqueries(spark):
    df = _frame(spark, 100)
    s = scalars(df, n=F.count(F.lit(1)), tot=F.sum("v"))
    r = df.limit(1).select(s["n"].alias("n"), s["tot"].alias("tot"), scalar(df, F.max("id")).alias("m")).first()
    assert r["n"] == 100 and r["m"] == 99 and r["tot"] == df.agg(F.sum("v")).first()[0]

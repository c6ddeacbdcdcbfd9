"""Physical-plan checks over every registered query:
no nested-loop / cartesian joins, and no window without a partition key
except over frames with a fixed bound (one row per partition in the
distributed row number, the 10 rows of the top-10); how often the ledger is
read, and that skewed keys reach no single task."""

import re

import pytest

SF_DIR = "/root/testdata/sf0.001"
# offsets: one row per range partition, per range of cursor values, per step of a rank
BOUNDED_UNPARTITIONED = {"__pid", "__cursor_range", "__step"}


def _keys():
    from ledgerflow.registry import queries
    return sorted(k for k in queries() if not k.startswith("stream"))


def _unpartitioned_windows(plan: str) -> list[str]:
    out = []
    for spec in re.findall(r"windowspecdefinition\(([^,]*)", plan):
        first = spec.strip()
        if " ASC" in first or " DESC" in first or first.startswith("specifiedwindowframe"):
            out.append(first)
    return out


@pytest.mark.parametrize("key", _keys())
def test_plan_shape(spark, key):
    from ledgerflow.registry import queries
    plan = queries()[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    for w in _unpartitioned_windows(plan):
        name = re.sub(r"#\d+L?", "", w.split(" ")[0])
        assert name in BOUNDED_UNPARTITIONED or key == "payables_top10", (key, w)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    from ledgerflow.sources.adapter import ErpTables
    return ErpTables(spark, SF_DIR).materialize(str(tmp_path_factory.mktemp("erp")))


def _final_plan(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name,function,reads", [
    ("ledger", "audit_anomalies", 2),      # rows; groups (duplicates and moments)
    ("ledger", "finance_daily", 2), ("parties", "client_receivables", 2), ("parties", "supplier_payables", 2),
])
def test_ledger_reads(stored, name, function, reads):
    import importlib
    df = getattr(importlib.import_module(f"ledgerflow.plans.{name}"), function)(stored, "2001-07-15")
    assert len(re.findall(r"FileScan parquet [^\n]*/f_ecriturec", _final_plan(df))) <= reads


def test_building_a_view_starts_no_job_and_keeps_nothing(spark, stored):
    from ledgerflow.plans.views import VIEW_FUNCTIONS, view
    for name in VIEW_FUNCTIONS:
        view(stored, "2001-07-15", name)
    sc = spark.sparkContext
    before = set(sc._jsc.getPersistentRDDs())
    sc.setJobGroup("build", "views")
    for name in VIEW_FUNCTIONS:
        view(stored, "2001-07-15", name)
    assert list(sc.statusTracker().getJobIdsForGroup("build")) == []
    assert set(sc._jsc.getPersistentRDDs()) <= before  # the session is shared with other tests


def test_null_parties_are_dealt_out(spark):
    """A third of the rows without a party, joined by sort-merge: no task holds them all."""
    from pyspark.sql import functions as F

    from ledgerflow.operators.patterns import without_null_skew
    df = spark.range(30_000).select(F.col("id").alias("ec_no"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("C"), F.col("id"))).alias("ct_num"))
    other = spark.range(3000).select(F.concat(F.lit("C"), F.col("id")).alias("ct_num"), F.col("id").alias("v"))
    joined = without_null_skew(df, other.hint("merge"), "ct_num", "ec_no").withColumn("task", F.spark_partition_id())
    per_task = {r["task"]: r["n"] for r in joined.filter("ct_num is null").groupBy("task").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sum(per_task.values()) == 10_000 and (len(per_task) == 1 or max(per_task.values()) < 5000)


def test_hot_account_day_is_summed_in_slices(spark):
    """One account-day with a third of the ledger: running sums stay right, partitions hold slices."""
    from minitables import MiniTables, ledger_row

    from ledgerflow.plans import ledger
    rows = [ledger_row(i << 40, "2001-03-03" if i % 3 == 0 else f"2001-03-{10 + i % 9}", "512000", None, "1.00", jo="JB") for i in range(1, 300)]
    out = {r["ec_no"]: r["tft"] for r in ledger.treasury_flows(MiniTables(spark, rows), "2001-07-15").collect()}
    order = sorted(rows, key=lambda r: (r[2], r[0]))
    assert [out[r[0]] for r in order] == [float(i + 1) for i in range(len(order))]


def test_hot_account_day_with_ordinary_numbers(spark, monkeypatch):
    """Small sequential entry numbers: slices hold about as many entries as asked for."""
    from minitables import MiniTables, ledger_row

    from ledgerflow.plans import ledger
    monkeypatch.setattr(ledger, "SLICE_ENTRIES", 25)
    rows = [ledger_row(1000 + i, "2001-03-03" if i % 3 == 0 else f"2001-03-{10 + i % 9}", "512000", None, "1.00", jo="JB") for i in range(1, 300)]
    t = MiniTables(spark, rows)
    out = {r["ec_no"]: r["tft"] for r in ledger.treasury_flows(t, "2001-07-15").collect()}
    order = sorted(rows, key=lambda r: (r[2], r[0]))
    assert [out[r[0]] for r in order] == [float(i + 1) for i in range(len(order))]
    slices = ledger._treasury_rows(t)[0].groupBy("__slice").count().collect()
    assert len(slices) == 12 and max(r["count"] for r in slices) <= 26


def test_one_entry_is_one_slice(spark):
    from minitables import MiniTables, ledger_row

    from ledgerflow.plans import ledger
    for rows in ([], [ledger_row(7, "2001-03-03", "512000", None, "2.00", jo="JB")]):
        assert [r["tft"] for r in ledger.treasury_flows(MiniTables(spark, rows), "2001-07-15").collect()] == [2.0] * len(rows)


def test_moments_take_groups_of_any_size(spark):
    """A group of 10^9 equal entries (entries without a piece and a party make such ones)."""
    from decimal import Decimal

    from ledgerflow.plans import ledger
    groups = spark.createDataFrame([(None, None, Decimal("10.00"), 10 ** 9), ("P", "C", Decimal("-10.00"), 10 ** 9)],
                                   "ec_piece string, ct_num string, ec_montant decimal(13,2), nb_occurrences long")
    stats, mean, sd = ledger._moments(groups)
    assert tuple(stats.select(mean, sd).first()) == (10.0, 0.0)


def test_parties_that_begin_alike_are_not_one_cell(spark):
    from pyspark.sql import functions as F

    from ledgerflow.operators.patterns import value_rank
    codes = [f"CLIENT{i:09d}" for i in range(4000)]
    df = spark.createDataFrame([(c, 0.0 if i % 3 else float(i)) for i, c in enumerate(codes)] + [(None, 0.0)], "p string, v double")
    ranked = value_rank(df, "v", "p", "rank")
    got = {r["p"]: r["rank"] for r in ranked.collect()}
    want = sorted(((0.0 if i % 3 else float(i), c) for i, c in enumerate(codes)), key=lambda x: (-x[0], x[1]))
    assert [got[c] for _, c in want] == list(range(1, 4001)) and got[None] == 4001
    cells = df.where("v = 0").groupBy(F.substring("p", 1, 12)).count()
    assert cells.agg(F.max("count")).first()[0] <= 1000

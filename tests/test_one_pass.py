"""Queries whose readers share one pass over the ledger, and steps that do only what is asked of them."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from ledgerflow.operators.patterns import whole_rows
from ledgerflow.plans import ledger, parties
from ledgerflow.plans.common import ledger_of_class
from ledgerflow.sources.adapter import ErpTables
from ledgerflow.streaming.sessions import _merge
from minitables import MiniTables, ledger_row, party
from pyspark.sql import functions as F

AS_OF = "2001-07-15"


@pytest.fixture
def tables(spark, tmp_path):
    """Order lines of a few orders, some lines twice; joins are sort-merge joins."""
    d, t = str(tmp_path), dt.datetime
    spark.createDataFrame([(i, f"R{i}") for i in range(2)], "r_regionkey int, r_name string").write.parquet(f"{d}/region.parquet")
    spark.createDataFrame([(i, f"N{i}", i % 2) for i in range(3)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{d}/nation.parquet")
    spark.createDataFrame([(i, f"C{i}", i % 3, 1.0, "M") for i in range(4)],
                          "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{d}/customer.parquet")
    spark.createDataFrame([(i, f"S{i}", i % 3, 1.0) for i in range(3)],
                          "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{d}/supplier.parquet")
    spark.createDataFrame([(i, i % 4, "O", 9.0, t(2001, 1 + i % 6, 5)) for i in range(20)] + [(3, 1, "O", 9.0, t(2001, 2, 2))],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"
                          ).write.parquet(f"{d}/orders.parquet")
    lines = [(i % 20, 211 * (i % 3), i % 3, 1 + i % 4, 2.0, 10.0 * (i % 7), "RAN"[i % 3], "OF"[i % 2], t(2001, 1 + i % 6, 1 + i % 28)) for i in range(60)]
    spark.createDataFrame(lines + lines[:9], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{d}/lineitem.parquet")
    limits = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield ErpTables(spark, d)
    for k, v in limits.items():
        spark.conf.set(k, v)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _ledger_passes(df) -> int:
    """Exchanges of order lines in the plan that no other one stands for."""
    return len(re.findall(r"Scan parquet.*l_orderkey", _plan(df)))


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("view", [parties.client_receivables, parties.supplier_payables, parties.supplier_payables_yoy])
def test_a_party_view_reads_the_ledger_once(tables, view):
    assert _ledger_passes(view(tables, AS_OF)) == 1


def test_whole_rows_are_the_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, 2.5, None)], "a long, b double, `c d` string")
    assert _rows(whole_rows(df)) == _rows(df) and whole_rows(df).columns == df.columns


def test_debt_of_a_month_falls_in_its_bands(spark):
    """Every day of five months, against sums that compare each day's age; a month without amounts stays NULL."""
    days = [dt.date(2001, 2, 20) + dt.timedelta(days=i) for i in range(160)]
    entries = [ledger_row(i, str(d), "401000", "S1", f"{i % 9 + 1}.25", sens=int(i % 5 > 0)) for i, d in enumerate(days)]
    no_amount = [e[:7] + (None,) + e[8:] for e in (ledger_row(900, "2000-01-05", "401000", "S1", "1.00"),)]
    t = MiniTables(spark, entries + no_amount, [party("S1", "one", 1)])
    age, debt = F.datediff(F.lit(AS_OF).cast("date"), "ec_date"), F.when(F.col("ec_sens") == 1, F.col("ec_montant")).otherwise(-F.col("ec_montant"))
    sums = [F.sum(F.when((age > lo) if hi is None else age.between(lo, hi), debt).otherwise(0)).cast("double").alias(f"balance_{n}")
            for n, lo, hi in parties.BANDS]
    want = t.f_ecriturec.groupBy(F.year("ec_date").alias("annee"), F.month("ec_date").alias("mois")).agg(*sums)
    got = parties.supplier_payables_yoy(t, AS_OF).select(*want.columns)
    assert _rows(got) == _rows(want)


def test_equal_entries_are_counted_where_their_order_lies(tables):
    found = ledger.duplicate_entries(tables, AS_OF)
    assert "Exchange hashpartitioning(__piece_place" not in _plan(found) and "Exchange hashpartitioning(ec_piece" not in _plan(found)
    want = tables.f_ecriturec.groupBy("ec_piece", "ct_num", F.col("ec_montant").cast("double").alias("ec_montant")).count().where("count > 1")
    assert _rows(found.toDF(*want.columns)) == _rows(want) and found.count() > 0


@pytest.mark.parametrize("prefix", ["1", "4", "5", "512", "7", "9"])
def test_entries_of_a_class_of_accounts(tables, prefix):
    want = tables.f_ecriturec.filter(F.col("cg_num").startswith(prefix))
    got = ledger_of_class(tables, prefix)
    assert _rows(got) == _rows(want) and got.dtypes == want.dtypes


def test_treasury_makes_its_legs_only(tables):
    explode = re.findall(r"explode\((\[[^\]]*\])", _plan(ledger._treasury_rows(tables)[0]))
    assert set(explode) == {"[3,7]"}


def test_an_agents_sessions_are_asked_once_a_batch():
    calls = []

    class Sessions:
        def get(self):
            calls.append("get")
            return iter([(i * 100, i * 100 + 1, 2) for i in range(50)])

        def put(self, rows):
            calls.append(("put", rows))

    class Handle:
        def getListState(self, name, schema):
            return Sessions()

    merge = _merge(10, False)
    merge.init(Handle())
    out = list(merge.handleInputRows((7,), iter([{"first": 105, "last": 108, "n_beats": 3}]), None))
    assert [r.asDict() for r in out] == [{"agent_id": 7, "first": 100, "last": 108, "n_beats": 5}]
    assert calls[0] == "get" and len(calls) == 2 and len(calls[1][1]) == 50

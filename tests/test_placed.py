"""Ledger rows placed by party: the same rows, dealt out once and while they are few."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture()
def odd(spark, scratch):
    """Order lines that come twice, customers that come twice or not at all, and nulls."""
    from ledgerflow.sources.adapter import ErpTables
    day = dt.datetime(2001, 3, 1)
    spark.createDataFrame([(i, None if i == 5 else i % 4, day) for i in range(12)] + [(3, 3, day)],
                          "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{scratch}/orders.parquet")
    lines = [(i % 13 if i % 11 else None, i * 211 % 430, i % 3 if i % 7 else None, i % 4 + 1, float(i), 10.0 * (i % 5), "RAN"[i % 3], "OF"[i % 2], day)
             for i in range(60)]
    spark.createDataFrame(lines + lines[:9], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{scratch}/lineitem.parquet")
    spark.createDataFrame([(0, "a", 0), (1, "b", 1), (1, "c", 2), (2, "d", None), (None, "e", 1)], "c_custkey long, c_name string, c_nationkey long").selectExpr(
        "*", "1.5D as c_acctbal", "'X' as c_mktsegment").write.parquet(f"{scratch}/customer.parquet")
    spark.createDataFrame([(0, "s", 0), (1, "u", 1)], "s_suppkey long, s_name string, s_nationkey long").selectExpr(
        "*", "2.5D as s_acctbal").write.parquet(f"{scratch}/supplier.parquet")
    spark.createDataFrame([(0, "N0", 0), (1, "N1", 1), (2, "N2", None)], "n_nationkey long, n_name string, n_regionkey long").write.parquet(
        f"{scratch}/nation.parquet")
    return ErpTables(spark, str(scratch))


def _same(a, b):
    assert a.columns == b.columns and a.count() == b.count() and a.exceptAll(b).isEmpty()


def test_placed_rows_are_the_ledger(spark, odd):
    from ledgerflow.sources.adapter import LEDGER_COLUMNS, PARTY_PLACE
    placed = odd.ledger_by_party
    _same(odd.f_ecriturec, placed.select(*LEDGER_COLUMNS))
    assert placed.where("ct_num is not null and __party <> ct_num or __party is null or __slice is null and ec_piece is not null").isEmpty()
    assert placed.where("ec_piece is not null").groupBy("ec_piece").agg(F.count_distinct("__slice").alias("n")).where("n > 1").isEmpty()
    assert set(PARTY_PLACE) == set(placed.columns) - set(LEDGER_COLUMNS)


def test_views_of_placed_and_given_rows_agree(odd):
    from ledgerflow.plans.ledger import general_ledger
    _same(general_ledger(odd, "2001-07-15", ledger=odd.f_ecriturec), general_ledger(odd, "2001-07-15"))


def test_duplicates_are_equal_pieces_of_a_party(spark):
    from minitables import MiniTables, ledger_row, party

    from ledgerflow.plans.ledger import audit_anomalies
    rows = [ledger_row(1, "2001-03-03", "411000", "C1", "5.00", piece="A"), ledger_row(2, "2001-03-04", "411000", "C1", "5.00", piece="A"),
            ledger_row(3, "2001-03-03", "411000", "C1", "6.00", piece="A"), ledger_row(4, "2001-03-03", "411000", "C2", "5.00", piece="A"),
            ledger_row(5, "2001-03-03", "411000", None, "5.00", piece="A"), ledger_row(6, "2001-03-03", "411000", None, "5.00", piece="A")]
    got = {r["ec_no"]: (r["is_doublon_facture"], r["ct_intitule"]) for r in audit_anomalies(MiniTables(spark, rows, [party("C1", "one")]), "2001-07-15").collect()}
    doubled = audit_anomalies(MiniTables(spark, rows[2:4], [party("C1", "one"), party("C1", "one")]), "2001-07-15").collect()
    assert [r["is_doublon_facture"] for r in doubled] == [0, 0, 0]  # a party that is stored twice
    assert got == {1: (1, "one"), 2: (1, "one"), 3: (0, "one"), 4: (0, None), 5: (0, None), 6: (0, None)}


@pytest.mark.parametrize("view", ["general_ledger", "audit_anomalies"])
def test_the_ledger_is_dealt_out_once_before_its_legs(spark, view):
    """By party as lines, and not again as the several times more and wider ledger rows."""
    from ledgerflow.plans import ledger
    from ledgerflow.sources.adapter import ErpTables
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = getattr(ledger, view)(ErpTables(spark, SF_DIR), "2001-07-15")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)", plan)
    assert len([x for x in exchanges if "__party" in x]) == 1
    assert not [x for x in exchanges if "coalesce" in x or "ec_piece" in x or "__piece" in x]


def test_analytic_rows_keep_every_region_of_a_customer(spark, odd):
    """As a left join of every ledger row with the customers' regions gives them."""
    region = odd.src.customer.join(odd.src.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("ck"), "n_regionkey")
    sales = odd._ledger_legs().where("leg = 1").join(region, "ck", "left").select((F.col("ec_no") * 2 + 1).alias("ea_no"), F.concat(
        F.lit("2R"), F.col("n_regionkey").cast("string")).alias("ca_num"))
    _same(sales, odd.f_ecriturea.where("n_analytique = 2").select("ea_no", "ca_num"))


def test_totals_of_analytic_accounts_are_broadcast(spark):
    """All entries are not dealt out by the few analytic accounts."""
    from ledgerflow.plans.analytic import analytic_ledger
    from ledgerflow.sources.adapter import ErpTables
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = analytic_ledger(ErpTables(spark, SF_DIR), "2001-07-15")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert re.search(r"BroadcastHashJoin \[ca_num#\d+\], \[ca_num#\d+\], LeftOuter", plan)


def test_synced_records_stay_where_they_are(spark, scratch):
    """Offsets are a row per partition of a batch: the sink's records are not dealt out for them."""
    from minitables import MiniTables, ledger_row

    from ledgerflow.streaming.stream import LedgerSync, export_source
    rows = [ledger_row(i, "2001-03-03", "411000", None, "1.00") for i in range(1, 40)]
    ledger = MiniTables(spark, rows).f_ecriturec
    export_source(ledger, f"{scratch}/src", 2, "cbmarq")
    job = LedgerSync(spark, "V", f"{scratch}/src", f"{scratch}/job")
    job.run(ledger.schema)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        synced = job.synced()
        assert "SortMergeJoin" not in synced._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["ec_no"] for r in synced.collect()) == list(range(1, 40))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)

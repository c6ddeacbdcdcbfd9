"""Entry numbers beyond 64 bits: orders so many that the formula of the fixtures does not fit."""

import datetime as dt

import pytest

SF_DIR = "/root/testdata/sf0.001"
# around the last order whose entries, and whose analytic entries, have a number by the formula
ORDERS = [3, 9_007_198, 9_007_199, 9_007_200, 18_014_398, 18_014_399, 54_000_000, 2**33 - 1]
LINES = [(1, 17, 3), (1, 17, 3), (2, 430, 8), (7, 99_999, 9_999), (3, 7_000_000, 300_000)]


def _write(spark, path, lines):
    day = dt.datetime(2001, 3, 1)
    spark.createDataFrame([(o, o % 4, day) for o in ORDERS], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame([(o, p, s, n, 2.0, 10.0 * (p or 1), "RA"[o % 2], "F", day) for o in ORDERS for n, p, s in lines],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{path}/lineitem.parquet")
    for name in ("customer", "supplier", "nation", "region", "part", "events"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")


@pytest.fixture()
def wide(spark, scratch):
    from ledgerflow.sources.adapter import ErpTables
    _write(spark, scratch, LINES)
    return ErpTables(spark, str(scratch))


def _formula(order, number, part, supplier, dup, leg):
    return ((((order * 8 + number) * 100000 + part) * 10000 + supplier) * 4 + dup) * 16 + leg


def test_numbers_beyond_64_bits_differ_and_others_stay(wide):
    rows = wide._ledger_legs(("ok", "ln", "pk", "sk", "dup")).select("ec_no", "ok", "ln", "pk", "sk", "dup", "leg", "cbmarq").collect()
    assert len(rows) == len({r["ec_no"] for r in rows}) and {type(r["ec_no"]) for r in rows} == {int}
    by_formula = [(r["ec_no"], _formula(*[r[c] for c in ("ok", "ln", "pk", "sk", "dup", "leg")])) for r in rows]
    assert all(no == want if want < 2**63 else 0 < no < 2**63 for no, want in by_formula)
    assert {want < 2**63 for _, want in by_formula} == {True, False}
    assert all(r["cbmarq"] == r["ec_no"] for r in rows)
    assert {r["ec_no"] for r in rows} == {r["ec_no"] for r in wide.ledger_by_party.select("ec_no").collect()}


def test_analytic_numbers_beyond_64_bits(wide):
    rows = wide.f_ecriturea.select("ea_no", "ec_no", "n_analytique").collect()
    numbers = {r["ec_no"] for r in wide.f_ecriturec.select("ec_no").collect()}
    assert len(rows) == len({r["ea_no"] for r in rows}) and all(r["ec_no"] in numbers and 0 < r["ea_no"] < 2**63 for r in rows)
    doubled = [(r["ea_no"], 2 * r["ec_no"] + r["n_analytique"] - 1) for r in rows]
    assert all(no == want for no, want in doubled if want < 2**63) and any(want >= 2**63 for _, want in doubled)


@pytest.mark.parametrize("name", ["general_ledger", "normalize_records", "audit_anomalies", "analytic_ledger", "sync_cycle_state", "view_queries"])
def test_views_of_many_orders(spark, wide, name):
    from ledgerflow.registry import queries
    rows = queries()[name](spark, wide.sf_dir).collect()
    if name in ("sync_cycle_state", "view_queries"):
        shipped = {r["view_name"]: r for r in rows}["VW_TRESORERIE"]
        cash = wide.f_ecriturec.where("cg_num like '5%'")
        assert shipped["rows_shipped"] == cash.count() > 0
        assert shipped["cursor"] == cash.agg({"cbmarq": "max"}).first()[0]
    elif name == "analytic_ledger":  # an account under two plans is met twice
        assert {r["watermark_sync"] for r in rows} == {r["ea_no"] for r in wide.f_ecriturea.select("ea_no").collect()}
    else:
        assert len(rows) == wide.f_ecriturec.count() > 0


def test_missing_parts_have_no_number(spark, scratch):
    from ledgerflow.sources.adapter import ErpTables
    _write(spark, scratch, [(None, 5, 6), (1, None, 6), (1, 5, None)])
    rows = ErpTables(spark, str(scratch)).f_ecriturec.select("ec_no").collect()
    assert rows and {r["ec_no"] for r in rows} == {None}

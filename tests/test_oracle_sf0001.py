"""Every registered key against its DuckDB oracle on the smallest driver tables."""

import pytest

from oracle_harness import compare, duck_connect

SF_DIR = "/root/testdata/sf0.001"


def _keys():
    from ledgerflow.registry import queries
    return sorted(queries())


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_DIR)


@pytest.mark.parametrize("key", _keys())
def test_key_against_oracle(spark, duck, key):
    from ledgerflow.registry import oracle_sql, queries
    df = queries()[key](spark, SF_DIR)
    sql = oracle_sql().get(key)
    if sql is None:
        assert df.count() > 0
        return
    ok, msg = compare(df, sql, duck)
    assert ok, msg


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0 and "ca_cum_ytd" in df.columns
    from ledgerflow.registry import oracle_sql, queries
    assert set(queries()) <= set(e.queries()) and set(oracle_sql()) <= set(e.oracle_sql())

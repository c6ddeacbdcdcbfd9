"""Registry of the named queries: Spark builder + optional DuckDB oracle SQL.

Each plan module registers its keys with ``@register``; ``__spark_entry__``
reads the two dictionaries so Spark keys and oracle keys cannot drift.
"""

from __future__ import annotations

from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from .oracle.prologue import with_prologue
from .sources.adapter import AS_OF, ErpTables

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLE: dict[str, str | Callable[[], str]] = {}
# per session (a stopped session's frames go with it), by input folder
_TABLES: WeakKeyDictionary[SparkSession, dict[str, ErpTables]] = WeakKeyDictionary()


def tables(spark: SparkSession, sf_dir: str) -> ErpTables:
    """One lazily-derived set of ERP tables per session and input folder."""
    own = _TABLES.setdefault(spark, {})
    return own.setdefault(sf_dir.rstrip("/"), ErpTables(spark, sf_dir))


def use_tables(spark: SparkSession, sf_dir: str, stored: ErpTables) -> None:
    """Let the queries of this session and folder read stored tables."""
    _TABLES.setdefault(spark, {})[sf_dir.rstrip("/")] = stored


def register(name: str, oracle: str | None = None, raw: bool = False):
    """Register ``fn(t: ErpTables, as_of: str) -> DataFrame`` under ``name``.

    ``raw=True`` registers ``fn(spark, sf_dir) -> DataFrame`` as is.
    ``oracle`` is DuckDB SQL over the adapter CTEs (omit for rows-only checks).
    """
    def deco(fn):
        if raw:
            _QUERIES[name] = fn
        else:
            _QUERIES[name] = lambda spark, sf_dir, _fn=fn: _fn(tables(spark, sf_dir), AS_OF)
        if oracle is not None:
            _ORACLE[name] = oracle
        return fn
    return deco


def _load_all() -> None:
    # importing the plan modules fills the registry
    from .plans import (analytic, commerce, documented, extensions, governance, ledger, meta,  # noqa: F401
                        parties, views)
    from .streaming import counters, ingest, logs, sessions, stream, sync, view_queries  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(_QUERIES)


def raw_oracle(name: str) -> str:
    """Oracle SQL of a key without the adapter prologue; ``{KEY:other}``
    placeholders are replaced by the SQL of another key (as a subquery)."""
    sql = _ORACLE[name]
    sql = sql() if callable(sql) else sql
    while "{KEY:" in sql:
        start = sql.index("{KEY:")
        end = sql.index("}", start)
        sql = sql[:start] + raw_oracle(sql[start + 5:end]).strip().rstrip(";") + sql[end + 1:]
    return sql


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: with_prologue(raw_oracle(k)) for k in _ORACLE}

"""View deployment: register every view under its reference name as a Spark
temp view (plan building only), and the guarded ad-hoc SQL job."""

from __future__ import annotations

import re
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# reference view name -> (module, function)
VIEW_FUNCTIONS = {
    "VW_GRAND_LIVRE_GENERAL": ("ledger", "general_ledger"),
    "VW_FINANCE_GENERAL": ("ledger", "finance_daily"),
    "VW_TRESORERIE": ("ledger", "treasury_flows"),
    "VW_CLIENTS": ("parties", "client_receivables"),
    "VW_FOURNISSEURS": ("parties", "supplier_payables"),
    "VW_ANALYTIQUE": ("analytic", "analytic_ledger"),
    "VW_AUDIT_ANOMALIES": ("ledger", "audit_anomalies"),
    "VW_STOCKS_LOGISTIQUE": ("commerce", "stock_logistics"),
    "VW_COMMANDES": ("commerce", "sales_documents_kpi"),
    "VW_IMMOBILISATIONS": ("commerce", "fixed_assets"),
    "VW_PAIE": ("ledger", "payroll_view"),
    "VW_METADATA_AGENT": ("meta", "source_metadata"),
    "VW_KPI_SYNTESE": ("ledger", "kpi_summary"),
    "VW_FINANCES_CLIENTS_FLAT": ("commerce", "client_invoices_flat"),
    "VW_STOCKS": ("commerce", "stock_status"),
}

MAX_ROWS = 1000


def view(t, as_of: str, name: str) -> DataFrame:
    import importlib
    mod, fn = VIEW_FUNCTIONS[name.upper()]
    return getattr(importlib.import_module(f"ledgerflow.plans.{mod}"), fn)(t, as_of)


def register_views(t, as_of: str, names=None) -> list[str]:
    """Create (lazy) temp views; nothing runs until a query uses them."""
    done = []
    for name in names or VIEW_FUNCTIONS:
        view(t, as_of, name).createOrReplaceTempView(name)
        done.append(name)
    return done


_TOKENS = re.compile(r"""'(?:[^']|'')*'|"[^"]*"|\[[^\]]*\]|[()]|\bselect\b(?:\s+(?:distinct|all)\b)?|\b(?:union(?:\s+all)?|except|intersect)\b""", re.I)
_TOP = re.compile(r"\s+top\s*(?:\(\s*(\d+)\s*\)|(\d+)\b)", re.I)


def top_to_limit(sql: str) -> str:
    """``TOP n`` of every SELECT as a LIMIT of that same SELECT; text in quotes or
    brackets stays as it is.  In a set operation the branch is put in parentheses."""
    out: list[str] = []
    open_: list[dict] = [{"top": None, "start": 0, "set": False}]
    at = 0

    def close() -> None:
        branch = open_[-1]
        if branch["top"] is not None:
            out.append(f" LIMIT {branch['top']}")
            if branch["set"]:
                out.insert(branch["start"], "(")
                out.append(")")

    for m in _TOKENS.finditer(sql):
        if m.start() < at:
            continue
        out.append(sql[at:m.start()])
        at, token = m.end(), m[0].lower()
        if token == "(":
            out.append(m[0])
            open_.append({"top": None, "start": len(out), "set": False})
        elif token == ")":
            close()
            if len(open_) > 1:
                open_.pop()
            out.append(m[0])
        elif token.split()[0] in ("union", "except", "intersect"):
            open_[-1]["set"] = True
            close()
            out.append(f" {m[0]}")
            open_[-1].update(top=None, start=len(out))
        elif token.startswith("select"):
            out.append(m[0])
            if top := _TOP.match(sql, at):
                open_[-1]["top"] = int(top[1] or top[2])
                at = top.end()
        else:
            out.append(m[0])
    out.append(sql[at:])
    close()
    return "".join(out)


def _relations(t, sql: str) -> set[str]:
    """Names of all relations in a statement (subqueries too), as Spark's parser reads it."""
    plan = t.spark._jsparkSession.sessionState().sqlParser().parsePlan(sql).toString()
    if "UnresolvedTableValuedFunction" in plan:
        raise PermissionError("query blocked (table_not_allowed): table functions")
    return {x.strip() for x in re.findall(r"UnresolvedRelation \[([^\]]*)\]", plan)}


def adhoc_query(t, as_of: str, sql: str, max_rows: int = MAX_ROWS, allowed_tables=tuple(VIEW_FUNCTIONS)) -> DataFrame:
    """Run one ad-hoc SELECT after the policy check, capped at ``max_rows``.

    The check is the table job of governance.py on one row, with the
    registered views as white list; besides, every relation that Spark's
    parser finds must be one of them (no paths, files or catalog tables).
    The cap is a limit on the final frame."""
    from .governance import audit_queries
    row = audit_queries(t.spark.range(1).select(F.lit(sql).cast("string").alias("sql_text")), allowed_tables=allowed_tables).first()
    if row["verdict"] != "allowed":
        raise PermissionError(f"query blocked ({row['rule']}): {row['detail']}")
    text = top_to_limit(re.sub(r";\s*$", "", sql.strip()))
    allowed = {a.upper() for a in allowed_tables} & set(VIEW_FUNCTIONS)
    used = {x.upper() for x in _relations(t, text)}
    if used - allowed:
        raise PermissionError(f"query blocked (table_not_allowed): {', '.join(sorted(used - allowed))}")
    register_views(t, as_of, sorted(used))
    return t.spark.sql(text).limit(max_rows)


def adhoc_result(t, as_of: str, sql: str, max_rows: int = MAX_ROWS) -> dict:
    """K3: the rows of an ad-hoc query (no more than its cap) with their number, the
    column names and the time it took."""
    began = time.monotonic()
    df = adhoc_query(t, as_of, sql, max_rows)
    rows = [r.asDict(recursive=True) for r in df.collect()]
    return {"rows": rows, "row_count": len(rows), "columns": df.columns, "duration_ms": round(1000 * (time.monotonic() - began))}

"""Incremental extraction, as batch DataFrame programs.

The reference polls each view with an integer change cursor (not an
event-time watermark): rows with cursor > c, ascending, at most 5 000 per
page; it uploads them in chunks of 5 000 and then stores the new cursor.
Here every step is a DataFrame; state lives in append-only tables read back
with ``max_by`` (no MERGE on plain Parquet).

Sync inputs for the tests come from the ``events`` table: cursor = event_id
(with ties: event_id - event_id % 3), view = event_type, agent = user_id,
batch time = ts, row count = props.k.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.patterns import distributed_row_number, scalar
from ..registry import register
from ..session import scratch_path
from .state import MANY_FILES, BatchSink, SyncState

# Fixed values of the reference: rows per page / per ingest call, default
# interval (minutes) of a view without configuration.
PAGE_SIZE = 5000
DEFAULT_INTERVAL_MIN = 60
# view -> (interval minutes, mode) of the reference agent
VIEW_CONFIG = {
    "VW_KPI_SYNTESE": (5, "FULL"), "VW_METADATA_AGENT": (5, "FULL"),
    "VW_GRAND_LIVRE_GENERAL": (15, "INCREMENTAL"), "VW_CLIENTS": (15, "INCREMENTAL"),
    "VW_FOURNISSEURS": (15, "INCREMENTAL"), "VW_TRESORERIE": (15, "INCREMENTAL"),
    "VW_COMMANDES": (30, "INCREMENTAL"), "VW_ANALYTIQUE": (30, "INCREMENTAL"),
    "VW_STOCKS": (60, "INCREMENTAL"), "VW_FINANCE_GENERAL": (60, "INCREMENTAL"),
    "VW_IMMOBILISATIONS": (360, "FULL"), "VW_PAIE": (360, "FULL"),
}

# Test configuration for the event-driven sync inputs (views = event types).
EVENT_VIEW_INTERVALS = {"click": 15, "error": 5, "purchase": 30, "signup": 60, "refund": 360}
EVENT_REMOTE_INTERVALS = {"purchase": 10}
HEARTBEAT_LIMIT_SECONDS = 12 * 3600


# --------------------------------------------------------------------------- I2

def resolve_cursor_column(df: DataFrame) -> str | None:
    """Cursor column of a view: 'watermark_sync' (any case) first, then
    'cbmarq'; None means the view can only be read in FULL mode."""
    by_lower = {c.lower(): c for c in df.columns}
    return by_lower.get("watermark_sync") or by_lower.get("cbmarq")


def effective_mode(df: DataFrame, configured: str) -> str:
    return "INCREMENTAL" if configured == "INCREMENTAL" and resolve_cursor_column(df) else "FULL"


# --------------------------------------------------------------------------- I1

#: Ranges of cursor values that a page's end is looked for in.
CURSOR_RANGES = 4096


def _range_bound(after: DataFrame, col: str, size: int) -> Column:
    """A cursor value by which at least ``size`` rows of ``after`` have come (their
    largest value if there are fewer), as a scalar subquery.

    Counts per range of cursor values decide, so a page never gathers
    ``size`` rows of every input partition in one task, and the bound reaches
    the scan as a filter.
    """
    ends = after.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    lo, hi = scalar(ends, F.col("lo")), scalar(ends, F.col("hi"))
    step = F.floor((hi - lo) / CURSOR_RANGES) + 1
    ranges = after.groupBy(F.floor((F.col(col) - lo) / step).alias("__cursor_range")).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("__cursor_range").rowsBetween(Window.unboundedPreceding, 0))
    full = ranges.withColumn("upto", upto).filter(F.col("upto") >= size)
    return F.coalesce(lo + (scalar(full, F.min("__cursor_range")) + 1) * step - 1, hi)


def cursor_page(view: DataFrame, cursor: int | Column, size: int = PAGE_SIZE,
                cursor_col: str | None = None) -> DataFrame:
    """Rows with cursor > c in ascending cursor order, at most ``size``.

    The filter is applied to the finished view (never to its inputs), so
    whole-set windows inside the view are not changed by paging.  Only rows
    up to a bound that is known to hold the page are sorted.  A page may end
    inside a group of equal cursors: ``cursor_page_tie_safe`` does not."""
    col = cursor_col or resolve_cursor_column(view)
    if col is None:
        return view  # FULL mode: everything
    c = cursor if isinstance(cursor, Column) else F.lit(cursor)
    after = view.filter(F.col(col) > c)
    bound = _range_bound(after.select(col), col, size)
    return after.filter(F.col(col) <= bound).orderBy(F.col(col).asc()).limit(size)


def cursor_page_tie_safe(view: DataFrame, cursor: int | Column, size: int = PAGE_SIZE,
                         cursor_col: str | None = None) -> DataFrame:
    """Like ``cursor_page`` but never splits a group of equal cursor values:
    with v the ``size``-th cursor value after c, returns every row with
    c < cursor <= v (a page may then hold a few more than ``size`` rows).
    A strict '>' plus TOP loses the rest of a tie group at the page border."""
    col = cursor_col or resolve_cursor_column(view)
    c = cursor if isinstance(cursor, Column) else F.lit(cursor)
    after = view.filter(F.col(col) > c)
    near = after.select(col).filter(F.col(col) <= _range_bound(after.select(col), col, size))
    border = scalar(near.orderBy(F.col(col).asc()).limit(size), F.max(col))
    return after.filter(F.col(col) <= border)


# --------------------------------------------------------------------------- I3

def normalize_records(df: DataFrame) -> DataFrame:
    """JSON-safe records: dates and timestamps -> ISO-8601 UTC with
    milliseconds, binary -> lower-case hex, everything else unchanged
    (64-bit integers stay exact longs instead of lossy doubles)."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        c = F.col(f"`{f.name}`")
        if t in ("date", "timestamp", "timestamp_ntz"):
            ts = c.cast("timestamp_ntz") if t != "timestamp" else c
            c = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
        elif t == "binary":
            c = F.lower(F.hex(c))
        out.append(c.alias(f.name))
    return df.select(*out)


# --------------------------------------------------------------------------- I4

#: Chunk numbers made from one row.
CHUNK_BLOCK = 10_000


def chunk_envelopes(rows: DataFrame, view_name: str, mode: str, cursor_min: int, cursor_max: int | Column | None,
                    schema_version: str = "unknown", size: int = PAGE_SIZE) -> DataFrame:
    """One envelope row per ingest chunk of ``size`` rows; cursor_max is only set on
    the last chunk (NULL on the others).  Chunk sizes follow from the number
    of rows, so nothing is ranked or shuffled for them."""
    cmax = cursor_max if isinstance(cursor_max, Column) else F.lit(cursor_max)
    n = rows.agg(F.count(F.lit(1)).alias("n"), *([cmax.alias("c")] if isinstance(cursor_max, Column) else []))
    c = F.col("c") if isinstance(cursor_max, Column) else cmax
    last = F.floor((F.col("n") - 1) / size)
    # numbers in two steps: no array has more than CHUNK_BLOCK entries, and blocks are dealt out
    block = n.filter("n > 0").withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / CHUNK_BLOCK)))).repartition("__block")
    start = F.col("__block") * CHUNK_BLOCK
    chunks = block.withColumn("chunk_index", F.explode(F.sequence(start, F.least(start + CHUNK_BLOCK - 1, last))))
    return chunks.select(
        F.lit(view_name).alias("view_name"), F.lit(mode).alias("sync_mode"), "chunk_index",
        F.lit(cursor_min).cast("long").alias("watermark_min"),
        F.when(F.col("chunk_index") == last, c.cast("long")).alias("watermark_max"),
        F.least(F.lit(size).cast("long"), F.col("n") - F.col("chunk_index") * size).alias("row_count"),
        F.lit(schema_version).alias("schema_version"))


def chunked_rows(rows: DataFrame, order: list[Column], size: int = PAGE_SIZE) -> DataFrame:
    """``rows`` with ``chunk_index`` and ``chunk_pos`` by a distributed row number
    (written once: an action, for sinks)."""
    n = F.col("__rn") - 1
    return distributed_row_number(rows, order, "__rn").withColumns(
        {"chunk_index": F.floor(n / size).cast("long"), "chunk_pos": (n % size).cast("long")}).drop("__rn")


def to_payload(rows: DataFrame, envelopes: DataFrame) -> DataFrame:
    """One JSON document per chunk (the ingest body), built on the executors; rows in
    their order, NULL fields kept as null.  ``rows`` as of ``chunked_rows``."""
    fields = [c for c in rows.columns if c not in ("chunk_index", "chunk_pos")]
    record = F.struct("chunk_pos", F.struct(*[F.col(f"`{c}`") for c in fields]).alias("r"))
    body = rows.groupBy("chunk_index").agg(
        F.transform(F.array_sort(F.collect_list(record)), lambda x: x["r"]).alias("rows"))
    return envelopes.join(body, "chunk_index").select(
        "view_name", "chunk_index",
        F.to_json(F.struct("view_name", "sync_mode", "watermark_min", "watermark_max", "row_count",
                           "schema_version", "rows"), {"ignoreNullFields": "false"}).alias("payload"))


# --------------------------------------------------------------------------- sync log

def sync_batches(t) -> DataFrame:
    """The batch history derived from ``events`` (one row per ingest batch)."""
    ev = t.src.events
    return ev.select(
        F.col("event_id").alias("batch_id"), F.col("user_id").alias("agent_id"),
        F.col("event_type").alias("view_name"), F.col("ts").alias("received_at"),
        F.get_json_object("props", "$.k").cast("int").alias("row_count"),
        (F.col("event_id") - F.col("event_id") % 3).alias("cursor"),
        F.when(F.col("event_type") == "error", "error").otherwise("ok").alias("status"))


BATCHES_SQL = """
batches AS (
    SELECT event_id AS batch_id, user_id AS agent_id, event_type AS view_name, ts AS received_at,
        CAST(json_extract_string(props, '$.k') AS INTEGER) AS row_count,
        event_id - event_id % 3 AS cursor,
        CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status
    FROM events
)"""


def _events_source(t) -> DataFrame:
    """The events table seen as a sync source whose cursor has ties."""
    ev = t.src.events
    return ev.withColumn("watermark_sync", F.col("event_id") - F.col("event_id") % 3)


# --------------------------------------------------------------------------- keys

def ledger_view_page(t, as_of: str, cursor) -> DataFrame:
    """A page of the general-ledger view.  The view is row-preserving (only
    unique-key joins, no window), so the page is cut on the ledger's own
    cursor (cbmarq = watermark_sync) before the joins: same rows, and the
    bounded top-k runs on the scan instead of on the joined table.  Views
    with whole-set windows are always paged after they are computed."""
    from ..plans.ledger import general_ledger
    page = cursor_page(t.f_ecriturec, cursor, cursor_col="cbmarq")
    return general_ledger(t, as_of, ledger=page).orderBy("watermark_sync")


@register("cursor_page", """
WITH gl AS (SELECT * FROM (""" + "{KEY:general_ledger}" + """)),
p1 AS (SELECT watermark_sync FROM gl WHERE watermark_sync > 0 ORDER BY watermark_sync LIMIT 5000)
SELECT * FROM gl WHERE watermark_sync > (SELECT max(watermark_sync) FROM p1)
ORDER BY watermark_sync LIMIT 5000
""")
def cursor_page_key(t, as_of: str) -> DataFrame:
    """Second page of the general ledger: cursor = last value of page 1."""
    first = cursor_page(t.f_ecriturec, 0, cursor_col="cbmarq")
    return ledger_view_page(t, as_of, scalar(first, F.max("cbmarq")))


@register("cursor_page_tie_safe", """
WITH src AS (SELECT *, event_id - event_id % 3 AS watermark_sync FROM events),
border AS (SELECT max(watermark_sync) AS v FROM
           (SELECT watermark_sync FROM src WHERE watermark_sync > 0 ORDER BY watermark_sync LIMIT 5000))
SELECT * FROM src WHERE watermark_sync > 0 AND watermark_sync <= (SELECT v FROM border)
""")
def cursor_page_tie_safe_key(t, as_of: str) -> DataFrame:
    return cursor_page_tie_safe(_events_source(t), 0)


@register("full_mode_scan", "{KEY:client_receivables}")
def full_mode_scan(t, as_of: str) -> DataFrame:
    """A view without a cursor column is read whole (FULL mode)."""
    from ..plans.parties import client_receivables
    view = client_receivables(t, as_of)
    assert effective_mode(view, "INCREMENTAL") == "FULL"
    return cursor_page(view, 0)


_ISO = "%Y-%m-%dT%H:%M:%S.%gZ"
NORMALIZED_LEDGER_SQL = f"""
SELECT * REPLACE (strftime(dt_jour::TIMESTAMP, '{_ISO}') AS dt_jour, strftime(date_creation_saisie, '{_ISO}') AS date_creation_saisie,
                  strftime(date_modification, '{_ISO}') AS date_modification)
FROM (""" + "{KEY:general_ledger})"


@register("normalize_records", NORMALIZED_LEDGER_SQL)
def normalize_records_key(t, as_of: str) -> DataFrame:
    """I3 on every row of the general ledger."""
    from ..plans.ledger import general_ledger
    return normalize_records(general_ledger(t, as_of))


@register("ingest_chunks", """
WITH n AS (SELECT count(*) AS n FROM ({KEY:finance_daily})),
c AS (SELECT unnest(range((n + 4999) // 5000)) AS chunk_index, n FROM n)
SELECT 'VW_FINANCE_GENERAL' AS view_name, 'FULL' AS sync_mode, chunk_index, 0::BIGINT AS watermark_min,
    if(chunk_index = max(chunk_index) OVER (), 0::BIGINT, NULL) AS watermark_max, least(5000, n - 5000 * chunk_index) AS row_count,
    'unknown' AS schema_version
FROM c
""")
def ingest_chunks_key(t, as_of: str) -> DataFrame:
    """The finance view has no cursor column: FULL mode, whole view in
    chunks of 5 000, watermark_max 0 on the last chunk only."""
    from ..plans.ledger import finance_daily
    view = finance_daily(t, as_of)
    mode = effective_mode(view, VIEW_CONFIG["VW_FINANCE_GENERAL"][1])
    return chunk_envelopes(view, "VW_FINANCE_GENERAL", mode, 0, 0)


PAYLOAD_ROWS = "array<struct<numero_piece:string,date_facture:string,exercice:int,type_piece:string,montant_ht:double,montant_ttc:double,code_client:string>>"


@register("ingest_payload", """
WITH r AS (SELECT *, row_number() OVER (ORDER BY numero_piece, type_piece) - 1 AS place, count(*) OVER () AS n FROM ({KEY:client_invoices_flat}))
SELECT 'VW_FINANCES_CLIENTS_FLAT' AS view_name, place // 5000 AS chunk_index, place % 5000 AS chunk_pos, least(5000, n - place // 5000 * 5000) AS row_count,
    if(place // 5000 = (n - 1) // 5000, 0::BIGINT, NULL) AS watermark_max, numero_piece,
    strftime(date_facture::TIMESTAMP, '""" + _ISO + """') AS date_facture, exercice, type_piece, montant_ht, montant_ttc, code_client
FROM r
""")
def ingest_payload(t, as_of: str) -> DataFrame:
    """K1: the invoices view as JSON payloads, parsed back: every record in its chunk and place."""
    from ..plans.commerce import client_invoices_flat
    view = client_invoices_flat(t, as_of)
    chunks = chunked_rows(normalize_records(view), [F.col("numero_piece"), F.col("type_piece")])
    payload = to_payload(chunks, chunk_envelopes(view, "VW_FINANCES_CLIENTS_FLAT", "FULL", 0, 0))
    body = F.from_json("payload", F.lit(f"struct<view_name:string,row_count:bigint,watermark_max:bigint,rows:{PAYLOAD_ROWS}>"))
    parsed = payload.select("chunk_index", body.alias("b")).select(
        "b.view_name", "chunk_index", "b.row_count", "b.watermark_max", F.posexplode("b.rows").alias("chunk_pos", "r"))
    return parsed.select("view_name", "chunk_index", F.col("chunk_pos").cast("long").alias("chunk_pos"), "row_count", "watermark_max", "r.*")


@register("watermark_state", f"""
WITH {BATCHES_SQL}
SELECT view_name, 0::BIGINT AS watermark_min, max(cursor) AS watermark_max, count(*) AS row_count, true AS persisted
FROM batches WHERE cursor > 0 GROUP BY view_name
""")
def watermark_state(t, as_of: str) -> DataFrame:
    """One cycle from cursor 0 per view, drained to its end (groups of equal
    cursors whole); the new cursor is the maximum and is only stored when > 0."""
    rows = sync_batches(t).filter(F.col("cursor") > 0)
    return rows.groupBy("view_name").agg(
        F.lit(0).cast("long").alias("watermark_min"), F.max("cursor").alias("watermark_max"),
        F.count(F.lit(1)).alias("row_count"), (F.max("cursor") > 0).alias("persisted"))


@register("full_resync", f"""
WITH {BATCHES_SQL}
SELECT view_name, max(cursor) AS watermark_before, 0::BIGINT AS watermark_after FROM batches WHERE cursor > 0 GROUP BY view_name
""")
def full_resync(t, as_of: str) -> DataFrame:
    """Cursors are stored, FORCE_FULL_SYNC resets them, both states are read back."""
    state = SyncState(t.spark, scratch_path(t.spark, f"resync-{uuid.uuid4().hex}"))
    state.set_all(watermark_state(t, as_of).filter("persisted").select("view_name", F.col("watermark_max").alias("cursor")))
    # a row per view; read before the reset appends newer versions
    before = t.spark.createDataFrame(state.cursors().collect(), "view_name string, watermark_before long")
    state.reset()
    return before.join(state.cursors().withColumnRenamed("cursor", "watermark_after"), "view_name")


@register("snapshot_latest", f"""
WITH {BATCHES_SQL},
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY agent_id, view_name ORDER BY received_at DESC, batch_id DESC) AS rn,
             COUNT(*) OVER (PARTITION BY agent_id, view_name) AS n_batches
      FROM batches)
SELECT agent_id, view_name, batch_id AS last_batch_id, received_at AS last_received_at,
    row_count AS last_row_count, cursor AS last_watermark, n_batches
FROM r WHERE rn = 1
""")
def snapshot_latest(t, as_of: str) -> DataFrame:
    """Latest batch per (agent, view) with max_by, no sort."""
    b = sync_batches(t)
    key = F.struct("received_at", "batch_id")
    return b.groupBy("agent_id", "view_name").agg(
        F.max_by("batch_id", key).alias("last_batch_id"), F.max("received_at").alias("last_received_at"),
        F.max_by("row_count", key).alias("last_row_count"), F.max_by("cursor", key).alias("last_watermark"),
        F.count(F.lit(1)).alias("n_batches"))


def _intervals_frame(spark) -> DataFrame:
    rows = [(v, EVENT_VIEW_INTERVALS.get(v), EVENT_REMOTE_INTERVALS.get(v))
            for v in sorted(set(EVENT_VIEW_INTERVALS) | set(EVENT_REMOTE_INTERVALS))]
    return spark.createDataFrame(rows, "view_name string, local_interval int, remote_interval int")


def _intervals_sql() -> str:
    names = sorted(set(EVENT_VIEW_INTERVALS) | set(EVENT_REMOTE_INTERVALS))
    vals = ", ".join(f"('{v}', {EVENT_VIEW_INTERVALS.get(v, 'NULL')}, {EVENT_REMOTE_INTERVALS.get(v, 'NULL')})"
                     for v in names)
    return f"cfg AS (SELECT * FROM (VALUES {vals}) v(view_name, local_interval, remote_interval))"


@register("due_views", f"""
WITH {BATCHES_SQL}, {_intervals_sql()},
last AS (SELECT view_name, max(received_at) AS last_run FROM batches GROUP BY view_name),
now_ AS (SELECT max(received_at) AS now_ts FROM batches),
v AS (SELECT coalesce(l.view_name, c.view_name) AS view_name, l.last_run,
             CAST(coalesce(c.remote_interval, c.local_interval, {DEFAULT_INTERVAL_MIN}) AS INTEGER) AS interval_min
      FROM last l FULL OUTER JOIN cfg c ON l.view_name = c.view_name)
SELECT view_name, last_run, interval_min,
    (epoch_us((SELECT now_ts FROM now_)) - epoch_us(last_run)) / 60000000.0 AS elapsed_min,
    last_run IS NULL OR (epoch_us((SELECT now_ts FROM now_)) - epoch_us(last_run)) / 60000000.0 >= interval_min AS is_due
FROM v
""")
def due_views(t, as_of: str) -> DataFrame:
    """I8: a view is due if it never ran or if the time since its last run
    reaches its interval (remote value, else local, else 60 minutes).  'now'
    is the time of the newest batch in the log."""
    b = sync_batches(t)
    last = b.groupBy("view_name").agg(F.max("received_at").alias("last_run"))
    now = scalar(b, F.max("received_at"))
    cfg = _intervals_frame(t.spark)
    v = last.join(cfg, "view_name", "full_outer").select(
        "view_name", "last_run",
        F.coalesce("remote_interval", "local_interval", F.lit(DEFAULT_INTERVAL_MIN)).cast("int").alias("interval_min"))
    # zone-independent difference of two timestamp_ntz values
    elapsed = F.timestamp_diff("MICROSECOND", F.col("last_run"), now) / 60000000.0
    return v.select("view_name", "last_run", "interval_min", elapsed.alias("elapsed_min"),
                    (F.col("last_run").isNull() | (elapsed >= F.col("interval_min"))).alias("is_due"))


@register("sync_status", f"""
WITH {BATCHES_SQL}, {_intervals_sql()},
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY view_name ORDER BY received_at DESC, batch_id DESC) AS rn FROM batches),
s AS (SELECT view_name, max(received_at) AS last_sync, CAST(SUM(row_count) AS BIGINT) AS total_synced, COUNT(*) AS n_batches
      FROM batches GROUP BY view_name)
SELECT s.view_name, s.last_sync, r.row_count AS last_count, 'INCREMENTAL' AS mode,
    CAST(coalesce(c.remote_interval, c.local_interval, {DEFAULT_INTERVAL_MIN}) AS INTEGER) AS interval_min,
    s.total_synced, s.n_batches
FROM s JOIN r ON s.view_name = r.view_name AND r.rn = 1
LEFT JOIN cfg c ON s.view_name = c.view_name
""")
def sync_status(t, as_of: str) -> DataFrame:
    """Per view last sync time, last row count, mode, interval, running total."""
    b = sync_batches(t)
    key = F.struct("received_at", "batch_id")
    s = b.groupBy("view_name").agg(F.max("received_at").alias("last_sync"),
                                   F.max_by("row_count", key).alias("last_count"),
                                   F.sum("row_count").alias("total_synced"),
                                   F.count(F.lit(1)).alias("n_batches"))
    cfg = _intervals_frame(t.spark)
    return s.join(F.broadcast(cfg), "view_name", "left").select(
        "view_name", "last_sync", "last_count", F.lit("INCREMENTAL").alias("mode"),
        F.coalesce("remote_interval", "local_interval", F.lit(DEFAULT_INTERVAL_MIN)).cast("int").alias("interval_min"),
        "total_synced", "n_batches")


@register("batch_history", f"""
WITH {BATCHES_SQL}
SELECT batch_id, agent_id, view_name, 'INCREMENTAL' AS sync_mode, cursor AS watermark_max, row_count,
    strftime(received_at, '%Y-%m-%dT%H:%M:%S.%gZ') AS received_at, status
FROM batches
""")
def batch_history(t, as_of: str) -> DataFrame:
    """K2: the append-only batch history as stored (ISO times)."""
    b = sync_batches(t)
    return normalize_records(b.select("batch_id", "agent_id", "view_name", F.lit("INCREMENTAL").alias("sync_mode"),
                                      F.col("cursor").alias("watermark_max"), "row_count", "received_at", "status"))


@register("batch_history_page", f"""
WITH {BATCHES_SQL},
f AS (SELECT * FROM batches WHERE view_name = 'click')
SELECT batch_id, agent_id, view_name, row_count, received_at, (SELECT COUNT(*) FROM f) AS total
FROM f ORDER BY received_at DESC, batch_id DESC LIMIT 50 OFFSET 50
""")
def batch_history_page(t, as_of: str, view: str = "click", page: int = 2, limit: int = 50) -> DataFrame:
    """Batch history of one view, newest first, page ``page`` of ``limit``
    rows (limit capped at 100), with the total count."""
    limit = min(limit, 100)
    f = sync_batches(t).filter(F.col("view_name") == view)
    total = scalar(f, F.count(F.lit(1)))
    return (f.orderBy(F.col("received_at").desc(), F.col("batch_id").desc()).offset((page - 1) * limit).limit(limit)
            .select("batch_id", "agent_id", "view_name", "row_count", "received_at", total.alias("total")))


JOB_STATS_SQL = """
WITH j AS (SELECT user_id AS agent_id, event_id, ts, event_type = 'error' AS failed FROM events),
ok AS (SELECT agent_id, max(ts) AS last_ok_ts FROM j WHERE NOT failed GROUP BY agent_id),
okk AS (SELECT j.agent_id, ok.last_ok_ts, max(j.event_id) AS last_ok_id
        FROM j JOIN ok ON j.agent_id = ok.agent_id AND j.ts = ok.last_ok_ts WHERE NOT j.failed
        GROUP BY j.agent_id, ok.last_ok_ts)
SELECT j.agent_id, COUNT(*) AS runs, CAST(SUM(CASE WHEN failed THEN 1 ELSE 0 END) AS BIGINT) AS failed,
    CAST(SUM(CASE WHEN failed AND (okk.last_ok_ts IS NULL OR j.ts > okk.last_ok_ts
                               OR (j.ts = okk.last_ok_ts AND j.event_id > okk.last_ok_id)) THEN 1 ELSE 0 END) AS BIGINT)
        AS consecutive_errors,
    max(CASE WHEN failed THEN j.ts END) AS last_error_at, max(CASE WHEN NOT failed THEN j.ts END) AS last_success_at
FROM j LEFT JOIN okk ON j.agent_id = okk.agent_id
GROUP BY j.agent_id
"""


@register("job_stats", JOB_STATS_SQL)
def job_stats(t, as_of: str) -> DataFrame:
    """Runs, failures, consecutive failures since the last success,
    last error / success time per agent (errors = 'error' events).  Two
    grouped aggregations and a join, no per-agent window."""
    ev = t.src.events
    j = ev.select(F.col("user_id").alias("agent_id"), "event_id", "ts",
                  (F.col("event_type") == "error").alias("failed"))
    last_ok = j.filter(~F.col("failed")).groupBy("agent_id").agg(
        F.max(F.struct("ts", "event_id")).alias("__ok"))
    jj = j.join(last_ok, "agent_id", "left")
    after_ok = F.col("__ok").isNull() | (F.struct("ts", "event_id") > F.col("__ok"))
    return jj.groupBy("agent_id").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum(F.when(F.col("failed"), 1).otherwise(0)).cast("long").alias("failed"),
        F.sum(F.when(F.col("failed") & after_ok, 1).otherwise(0)).cast("long").alias("consecutive_errors"),
        F.max(F.when(F.col("failed"), F.col("ts"))).alias("last_error_at"),
        F.max(F.when(~F.col("failed"), F.col("ts"))).alias("last_success_at"))


# --------------------------------------------------------------------------- I12

def heartbeat_sessions_df(beats: DataFrame, agent: str = "agent_id", ts: str = "ts",
                          limit_seconds: int = HEARTBEAT_LIMIT_SECONDS) -> DataFrame:
    """Online periods per agent: a beat at most ``limit_seconds`` after the previous
    one stays in its session (a new session starts after a longer silence);
    a session ends that long after its last beat.

    Two beats in one slot of ``limit_seconds`` are always in one session, so
    beats are first combined per (agent, slot), before the shuffle; sessions
    are then put together from slots, of which an agent has as many as its
    time span holds, however often it beats."""
    slot = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / (limit_seconds * 1_000_000))
    slots = beats.groupBy(F.col(agent).alias("agent_id"), slot.alias("__slot")).agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last"))
    w = Window.partitionBy("agent_id").orderBy("__slot")
    silent = F.timestamp_diff("MICROSECOND", F.lag("last").over(w), F.col("first")) > limit_seconds * 1_000_000
    marked = slots.withColumn("__new", F.when(silent, 1).otherwise(0)).withColumn("__session", F.sum("__new").over(w))
    sessions = marked.groupBy("agent_id", "__session").agg(
        F.sum("n").alias("n_beats"), F.min("first").alias("first_beat"), F.max("last").alias("last_beat"))
    return sessions.select("agent_id", F.col("first_beat").alias("session_start"),
                           F.timestamp_add("SECOND", F.lit(limit_seconds), F.col("last_beat")).alias("session_end"),
                           "n_beats", "first_beat", "last_beat")


def heartbeat_gaps_df(beats: DataFrame, agent: str = "agent_id", ts: str = "ts",
                      limit_seconds: int = HEARTBEAT_LIMIT_SECONDS) -> DataFrame:
    """Silences longer than the limit: consecutive sessions of an agent.

    The per-agent window runs over sessions, whose number is bounded by the
    agent's time span divided by the limit, never over raw beats."""
    sess = heartbeat_sessions_df(beats, agent, ts, limit_seconds)
    w = Window.partitionBy("agent_id").orderBy("first_beat")
    g = sess.select("agent_id", F.lag("last_beat").over(w).alias("silent_from"),
                    F.col("first_beat").alias("silent_until"))
    gap_s = F.timestamp_diff("MICROSECOND", F.col("silent_from"), F.col("silent_until")) / 1e6
    return (g.filter(F.col("silent_from").isNotNull())
            .select("agent_id", "silent_from", "silent_until", (gap_s / 60.0).alias("gap_minutes"))
            .filter(F.col("gap_minutes") * 60.0 > limit_seconds))


def _beats(t) -> DataFrame:
    return t.src.events.select(F.col("user_id").alias("agent_id"), "ts")


HB_SQL = f"""
b AS (SELECT user_id AS agent_id, ts, event_id FROM events),
l AS (SELECT *, lag(ts) OVER (PARTITION BY agent_id ORDER BY ts, event_id) AS prev_ts FROM b),
s AS (SELECT *, SUM(CASE WHEN prev_ts IS NULL OR ts > prev_ts + INTERVAL {HEARTBEAT_LIMIT_SECONDS} SECOND
                         THEN 1 ELSE 0 END)
                 OVER (PARTITION BY agent_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM l)"""


@register("heartbeat_sessions", f"""
WITH {HB_SQL}
SELECT agent_id, min(ts) AS session_start, max(ts) + INTERVAL {HEARTBEAT_LIMIT_SECONDS} SECOND AS session_end,
    COUNT(*) AS n_beats, min(ts) AS first_beat, max(ts) AS last_beat
FROM s GROUP BY agent_id, sid
""")
def heartbeat_sessions(t, as_of: str) -> DataFrame:
    return heartbeat_sessions_df(_beats(t))


@register("heartbeat_gaps", f"""
WITH {HB_SQL}
SELECT agent_id, prev_ts AS silent_from, ts AS silent_until,
    (epoch_us(ts) - epoch_us(prev_ts)) / 1e6 / 60.0 AS gap_minutes
FROM l WHERE prev_ts IS NOT NULL AND (epoch_us(ts) - epoch_us(prev_ts)) / 1e6 > {HEARTBEAT_LIMIT_SECONDS}
""")
def heartbeat_gaps(t, as_of: str) -> DataFrame:
    return heartbeat_gaps_df(_beats(t))


# --------------------------------------------------------------------------- L2

@register("adhoc_row_cap", "WITH tf AS (SELECT * FROM ({KEY:treasury_flows})) SELECT * FROM tf ORDER BY ec_no LIMIT 1000")
def adhoc_row_cap(t, as_of: str) -> DataFrame:
    """Ad-hoc SELECT over the registered views, capped at the configured
    1 000 rows (the cap is a limit on the final frame)."""
    from ..plans.views import adhoc_query
    return adhoc_query(t, as_of, "SELECT * FROM VW_TRESORERIE ORDER BY ec_no")


@register("adhoc_subquery_top", """
WITH f AS (SELECT * FROM ({KEY:client_invoices_flat}))
SELECT count(*) AS n, sum(montant_ht) AS total, 'SELECT TOP 5' AS label
FROM (SELECT montant_ht FROM f ORDER BY montant_ht DESC, numero_piece LIMIT 10)
""")
def adhoc_subquery_top(t, as_of: str) -> DataFrame:
    """TOP belongs to its own SELECT, and text in quotes stays as it is."""
    from ..plans.views import adhoc_query
    return adhoc_query(t, as_of, "SELECT COUNT(*) AS n, SUM(montant_ht) AS total, 'SELECT TOP 5' AS label FROM "
                                 "(SELECT TOP 10 montant_ht FROM VW_FINANCES_CLIENTS_FLAT ORDER BY montant_ht DESC, numero_piece) q")


# --------------------------------------------------------------------------- I8 + I11

def due_now(state: SyncState, config: dict[str, tuple[int, str]]) -> list[str]:
    """Views of ``config`` that never ran or whose interval has passed (one row per view is read)."""
    waited = F.timestamp_diff("SECOND", F.col("last_run"), F.localtimestamp()) / 60.0
    last = {r["view_name"]: r["m"] for r in state.snapshot().select("view_name", waited.alias("m")).collect()}
    return [v for v, (minutes, _) in config.items() if v not in last or last[v] >= minutes]


#: Called with "data" or "commit" and the view once that step of a batch is done.
Step = Callable[[str, str], None]


class Stopped(BaseException):
    """Raised by a step's callback: ends a cycle there and then, as a crash would."""


def stop_after(last: str) -> Step:
    def stop(step: str, view: str) -> None:
        if step == last:
            raise Stopped(f"{view}: {step}")
    return stop


def sync_view(v: DataFrame, name: str, state: SyncState, sink: BatchSink, page_size: int | None = None,
              done: Step = lambda step, view: None) -> dict:
    """Ship what a view has after its cursor (see ``run_sync_cycle``)."""
    mode = effective_mode(v, VIEW_CONFIG.get(name, (DEFAULT_INTERVAL_MIN, "FULL"))[1])
    col = resolve_cursor_column(v) if mode == "INCREMENTAL" else None
    epoch, cursor, total = state.epoch(name), (state.get(name) if col else 0), 0
    while True:
        rows = v
        if col:
            rows = cursor_page_tie_safe(v, cursor, page_size) if page_size else v.filter(F.col(col) > cursor)
        attempt, n, last = sink.write(name, rows, col)
        done("data", name)
        if n or not col:
            state.commit(name, attempt, mode, cursor, last, n, epoch)
            done("commit", name)
        elif not total:
            state.nothing_new(name, mode, cursor)
        total, cursor = total + n, last if last is not None and last > 0 else cursor
        # a page with fewer rows than asked for is the last one
        if not col or not page_size or n < page_size:
            return {"rows": total, "cursor": cursor, "mode": mode}


def run_sync_cycle(t, as_of: str, state: SyncState, sink: BatchSink, views: list[str] | None = None,
                   page_size: int | None = None, done: Step = lambda step, view: None) -> tuple[dict[str, dict], dict[str, str]]:
    """One cycle over ``views`` (default: the due ones of ``VIEW_CONFIG``).

    Per view everything after its stored cursor is shipped, in one batch, or with
    ``page_size`` in pages that never split a group of equal cursors, until none is left; a
    view without a cursor is published as a new snapshot.  A batch's rows are written
    first, counted on the way; one row of the state then commits data, history and cursor.
    After a crash at any point the next cycle ships each row once.  A failing view
    is recorded and skipped; the others go on.  Returns per-view results (rows, cursor,
    mode) and per-view errors."""
    from ..plans.views import view as build_view
    results, errors = {}, {}
    for name in due_now(state, VIEW_CONFIG) if views is None else views:
        try:
            results[name] = sync_view(build_view(t, as_of, name), name, state, sink, page_size, done)
        except Exception as e:  # noqa: BLE001 - isolation is the point
            errors[name] = f"{type(e).__name__}: {str(e)[:300]}"
            state.failed(name, errors[name])
    state.compact(MANY_FILES)
    return results, errors


# views with equal cursors (stock), a whole-set window, one row, and no cursor
CYCLE_VIEWS = {"VW_STOCKS": "stock_status", "VW_TRESORERIE": "treasury_flows", "VW_KPI_SYNTESE": "kpi_summary",
               "VW_CLIENTS": "client_receivables"}
CYCLE_CURSORS = ("VW_STOCKS", "VW_TRESORERIE")


@register("sync_cycle_state", " UNION ALL ".join(
    f"SELECT '{v}' AS view_name, count(*) AS rows_shipped, {'max(watermark_sync)' if v in CYCLE_CURSORS else '0::BIGINT'} AS cursor, "
    f"{'count(DISTINCT watermark_sync)' if v in CYCLE_CURSORS else 'NULL::BIGINT'} AS distinct_cursors "
    f"FROM ({{KEY:{k}}})" for v, k in CYCLE_VIEWS.items()))
def sync_cycle_state(t, as_of: str) -> DataFrame:
    """Rows shipped and final cursor per view, read from the stored batches and state after
    a cycle that ends between data and commit, one that ends after a commit, a whole one, and one more
    (nothing new; a view without a cursor is published anew and read once)."""
    root = scratch_path(t.spark, f"cycle-{uuid.uuid4().hex}")
    state = SyncState(t.spark, f"{root}/state")
    sink = BatchSink(t.spark, f"{root}/sink", state)
    for last_step in ("data", "commit"):
        with contextlib.suppress(Stopped):
            run_sync_cycle(t, as_of, state, sink, ["VW_STOCKS"], done=stop_after(last_step))
    for views in (list(CYCLE_VIEWS), ["VW_STOCKS", "VW_KPI_SYNTESE"]):
        _, errors = run_sync_cycle(t, as_of, state, sink, views)
        if errors:
            raise RuntimeError(f"views failed: {errors}")
    out = None
    for name in CYCLE_VIEWS:
        rows = sink.read(name)
        seen = F.count_distinct("watermark_sync") if name in CYCLE_CURSORS else F.lit(None)
        one = rows.agg(F.lit(name).alias("view_name"), F.count(F.lit(1)).alias("rows_shipped"), seen.cast("long").alias("distinct_cursors"))
        out = one if out is None else out.unionByName(one)
    return out.join(state.cursors(), "view_name", "left").select(
        "view_name", "rows_shipped", F.coalesce("cursor", F.lit(0).cast("long")).alias("cursor"), "distinct_cursors")

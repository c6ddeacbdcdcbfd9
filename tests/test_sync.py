"""Cursor paging, normalisation, chunking and state semantics."""

import datetime as dt

from pyspark.sql import functions as F

import pytest

from ledgerflow.streaming.state import BatchSink, SyncState
from ledgerflow.streaming.sync import (chunk_envelopes, chunked_rows, cursor_page, cursor_page_tie_safe, due_now, effective_mode,
                                       heartbeat_gaps_df, heartbeat_sessions_df, normalize_records,
                                       resolve_cursor_column, run_sync_cycle, to_payload)


def _tied(spark, n=23):
    # cursor values with ties: 0,0,0,3,3,3,...
    return spark.range(n).select(F.col("id").alias("event_id"), (F.col("id") - F.col("id") % 3).alias("cbmarq"))


def test_cursor_column_discovery(spark):
    a = spark.createDataFrame([(1, 2)], "Watermark_Sync long, cbMarq long")
    b = spark.createDataFrame([(1,)], "cbMarq long")
    c = spark.createDataFrame([(1,)], "x long")
    assert resolve_cursor_column(a) == "Watermark_Sync" and resolve_cursor_column(b) == "cbMarq"
    assert resolve_cursor_column(c) is None
    assert effective_mode(c, "INCREMENTAL") == "FULL" and effective_mode(b, "INCREMENTAL") == "INCREMENTAL"
    assert cursor_page(c, 0).count() == 1            # FULL mode reads everything


def test_plain_page_loses_tie_rows_tie_safe_does_not(spark):
    df = _tied(spark)
    plain = cursor_page(df, -1, size=4)
    assert plain.count() == 4
    nxt = cursor_page(df, plain.agg(F.max("cbmarq")).first()[0], size=4)
    assert 4 not in {r["event_id"] for r in nxt.union(plain).collect()}     # lost at the border
    safe = cursor_page_tie_safe(df, -1, size=4)
    assert {r["event_id"] for r in safe.collect()} == {0, 1, 2, 3, 4, 5}


def test_tie_safe_paging_covers_everything(spark):
    df = _tied(spark, 50)
    seen, cursor = [], -1
    while True:
        page = cursor_page_tie_safe(df, cursor, size=7).collect()
        if not page:                                     # empty page ends the cycle
            break
        seen += [r["event_id"] for r in page]
        cursor = max(r["cbmarq"] for r in page)
    assert sorted(seen) == list(range(50))


def test_normalize_records(spark):
    df = spark.createDataFrame(
        [(dt.date(2026, 4, 10), dt.datetime(2026, 4, 10, 1, 2, 3, 456000), bytearray(b"\x01\xab"), 2 ** 60, None)],
        "d date, t timestamp_ntz, b binary, n long, s string")
    r = normalize_records(df).first()
    assert r["d"] == "2026-04-10T00:00:00.000Z" and r["t"] == "2026-04-10T01:02:03.456Z"
    assert r["b"] == "01ab" and r["n"] == 2 ** 60 and r["s"] is None


def test_chunk_envelopes(spark):
    df = spark.range(12001).withColumnRenamed("id", "cbmarq")
    for cmax in (12000, F.max("cbmarq")):
        e = sorted(chunk_envelopes(df, "V", "INCREMENTAL", 7, cmax, size=5000).collect(), key=lambda r: r["chunk_index"])
        assert [r["row_count"] for r in e] == [5000, 5000, 2001]
        assert [r["watermark_max"] for r in e] == [None, None, 12000]
        assert all(r["watermark_min"] == 7 for r in e)
    assert chunk_envelopes(df.limit(0), "V", "FULL", 0, 0).count() == 0
    rows = chunked_rows(df, [F.col("cbmarq")], size=5000)
    assert rows.filter(F.col("chunk_index") == 1).agg(F.min("cbmarq")).first()[0] == 5000
    assert rows.filter("cbmarq = 5003").first()["chunk_pos"] == 3


def test_pages_with_few_distinct_or_far_apart_cursors(spark):
    far = spark.createDataFrame([(c,) for c in [1, 2, 2, 2, 10 ** 15, 10 ** 15 + 1, 10 ** 15 + 1, 10 ** 18]], "cbmarq long")
    assert [r[0] for r in cursor_page(far, 0, size=3).collect()] == [1, 2, 2]
    assert cursor_page_tie_safe(far, 0, size=3).count() == 4 and cursor_page_tie_safe(far, 2, size=100).count() == 4
    assert cursor_page(far, 10 ** 18, size=3).count() == 0 and cursor_page_tie_safe(far, 10 ** 18, size=3).count() == 0


def test_heartbeat_sessions_and_gaps(spark):
    base = dt.datetime(2024, 1, 1)
    beats = [(1, base), (1, base + dt.timedelta(hours=5)), (1, base + dt.timedelta(hours=30)),
             (2, base), (2, base + dt.timedelta(hours=12))]                 # exactly the limit: same session
    df = spark.createDataFrame(beats, "agent_id long, ts timestamp_ntz")
    s = sorted((r["agent_id"], r["n_beats"]) for r in heartbeat_sessions_df(df).collect())
    assert s == [(1, 1), (1, 2), (2, 2)]
    g = sorted((r["agent_id"], r["gap_minutes"]) for r in heartbeat_gaps_df(df).collect())
    assert g == [(1, 25 * 60.0)]                                       # 12 h exactly is not "silent > limit"


def _tables(spark, n):
    from minitables import MiniTables, ledger_row, party
    rows = [ledger_row(i, "2001-01-10", "512000", "C1", "10.00") for i in range(1, n + 1)]
    return MiniTables(spark, rows, [party("C1", "x")])


def test_sync_cycle_isolates_failures(spark, scratch):
    state = SyncState(spark, f"{scratch}/state")
    sink = BatchSink(spark, f"{scratch}/sink", state)
    state.set("VW_TRESORERIE", 3)
    # the stock views need article tables that MiniTables does not have: they fail, the others go on
    res, err = run_sync_cycle(_tables(spark, 7), "2001-07-15", state, sink, ["VW_TRESORERIE", "VW_STOCKS", "VW_GRAND_LIVRE_GENERAL"])
    assert set(err) == {"VW_STOCKS"} and set(res) == {"VW_TRESORERIE", "VW_GRAND_LIVRE_GENERAL"}
    assert res["VW_TRESORERIE"] == {"rows": 4, "cursor": 7, "mode": "INCREMENTAL"}
    assert res["VW_GRAND_LIVRE_GENERAL"]["rows"] == 7 == sink.read("VW_GRAND_LIVRE_GENERAL").count()
    assert {r["view_name"]: r["total_rows"] for r in state.snapshot().collect()} == {"VW_TRESORERIE": 4, "VW_GRAND_LIVRE_GENERAL": 7}
    # nothing new: the next cycle ships no row and keeps the cursor
    res, _ = run_sync_cycle(_tables(spark, 7), "2001-07-15", state, sink, ["VW_TRESORERIE"])
    assert res["VW_TRESORERIE"] == {"rows": 0, "cursor": 7, "mode": "INCREMENTAL"}


def test_sync_cycle_loses_no_tied_rows(spark, scratch, monkeypatch):
    from ledgerflow.plans import views
    # groups of three equal cursors; the page's border falls inside one, the view is larger than a page
    frame = spark.range(40).select(F.col("id"), (F.col("id") - F.col("id") % 3 + 1).alias("watermark_sync"))
    monkeypatch.setattr(views, "view", lambda t, as_of, name: frame)
    for size in (None, 7):
        state = SyncState(spark, f"{scratch}/state{size}")
        sink = BatchSink(spark, f"{scratch}/sink{size}", state)
        res, err = run_sync_cycle(None, "", state, sink, ["VW_STOCKS"], page_size=size)
        assert not err and res["VW_STOCKS"] == {"rows": 40, "cursor": 40, "mode": "INCREMENTAL"}
        assert sorted(r["id"] for r in sink.read("VW_STOCKS").select("id").collect()) == list(range(40))


def _cycle_frame(spark, monkeypatch, cursor=True):
    from ledgerflow.plans import views
    frame = spark.range(40).select(F.col("id"), *([(F.col("id") - F.col("id") % 3 + 1).alias("watermark_sync")] if cursor else []))
    monkeypatch.setattr(views, "view", lambda t, as_of, name: frame)


@pytest.mark.parametrize("size", [None, 7])
@pytest.mark.parametrize("step", ["data", "commit"])
def test_a_cycle_that_crashes_ships_each_row_once(spark, scratch, monkeypatch, step, size):
    from ledgerflow.streaming.sync import Stopped, stop_after
    _cycle_frame(spark, monkeypatch)
    for _ in range(2):  # every start reads the state anew, as a new process does
        state = SyncState(spark, f"{scratch}/state")
        with pytest.raises(Stopped):
            run_sync_cycle(None, "", state, BatchSink(spark, f"{scratch}/sink", state), ["VW_STOCKS"], page_size=size,
                           done=stop_after(step))
        if step == "data":
            assert state.history().count() == 0 and BatchSink(spark, f"{scratch}/sink", state).read("VW_STOCKS").count() == 0
        elif size is None:
            break
    state = SyncState(spark, f"{scratch}/state")
    sink = BatchSink(spark, f"{scratch}/sink", state)
    res, err = run_sync_cycle(None, "", state, sink, ["VW_STOCKS"], page_size=size)
    assert not err and state.get("VW_STOCKS") == 40 == res["VW_STOCKS"]["cursor"]
    assert sorted(r["id"] for r in sink.read("VW_STOCKS").collect()) == list(range(40))
    batches = state.history().collect()
    assert sum(r["row_count"] for r in batches) == 40 and len({r["batch_id"] for r in batches}) == len(batches)
    # ranges join without a gap, and none is empty
    ends = sorted((r["watermark_min"], r["watermark_max"]) for r in batches)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:])) and all(r["row_count"] for r in batches)


def test_a_batch_committed_twice_counts_once(spark, scratch):
    state = SyncState(spark, f"{scratch}/s")
    sink = BatchSink(spark, f"{scratch}/sink", state)
    for _ in range(2):
        attempt, n, last = sink.write("V", spark.range(1, 6).withColumnRenamed("id", "cbmarq"), "cbmarq")
        assert (n, last) == (5, 5)
        assert state.commit("V", attempt, "INCREMENTAL", 0, last, n) == "V:0:incremental:0"
    assert sink.read("V").count() == 5 and state.history().count() == 1 and state.snapshot().first()["total_rows"] == 5


def test_full_views_are_published_anew(spark, scratch, monkeypatch):
    from ledgerflow.streaming.sync import Stopped, stop_after
    _cycle_frame(spark, monkeypatch, cursor=False)
    state = SyncState(spark, f"{scratch}/state")
    sink = BatchSink(spark, f"{scratch}/sink", state)
    for n in (1, 2, 3):
        before = sink.read("VW_KPI_SYNTESE") if n > 1 else None
        if n == 2:  # data that was never committed
            with pytest.raises(Stopped):
                run_sync_cycle(None, "", state, sink, ["VW_KPI_SYNTESE"], done=stop_after("data"))
        run_sync_cycle(None, "", state, sink, ["VW_KPI_SYNTESE"])
        assert sorted(r["id"] for r in sink.read("VW_KPI_SYNTESE").collect()) == list(range(40))
        assert state.history().count() == n
        if before is not None:  # a reader that began earlier is not disturbed
            assert before.count() == 40


def test_a_reset_ships_everything_again_and_is_read_once(spark, scratch, monkeypatch):
    _cycle_frame(spark, monkeypatch)
    state = SyncState(spark, f"{scratch}/state")
    sink = BatchSink(spark, f"{scratch}/sink", state)
    run_sync_cycle(None, "", state, sink, ["VW_STOCKS"])
    state.reset()
    assert state.get("VW_STOCKS") == 0 and state.epoch("VW_STOCKS") == 1
    res, _ = run_sync_cycle(None, "", state, sink, ["VW_STOCKS"])
    assert res["VW_STOCKS"]["rows"] == 40 and sink.read("VW_STOCKS").count() == 40
    assert sorted(r["batch_id"] for r in state.history().collect()) == ["VW_STOCKS:0:incremental:0", "VW_STOCKS:1:incremental:0"]
    res, _ = run_sync_cycle(None, "", state, sink, ["VW_STOCKS"])
    assert res["VW_STOCKS"] == {"rows": 0, "cursor": 40, "mode": "INCREMENTAL"}
    assert state.history().count() == 2 and state.snapshot().first()["n_batches"] == 2


def test_failures_are_kept_and_stay_due(spark, scratch, monkeypatch):
    from ledgerflow.plans import views

    def broken(t, as_of, name):
        raise ValueError("no such table")
    monkeypatch.setattr(views, "view", broken)
    state = SyncState(spark, f"{scratch}/state")
    _, err = run_sync_cycle(None, "", state, BatchSink(spark, f"{scratch}/sink", state), ["VW_STOCKS"])
    assert set(err) == {"VW_STOCKS"} and state.errors().first()["error"] == "ValueError: no such table"
    assert due_now(state, {"VW_STOCKS": (60, "INCREMENTAL")}) == ["VW_STOCKS"]


def test_compaction_keeps_results_and_readers(spark, scratch):
    state = SyncState(spark, f"{scratch}/s")
    # as many files as a thousand cycles leave
    rows = spark.range(1000).select(F.lit("batch").alias("kind"), F.concat(F.lit("V"), F.col("id") % 7).alias("view_name"),
                                    F.col("id").alias("cursor"), F.concat(F.lit("b"), "id").alias("batch_id"), F.lit("INCREMENTAL").alias("sync_mode"),
                                    F.lit(3).alias("row_count"), F.localtimestamp().alias("received_at"))
    for _ in range(2):
        state.log.append(rows.repartition(500))
    key = lambda df: sorted(map(str, df.collect()))
    reader, history, cursors = state.history(), key(state.history()), key(state.cursors())
    assert state.log.files() > 500
    state.compact(more_than=10)
    assert state.log.files() <= 3 and state.stored_parameters.files() <= 1
    assert key(state.history()) == history == key(reader) and key(state.cursors()) == cursors
    state.set("V1", 5000)
    again = SyncState(spark, f"{scratch}/s")
    assert again.get("V1") == 5000 and again.history().count() == 1000
    # a compaction that crashed before its last step is not seen
    again.log.read().limit(3).write.parquet(f"{scratch}/s/log/data/compact-crashed")
    assert SyncState(spark, f"{scratch}/s").history().count() == 1000


def test_stored_state(spark, scratch):
    state = SyncState(spark, f"{scratch}/s")
    assert state.get("V") == 0 and state.cursors().count() == 0
    state.set("V", 5)
    state.set("W", 9)
    state.set("V", 8)
    again = SyncState(spark, f"{scratch}/s")
    assert again.get("V") == 8 and again.get("W") == 9
    again.reset()
    assert {r["view_name"]: r["cursor"] for r in state.cursors().collect()} == {"V": 0, "W": 0}
    rows = lambda *x: spark.createDataFrame(list(x), "name string, value string")
    state.insert_absent(rows(("a", "1"), ("b", "2")))
    state.insert_absent(rows(("a", "3"), ("c", "4")))
    state.upsert(rows(("b", "5")))
    assert {r["name"]: r["value"] for r in state.parameters().collect()} == {"a": "1", "b": "5", "c": "4"}


def test_due_views(spark, scratch):
    state = SyncState(spark, f"{scratch}/s")
    config = {"A": (15, "FULL"), "B": (0, "FULL")}
    assert due_now(state, config) == ["A", "B"]
    state.record("A", "b1", "FULL", 0, None, 3)
    state.record("B", "b2", "FULL", 0, None, 3)
    assert due_now(state, config) == ["B"]


def test_payload_json_per_chunk(spark):
    import json
    df = spark.range(7).select(F.col("id").alias("cbmarq"), F.when(F.col("id") % 2 == 0, F.col("id") * 2).alias("v"))
    rows = chunked_rows(df, [F.col("cbmarq")], size=3)
    env = chunk_envelopes(df, "V", "INCREMENTAL", 0, F.max("cbmarq"), size=3)
    docs = sorted((json.loads(r["payload"]) for r in to_payload(rows, env).collect()),
                  key=lambda d: d["rows"][0]["cbmarq"])
    assert [d["row_count"] for d in docs] == [3, 3, 1]
    assert [d["watermark_max"] for d in docs] == [None, None, 6]           # null is written, not left out
    assert [x for d in docs for x in d["rows"]] == [{"cbmarq": i, "v": None if i % 2 else 2 * i} for i in range(7)]


def test_adhoc_query_policy_and_cap(spark):
    from ledgerflow.plans.views import adhoc_query, adhoc_result
    t, day = _tables(spark, 29), "2001-07-15"
    assert adhoc_query(t, day, "SELECT TOP 5 * FROM VW_TRESORERIE ORDER BY ec_no").count() == 5
    assert adhoc_query(t, day, "select ec_no from VW_TRESORERIE", max_rows=7).count() == 7
    assert adhoc_query(t, day, "SELECT COUNT(*) AS n FROM (SELECT TOP 10 * FROM VW_TRESORERIE) q").first()["n"] == 10
    assert adhoc_query(t, day, "SELECT 'TOP 5' AS s, 'it''s TOP 3' AS u FROM VW_TRESORERIE").first()["s"] == "TOP 5"
    assert adhoc_query(t, day, "SELECT TOP (2) ec_no FROM VW_TRESORERIE UNION ALL SELECT TOP 3 ec_no FROM VW_TRESORERIE").count() == 5
    got = adhoc_result(t, day, "SELECT DISTINCT TOP 3 ec_no FROM VW_TRESORERIE ORDER BY ec_no;")
    assert got["columns"] == ["ec_no"] and got["row_count"] == 3 and got["rows"][0] == {"ec_no": 1} and got["duration_ms"] >= 0
    spark.range(1).createOrReplaceTempView("private_table")
    for bad in ("SELECT * FROM VW_TRESORERIE; DROP TABLE x", "SELECT COUNT(*) FROM parquet.`/root/testdata/sf0.001/customer.parquet`",
                "SELECT * FROM VW_TRESORERIE a, private_table b", "SELECT * FROM VW_TRESORERIE, parquet.`/x`", "SELECT * FROM private_table",
                "SELECT (SELECT MAX(id) FROM VW_TRESORERIE, private_table) AS m", "SELECT * FROM VW_TRESORERIE, range(5)"):
        with pytest.raises(PermissionError):
            adhoc_query(t, day, bad)


def test_registering_views_starts_no_job(spark):
    from ledgerflow.plans.views import register_views
    from ledgerflow.registry import tables
    t = tables(spark, "/root/testdata/sf0.001")
    register_views(t, "2001-07-15")          # file footers are read the first time
    sc = spark.sparkContext
    sc.setJobGroup("views", "deployment")
    done = register_views(t, "2001-07-15")
    assert len(done) == 15 and sc.statusTracker().getJobIdsForGroup("views") == []
    sc.setJobGroup("", "")
    assert len(spark.table("VW_PAIE").columns) == 16


def test_heartbeats_match_row_by_row_sessions(spark):
    import random
    rnd = random.Random(2)
    start = dt.datetime(2024, 1, 1)
    beats = [(a, start + dt.timedelta(hours=rnd.choice([0, 12, 24, rnd.uniform(0, 400)]))) for a in range(5) for _ in range(60)]
    got = sorted(tuple(r) for r in heartbeat_sessions_df(spark.createDataFrame(beats, "agent_id long, ts timestamp_ntz"))
                 .select("agent_id", "first_beat", "last_beat", "n_beats").collect())
    want = []
    for a in range(5):
        mine = sorted(t for b, t in beats if b == a)
        run = [mine[0]]
        for t in mine[1:]:
            if t - run[-1] > dt.timedelta(hours=12):
                want.append((a, run[0], run[-1], len(run)))
                run = []
            run.append(t)
        want.append((a, run[0], run[-1], len(run)))
    assert got == sorted(want)

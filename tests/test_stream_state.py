"""Streams with keyed state and the per-view queries: any split into files, any order, restarts."""

import datetime as dt
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ledgerflow.streaming.counters import JobCounters, _partial
from ledgerflow.streaming.sessions import SessionStream, slots
from ledgerflow.streaming.state import BatchSink, SyncState
from ledgerflow.streaming.sync import heartbeat_sessions_df
from ledgerflow.streaming.view_queries import ViewQueries

START = dt.datetime(2024, 1, 1)
EVENTS = "user_id long, event_id long, ts timestamp_ntz, event_type string"


def _runs(seed, n=240):
    rng = random.Random(seed)
    times = [START + dt.timedelta(minutes=rng.randint(0, 60)) for _ in range(n)]  # many equal times
    rows = [(rng.choice([1, 1, 1, 2, 3, 4]), i, t, "error" if rng.random() < 0.7 else rng.choice(["click", None])) for i, t in enumerate(times)]
    rows += [(7, 1000 + i, START + dt.timedelta(seconds=i), "error") for i in range(9)]  # never a success
    return rows + [(8, 2000, START, "click")]  # never a failure


def _counters(rows):
    out = {}
    for agent in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == agent]
        ok = [(r[2], r[1]) for r in mine if r[3] != "error"]
        bad = [(r[2], r[1]) for r in mine if r[3] == "error"]
        last = max(ok, default=None)
        out[agent] = (len(mine), len(bad), sum(last is None or b > last for b in bad), max((b[0] for b in bad), default=None),
                      last[0] if last else None)
    return out


def _files(spark, path, rows, schema, split):
    for part in split(rows):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)


SPLITS = {
    "one": lambda rows: [rows],
    "mixed": lambda rows: [rows[i::4] for i in range(4)],
    "backwards": lambda rows: [sorted(rows, key=lambda r: r[2], reverse=True)[i:i + 90] for i in range(0, len(rows), 90)],
}


@pytest.mark.parametrize("split", SPLITS)
def test_counters_do_not_depend_on_files_or_restarts(spark, scratch, split):
    rows = _runs(len(split))
    _files(spark, f"{scratch}/src", rows, EVENTS, SPLITS[split])
    job = JobCounters(spark, f"{scratch}/src", spark.read.parquet(f"{scratch}/src").schema, f"{scratch}/job")
    failed = set()

    def fail_once(batch_id):
        if batch_id not in failed:
            failed.add(batch_id)
            raise RuntimeError("stopped")

    for _ in range(20):
        try:
            job.run(fail_once)
            break
        except StreamingQueryException:
            assert failed
    got = {r["agent_id"]: tuple(r)[1:] for r in job.counters().collect()}
    assert got == _counters(rows) and len(failed) == len(SPLITS[split](rows))


class CountedState:
    """A state handle that counts the calls; values as the state server would keep them."""

    def __init__(self):
        self.calls, self.values = 0, {}

    def _state(self, name, schema):
        outer = self

        class State:
            def __getattr__(self, method):
                def call(*args):
                    outer.calls += 1
                    held = outer.values.setdefault(name, [] if name == "errors" else None)
                    if method in ("get", "keys", "getValue"):
                        return iter(held) if name == "errors" and method != "getValue" else held
                    if method in ("update", "put"):
                        outer.values[name] = args[0]
                    elif method == "appendList":
                        held.extend(args[0])
                    elif method == "clear":
                        outer.values[name] = []
                    return None
                return call
        return State()

    getValueState = getMapState = getListState = _state


def test_counters_ask_the_state_once_per_batch_and_agent():
    from ledgerflow.streaming.counters import _counters as processor
    handle, counters = CountedState(), processor()
    counters.init(handle)

    def batch(ok, errors):
        handle.calls = 0
        rows = [{"runs": len(e), "failed": len(e), "ok_at": ok, "ok_id": ok, "error_at": max(e, default=None),
                 "errors": [{"at": x, "id": x} for x in e]} for e in errors]
        return next(iter(counters.handleInputRows((1,), iter(rows), None)))["consecutive_errors"], handle.calls

    assert batch(None, [range(1, 301), range(301, 501)]) == (500, 3)
    assert batch(400, [range(501, 601)]) == (200, 5)  # some of the stored failures are passed
    assert batch(900, [range(901, 1001)]) == (100, 4)  # all of them


def test_counters_take_nulls_and_very_many_agents_per_batch(spark):
    """A null time or number comes before all others; nothing is done agent by agent."""
    rows = [(i, i, START, "error") for i in range(5000)] + [(1, None, START, "ok"), (2, 9, None, "ok"), (3, 9, None, "error"), (None, 1, START, "ok")]
    runs = spark.createDataFrame(rows, EVENTS).coalesce(1).select(
        F.col("user_id").alias("agent_id"), F.col("event_id").alias("id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"),
        (F.col("event_type") == "error").alias("failed"))
    got = {r["agent_id"]: r for r in _partial(runs).collect()}
    assert len(got) == 5001 and got[None]["runs"] == 1 and got[None]["errors"] == []
    assert [len(got[i]["errors"]) for i in (0, 1, 2, 3)] == [1, 1, 1, 2] and got[2]["ok_at"] is None and got[3]["error_at"] is not None


def test_a_hot_agents_runs_are_combined_first(spark):
    rows = [(1 if i % 3 else 2 + i, i, START + dt.timedelta(seconds=i), "error" if i % 2 else "ok") for i in range(6000)]
    runs = spark.createDataFrame(rows, EVENTS).repartition(4).select(
        F.col("user_id").alias("agent_id"), F.col("event_id").alias("id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"),
        (F.col("event_type") == "error").alias("failed"))
    hot = _partial(runs).where("agent_id = 1").collect()
    assert len(hot) == 4 and sum(r["runs"] for r in hot) == 4000
    assert sum(len(r["errors"]) for r in hot) < 40  # the failures after a task's last success only


def _beats(seed):
    rng = random.Random(seed)
    return [(rng.choice([1, 1, 2, 3]), START + dt.timedelta(hours=rng.choice([0, 12, 24, 36, rng.uniform(0, 500)]))) for _ in range(150)]


@pytest.mark.parametrize("split", ["mixed", "one"])
def test_sessions_do_not_depend_on_files(spark, scratch, split):
    rows = [(a, t, t) for a, t in _beats(4)]
    _files(spark, f"{scratch}/src", rows, "user_id long, ts timestamp_ntz, x timestamp_ntz", SPLITS[split])
    source = spark.read.parquet(f"{scratch}/src")
    job = SessionStream(spark, f"{scratch}/src", source.schema, f"{scratch}/job")
    job.run()
    want = heartbeat_sessions_df(source.withColumnRenamed("user_id", "agent_id"))
    key = lambda df: sorted(tuple(r) for r in df.select("agent_id", "first_beat", "last_beat", "session_end", "n_beats").collect())
    assert key(job.sessions()) == key(want)


def test_closed_sessions_leave_the_state(spark, scratch):
    """With a lateness the state is bounded; beats in order of time lose nothing."""
    rows = sorted({(a, t) for a, t in _beats(5)}, key=lambda r: r[1])
    for i in range(0, len(rows), 30):
        spark.createDataFrame(rows[i:i + 30], "user_id long, ts timestamp_ntz").coalesce(1).write.parquet(f"{scratch}/src/part={i:04d}")
    source = spark.read.parquet(f"{scratch}/src").select("user_id", "ts")
    job = SessionStream(spark, f"{scratch}/src/part=*", source.schema, f"{scratch}/job", lateness="2 hours")
    job.run()
    want = heartbeat_sessions_df(source.withColumnRenamed("user_id", "agent_id"))
    assert sorted((r["agent_id"], r["first_beat"], r["n_beats"]) for r in job.sessions().collect()) == \
        sorted((r["agent_id"], r["first_beat"], r["n_beats"]) for r in want.collect())
    state = spark.read.format("statestore").option("path", f"{scratch}/job/checkpoint").option("stateVarName", "sessions").load()
    assert state.count() < want.count()


def test_a_hot_agents_beats_are_combined_first(spark):
    beats = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("agent_id"), (F.col("id") * 1_000_000).alias("at"))
    hot = slots(beats.repartition(4), 12 * 3600 * 1_000_000).where("agent_id = 1").collect()
    assert len(hot) <= 8 and sum(r["n_beats"] for r in hot) == 20_000


def _views(spark, monkeypatch):
    from ledgerflow.plans import views
    frames = {"VW_STOCKS": spark.range(42).select("id", (F.col("id") - F.col("id") % 3 + 1).alias("watermark_sync")),
              "VW_KPI_SYNTESE": spark.range(3).select("id")}
    monkeypatch.setattr(views, "view", lambda t, as_of, name: frames[name])
    return frames


class _Tables:
    def __init__(self, spark):
        self.spark = spark


def test_one_failing_view_ends_its_own_query_only(spark, scratch, monkeypatch):
    frames = _views(spark, monkeypatch)
    spark.range(5).write.parquet(f"{scratch}/src")
    state = SyncState(spark, f"{scratch}/state")
    sink = BatchSink(spark, f"{scratch}/sink", state)
    job = ViewQueries(_Tables(spark), "", state, sink, f"{scratch}/src", "id long", scratch, ["VW_STOCKS", "VW_BROKEN", "VW_KPI_SYNTESE"])
    ended = job.run_available()
    assert [v for v, e in ended.items() if e] == ["VW_BROKEN"] and "KeyError" in state.errors().first()["error"]
    assert sink.read("VW_STOCKS").count() == 42 and sink.read("VW_KPI_SYNTESE").count() == 3
    # nothing arrived: no batch; the broken view is tried again, and works now
    frames["VW_BROKEN"] = spark.range(2).select("id")
    assert set(job.run_available().values()) == {None}
    assert {r["view_name"]: r["n_batches"] for r in state.snapshot().collect()} == {"VW_STOCKS": 1, "VW_KPI_SYNTESE": 1, "VW_BROKEN": 1}
    # new files: the cursor view ships what is new, the other one is published anew
    frames["VW_STOCKS"] = spark.range(50).select("id", (F.col("id") - F.col("id") % 3 + 1).alias("watermark_sync"))
    spark.range(2).write.mode("append").parquet(f"{scratch}/src")
    job.run_available()
    assert state.get("VW_STOCKS") == 49 and sink.read("VW_KPI_SYNTESE").count() == 3
    assert [r["row_count"] for r in state.history().where("view_name = 'VW_STOCKS'").orderBy("seq").collect()] == [42, 8]


@pytest.mark.parametrize("step", ["data", "commit"])
def test_a_query_that_fails_ships_each_row_once(spark, scratch, monkeypatch, step):
    _views(spark, monkeypatch)
    spark.range(5).write.parquet(f"{scratch}/src")
    state = SyncState(spark, f"{scratch}/state")
    sink = BatchSink(spark, f"{scratch}/sink", state)
    job = ViewQueries(_Tables(spark), "", state, sink, f"{scratch}/src", "id long", scratch, ["VW_STOCKS"])

    def stop(at, view):
        if at == step:
            raise RuntimeError(f"after the {at}")

    assert "after the" in job.run_available(stop)["VW_STOCKS"]
    assert job.run_available() == {"VW_STOCKS": None}
    assert sorted(r["id"] for r in sink.read("VW_STOCKS").collect()) == list(range(42))
    assert state.history().agg(F.sum("row_count")).first()[0] == 42


def test_rotated_logs_are_read_once(spark, scratch):
    import gzip
    import os

    from ledgerflow.streaming.logs import LogStream
    folder = f"{scratch}/logs"
    os.makedirs(folder)
    day = lambda n: "".join(f"2024-01-{n:02d} 10:00:{i:02d} [{'ERROR' if i % 3 else 'INFO'}] job {i} of {n}\n" for i in range(6))
    with gzip.open(f"{folder}/agent-2024-01-01.log.gz", "wt") as f:
        f.write(day(1) + "\n  at a line of a stack\n")
    with open(f"{folder}/agent-2024-01-02.log", "w") as f:
        f.write(day(2))
    stream = LogStream(spark, folder, f"{scratch}/stream")
    stream.run()
    stream.run()  # nothing arrived
    assert stream.lines().count() == 13
    with gzip.open(f"{folder}/agent-2024-02-10.log.gz", "wt") as f:
        f.write(day(3))
    again = LogStream(spark, folder, f"{scratch}/stream")
    again.run()
    got = sorted((r["day"], r["level"], r["count"]) for r in again.lines().groupBy("day", "level").count().collect())
    assert got == [("2024-01-01", "error", 4), ("2024-01-01", "info", 3), ("2024-01-02", "error", 4), ("2024-01-02", "info", 2),
                   ("2024-02-10", "error", 4), ("2024-02-10", "info", 2)]
    assert again.lines().where("timestamp = ''").first()["message"] == "  at a line of a stack"
    # retention: whole days go
    assert {r["day"] for r in again.lines("2024-02-11").select("day").distinct().collect()} == {"2024-02-10"}
    assert {r["day"] for r in again.lines("2024-01-31").select("day").distinct().collect()} == {"2024-01-02", "2024-02-10"}


def _numbered(spark, n, size):
    from ledgerflow.streaming.sync import chunked_rows
    return chunked_rows(spark.range(n).select("id", F.concat(F.lit("é"), "id").alias("label")), [F.col("id")], size=size)


def test_a_call_arrives_whole(spark, scratch):
    from ledgerflow.streaming.ingest import IngestFolder
    folder = IngestFolder(spark, f"{scratch}/in")
    call = folder.push("V", _numbered(spark, 23, 5))
    assert sorted((r["chunk_index"], r["row_count"], r["call"], r["view_name"]) for r in folder.manifest().collect()) == \
        [(i, 5 if i < 4 else 3, call, "V") for i in range(5)]
    got = folder.rows("id long, label string").orderBy("id").collect()
    assert [(r["id"], r["label"], r["chunk_index"], r["chunk_pos"]) for r in got] == [(i, f"é{i}", i // 5, i % 5) for i in range(23)]
    folder.push("V", _numbered(spark, 0, 5))
    assert folder.manifest().count() == 5


def test_a_call_that_fails_leaves_nothing(spark, scratch):
    from ledgerflow.streaming.ingest import IngestFolder
    folder = IngestFolder(spark, f"{scratch}/in")
    folder.push("V", _numbered(spark, 10, 5), "first")
    rows = _numbered(spark, 40, 5).repartition(8, "chunk_index")
    bad = rows.withColumn("id", F.when(F.col("id") == 33, F.raise_error(F.lit("task lost")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="task lost"):
        folder.push("V", bad, "second")
    assert {r["call"] for r in folder.manifest().collect()} == {"first"} and folder.rows("id long").count() == 10
    folder.push("V", rows, "second")
    assert folder.rows("id long").where("call = 'second'").count() == 40 and folder.manifest().where("call = 'second'").count() == 8

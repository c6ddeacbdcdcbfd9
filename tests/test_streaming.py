"""Structured Streaming: sync replay idempotence and heartbeat sessions."""

import datetime as dt
import os

from pyspark.sql import functions as F

from ledgerflow.streaming.stream import LedgerSync, export_source, heartbeat_session_stream
from ledgerflow.streaming.sync import heartbeat_sessions_df


def _source(spark, path, n=12000):
    df = spark.range(n).select(F.col("id").alias("cbmarq"), (F.col("id") % 7).alias("v"),
                               F.lit(dt.date(2001, 1, 1)).alias("d"))
    export_source(df, path, 3, "cbmarq")
    return spark.read.parquet(path).schema


def test_sync_stream_and_replay_are_idempotent(spark, scratch):
    schema = _source(spark, os.path.join(scratch, "src"))
    once = LedgerSync(spark, "V", os.path.join(scratch, "src"), os.path.join(scratch, "once"))
    once.run(schema)
    twice = LedgerSync(spark, "V", os.path.join(scratch, "src"), os.path.join(scratch, "twice"))
    # the query fails in every batch, before and after its state, and is started again
    assert twice.run_through(schema, [(step, b) for step in ("data", "state") for b in range(3)]) == 7
    assert once.synced().count() == twice.synced().count() == 12000
    key = ["batch_id", "watermark_min", "watermark_max", "row_count"]
    assert sorted(map(tuple, once.state().select(*key).collect())) == \
        sorted(map(tuple, twice.state().select(*key).collect()))
    st = sorted(once.state().collect(), key=lambda r: r["batch_id"])
    # each batch starts from the highest cursor stored before it (files may
    # arrive in any order; the stream checkpoint, not the cursor, guarantees
    # that every file is taken exactly once)
    assert st[0]["watermark_min"] == 0
    assert all(st[i]["watermark_min"] == max(x["watermark_max"] for x in st[:i]) for i in range(1, len(st)))
    assert max(x["watermark_max"] for x in st) == 11999
    assert once.synced().filter(F.col("d") != "2001-01-01T00:00:00.000Z").count() == 0
    # chunks of 5 000 in cursor order, one short last per batch
    chunks = once.synced().groupBy("batch_id", "chunk_index").agg(F.count(F.lit(1)).alias("n"), F.min("cbmarq").alias("lo"),
                                                                  F.max("chunk_pos").alias("p")).collect()
    sent = {(r["batch_id"], r["chunk_index"]): r["row_count"] for r in once.envelopes().collect()}
    assert {(r["batch_id"], r["chunk_index"]): r["n"] for r in chunks} == sent
    for b in {r["batch_id"] for r in chunks}:
        mine = sorted((r["chunk_index"], r["n"], r["lo"], r["p"]) for r in chunks if r["batch_id"] == b)
        assert [m[0] for m in mine] == list(range(len(mine))) and all(m[1] == 5000 for m in mine[:-1])
        assert [m[2] for m in mine] == sorted(m[2] for m in mine) and all(m[3] == m[1] - 1 for m in mine)


def test_heartbeat_stream_emits_closed_sessions(spark, scratch):
    base = dt.datetime(2024, 1, 1)
    rows = [(a, base + dt.timedelta(hours=h)) for a, h in
            [(1, 0), (1, 1), (1, 20), (2, 0), (2, 2), (2, 40), (3, 45)]]
    src = os.path.join(scratch, "beats")
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz")
    df.coalesce(1).write.parquet(src)          # one file: no beat arrives after the watermark
    out = heartbeat_session_stream(spark, src, df.schema, os.path.join(scratch, "sink"),
                                   os.path.join(scratch, "ckpt"))
    got = sorted((r["agent_id"], r["n_beats"]) for r in out.collect())
    batch = sorted((r["agent_id"], r["n_beats"], r["session_end"]) for r in
                   heartbeat_sessions_df(df.withColumnRenamed("user_id", "agent_id")).collect())
    # the stream emits only sessions closed by the watermark (max ts - 12 h)
    wm = max(r[1] for r in rows) - dt.timedelta(hours=12)
    closed = sorted((a, n) for a, n, end in batch if end <= wm)
    assert got == closed and len(got) >= 2

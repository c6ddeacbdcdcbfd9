"""I12 as a stream with arbitrary keyed state: online periods of agents, in any order of arrival.

Beats are first combined per task, agent and slot of the limit's length (two beats in one
slot are always in one session), so an agent with a large part of all beats sends a
row per task and slot, however often it beats.  An agent's state holds its sessions; a
slot joins those it touches.  Results are updates: the newest row of a session's start
counts, one with no beats takes back a session that has become part of an earlier one.

With ``lateness`` beats that come later than that are dropped, and sessions that no other
beat can reach any more leave the state (their rows stay); without it the state
keeps every session.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

from ..registry import register
from ..session import scratch_path
from .counters import ROCKSDB
from .sync import HB_SQL, HEARTBEAT_LIMIT_SECONDS

SESSIONS = "agent_id long, first long, last long, n_beats long"


def slots(beats: DataFrame, limit: int) -> DataFrame:
    """``SESSIONS`` rows of ``agent_id, at`` (microseconds): one per task's batch, agent and slot."""

    def combine(batches):
        for beats in batches:
            by = beats.groupby([beats["agent_id"].astype("Int64"), beats["at"] // limit], dropna=False)["at"].agg(["min", "max", "count"])
            yield by.reset_index(level=0).rename(columns={"min": "first", "max": "last", "count": "n_beats"})[
                ["agent_id", "first", "last", "n_beats"]]

    return beats.select("agent_id", "at").where("at IS NOT NULL").mapInPandas(combine, SESSIONS)


def _merge(limit: int, lateness: bool) -> StatefulProcessor:
    """Defined here, so that executors get the class with the query."""

    class Merge(StatefulProcessor):
        def init(self, handle) -> None:
            # a list, so that an agent's sessions are asked and stored once a batch, not one by one
            self.sessions = handle.getListState("sessions", "first long, last long, n long")

        def handleInputRows(self, key, rows, timerValues):
            from pyspark.sql import Row

            stored = {first: (last, n) for first, last, n in self.sessions.get()}
            parts = sorted([(first, last, n) for first, (last, n) in stored.items()] + [(r["first"], r["last"], r["n_beats"]) for r in rows])
            merged = {}
            start = None
            for first, last, n in parts:
                if start is None or first - merged[start][0] > limit:  # a beat exactly at the limit stays
                    start = first
                    merged[start] = (last, n)
                else:
                    merged[start] = (max(last, merged[start][0]), merged[start][1] + n)
            closed = timerValues.getCurrentWatermarkInMs() * 1000 - limit if lateness else None
            kept = {first: (last, n) for first, (last, n) in merged.items() if closed is None or last >= closed}
            if kept and kept != stored:
                self.sessions.put([(first, last, n) for first, (last, n) in kept.items()])
            elif not kept and stored:
                self.sessions.clear()
            for first in stored.keys() - merged.keys():
                yield Row(agent_id=key[0], first=first, last=first, n_beats=0)
            for first, (last, n) in merged.items():
                if stored.get(first) != (last, n):
                    yield Row(agent_id=key[0], first=first, last=last, n_beats=n)

        def close(self) -> None:
            pass

    return Merge()


class SessionStream:
    """Sessions of the beats in a folder of Parquet files."""

    def __init__(self, spark: SparkSession, source: str, schema: StructType, root: str, limit_seconds: int = HEARTBEAT_LIMIT_SECONDS,
                 lateness: str | None = None, agent: str = "user_id", ts: str = "ts", files_per_trigger: int = 1):
        self.spark, self.source, self.schema, self.root, self.files_per_trigger = spark, source, schema, root, files_per_trigger
        self.limit, self.lateness, self.agent, self.ts = limit_seconds * 1_000_000, lateness, agent, ts

    def run(self, written=lambda batch_id: None) -> None:
        """Take all files that are there; from the checkpoint if there is one."""
        beats = (self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", self.files_per_trigger).parquet(self.source)
                 .select(F.col(self.agent).alias("agent_id"), F.unix_micros(F.col(self.ts).cast("timestamp")).alias("at")))
        parts = slots(beats, self.limit)
        if self.lateness:
            parts = parts.withColumn("seen", F.timestamp_micros("last")).withWatermark("seen", self.lateness)
        merged = parts.groupBy("agent_id").transformWithState(_merge(self.limit, bool(self.lateness)), SESSIONS, "Update",
                                                              "EventTime" if self.lateness else "None")

        def sink(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{self.root}/sessions/batch_id={batch_id}")
            written(batch_id)

        store = "spark.sql.streaming.stateStore.providerClass"
        previous = self.spark.conf.get(store)
        self.spark.conf.set(store, ROCKSDB)
        try:
            (merged.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", f"{self.root}/checkpoint")
             .trigger(availableNow=True).start().awaitTermination())
        finally:
            self.spark.conf.set(store, previous)

    def sessions(self) -> DataFrame:
        """``agent_id, session_start, session_end, n_beats, first_beat, last_beat``."""
        rows = self.spark.read.schema(f"{SESSIONS}, batch_id long").parquet(f"{self.root}/sessions")
        newest = rows.groupBy("agent_id", "first").agg(F.max_by(F.struct("last", "n_beats"), "batch_id").alias("s")).where("s.n_beats > 0")
        time = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
        return newest.select("agent_id", time("first").alias("session_start"), time(F.col("s.last") + self.limit).alias("session_end"),
                             F.col("s.n_beats").alias("n_beats"), time("first").alias("first_beat"), time("s.last").alias("last_beat"))


@register("heartbeat_sessions_stream", raw=True, oracle=f"""
WITH {HB_SQL}
SELECT agent_id, min(ts) AS session_start, max(ts) + INTERVAL {HEARTBEAT_LIMIT_SECONDS} SECOND AS session_end,
    COUNT(*) AS n_beats, min(ts) AS first_beat, max(ts) AS last_beat
FROM s GROUP BY agent_id, sid
""")
def heartbeat_sessions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I12 as a stream: the beats in four files, in no order of time."""
    root = scratch_path(spark, f"sessions-{uuid.uuid4().hex}")
    beats = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "ts", "event_id")
    beats.repartition(4, F.xxhash64("event_id")).write.parquet(f"{root}/source")
    job = SessionStream(spark, f"{root}/source", beats.schema, root)
    job.run()
    return job.sessions()

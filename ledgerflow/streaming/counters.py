"""I13 as a stream: job counters per agent in arbitrary keyed state.

Counters do not depend on how runs are split into files, nor on the order in which
they arrive.  ``consecutive_errors`` counts the failures after an agent's last success,
so the state keeps the failures that no success has passed yet, one entry each,
beside the totals; a success that arrives later removes those it passes.

Runs are first combined per task and agent, so of an agent with a large part
of all runs one row a task reaches its state, with the failures after the task's
last success for that agent.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

from ..registry import register
from ..session import scratch_path
from .sync import JOB_STATS_SQL

PARTIAL = ("agent_id long, runs long, failed long, ok_at long, ok_id long, error_at long, "
           "errors array<struct<at:long,id:long>>")
COUNTERS = "agent_id long, runs long, failed long, consecutive_errors long, last_error_at long, last_success_at long"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Stands for a time or number that is null: before all others.
NONE = -(1 << 63)


def _partial(runs: DataFrame) -> DataFrame:
    """``PARTIAL`` rows of ``agent_id, id, at, failed``: one per task's batch and agent."""

    def combine(batches):
        import numpy as np
        import pandas as pd

        for runs in batches:
            code, agents = pd.factorize(runs["agent_id"].astype("Int64"), use_na_sentinel=False)
            at, number, bad = (runs[c].to_numpy() for c in ("at", "id", "failed"))
            order = np.lexsort((number, at, code))
            ok, errors = order[~bad[order] & (at[order] != NONE)], order[bad[order]]
            ok_at, ok_id, error_at = (np.full(len(agents), NONE) for _ in range(3))
            # in order of time: of an agent's values the last one stays
            ok_at[code[ok]], ok_id[code[ok]], error_at[code[errors]] = at[ok], number[ok], at[errors]
            a, i, last_at, last_id = at[errors], number[errors], ok_at[code[errors]], ok_id[code[errors]]
            errors = errors[(last_at == NONE) | (a > last_at) | ((a == last_at) & (i > last_id))]
            entries = [{"at": x, "id": y} for x, y in zip(at[errors].tolist(), number[errors].tolist())]
            ends = np.searchsorted(code[errors], np.arange(len(agents) + 1))
            known = lambda v, on: pd.Series(v).astype("Int64").where(on != NONE)
            yield pd.DataFrame({
                "agent_id": agents, "runs": np.bincount(code, minlength=len(agents)), "failed": np.bincount(code[bad], minlength=len(agents)),
                "ok_at": known(ok_at, ok_at), "ok_id": known(ok_id, ok_at), "error_at": known(error_at, error_at),
                "errors": [entries[x:y] for x, y in zip(ends[:-1], ends[1:])]})

    rows = runs.select("agent_id", *[F.coalesce(F.col(c), F.lit(NONE)).alias(c) for c in ("id", "at")], "failed")
    return rows.mapInPandas(combine, PARTIAL)


def _counters() -> StatefulProcessor:
    """Defined here, so that executors get the class with the query."""

    class Counters(StatefulProcessor):
        def init(self, handle) -> None:
            self.totals = handle.getValueState("totals", "runs long, failed long, ok_at long, ok_id long, error_at long, open long")
            self.errors = handle.getListState("errors", "at long, id long")

        def handleInputRows(self, key, rows, timerValues):
            from pyspark.sql import Row

            runs, failed, ok_at, ok_id, error_at, still_open = self.totals.get() or (0, 0, None, None, None, 0)
            before, stored_to, new = (ok_at, ok_id), error_at, []
            for r in rows:
                runs, failed = runs + r["runs"], failed + r["failed"]
                if r["ok_at"] is not None and (ok_at is None or (r["ok_at"], r["ok_id"]) > (ok_at, ok_id)):
                    ok_at, ok_id = r["ok_at"], r["ok_id"]
                if r["error_at"] is not None:
                    error_at = max(r["error_at"], r["error_at"] if error_at is None else error_at)
                new.extend((e["at"], e["id"]) for e in r["errors"])
            # the state is asked once per batch and agent, and for its failures only if a success may have passed some
            if still_open and (ok_at, ok_id) != before:
                all_passed = stored_to is None or stored_to < ok_at
                kept = [] if all_passed else [(e[0], e[1]) for e in self.errors.get() if (e[0], e[1]) > (ok_at, ok_id)]
                still_open = len(kept)
                if kept:
                    self.errors.put(kept)
                else:
                    self.errors.clear()
            if ok_at is not None:
                new = [e for e in new if e > (ok_at, ok_id)]
            if new:
                self.errors.appendList(new)
                still_open += len(new)
            self.totals.update((runs, failed, ok_at, ok_id, error_at, still_open))
            yield Row(agent_id=key[0], runs=runs, failed=failed, consecutive_errors=still_open, last_error_at=error_at, last_success_at=ok_at)

        def close(self) -> None:
            pass

    return Counters()


class JobCounters:
    """Counters of the runs in a folder of Parquet files (``user_id, event_id, ts, event_type``)."""

    def __init__(self, spark: SparkSession, source: str, schema: StructType, root: str, files_per_trigger: int = 1):
        self.spark, self.source, self.schema, self.root, self.files_per_trigger = spark, source, schema, root, files_per_trigger

    def run(self, written=lambda batch_id: None) -> None:
        """Take all files that are there; from the checkpoint if there is one.  ``written`` is
        called once a batch's counters are written; what it raises ends the query."""
        runs = (self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", self.files_per_trigger).parquet(self.source)
                .select(F.col("user_id").alias("agent_id"), F.col("event_id").alias("id"),
                        F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), F.coalesce(F.col("event_type") == "error", F.lit(False)).alias("failed")))
        counted = _partial(runs).groupBy("agent_id").transformWithState(_counters(), COUNTERS, "Update", "None")

        def sink(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{self.root}/counters/batch_id={batch_id}")
            written(batch_id)

        store, previous = "spark.sql.streaming.stateStore.providerClass", None
        previous = self.spark.conf.get(store)
        self.spark.conf.set(store, ROCKSDB)
        try:
            query = (counted.writeStream.outputMode("update").foreachBatch(sink)
                     .option("checkpointLocation", f"{self.root}/checkpoint").trigger(availableNow=True).start())
            query.awaitTermination()
        finally:
            self.spark.conf.set(store, previous)

    def counters(self) -> DataFrame:
        """The newest counters of every agent."""
        rows = self.spark.read.schema(f"{COUNTERS}, batch_id long").parquet(f"{self.root}/counters")
        values = [c for c in rows.columns if c not in ("agent_id", "batch_id")]
        newest = rows.groupBy("agent_id").agg(F.max_by(F.struct(*values), "batch_id").alias("c")).select("agent_id", "c.*")
        return newest.withColumns({c: F.timestamp_micros(c).cast("timestamp_ntz") for c in ("last_error_at", "last_success_at")})


@register("job_stats_stream", JOB_STATS_SQL, raw=True)
def job_stats_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I13 as a stream: the event log in four files, in no order of time; the query is ended after its second
    batch and started again."""
    from pyspark.errors import StreamingQueryException

    root = scratch_path(spark, f"job-counters-{uuid.uuid4().hex}")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_id", "ts", "event_type")
    events.repartition(4, F.xxhash64("event_id")).write.parquet(f"{root}/source")
    job = JobCounters(spark, f"{root}/source", events.schema, root)

    def stop(batch_id: int) -> None:
        if batch_id == 1:
            raise RuntimeError("ends after its counters are written")

    try:
        job.run(stop)
    except StreamingQueryException:
        job.run()
    return job.counters()

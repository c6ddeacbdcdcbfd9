"""Structured Streaming forms of the sync (I10, I5 replay) and of the
heartbeat monitor (I12).

I10: the source table arrives as Parquet files; each micro-batch is turned
into the rows of a view, goes through record normalisation (I3), is written
in cursor order under its batch id with overwrite (a replayed batch rewrites
the same folder) and is cut into chunks of 5 000 with one short last (I4);
then one state row per batch is written the same way.  The streaming
checkpoint is the commit protocol: it replaces the persisted cursor for
append-only sources, and readers never see a batch twice.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..registry import register
from ..session import scratch_path
from .sync import NORMALIZED_LEDGER_SQL, PAGE_SIZE, normalize_records, resolve_cursor_column


#: Codec of the files written here: source and sink hold the whole ledger, which is most of a sync's disk.
COMPRESSION = "zstd"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffle_files_go(spark: SparkSession):
    """A query's shuffle files are removed as it ends, not whenever the driver happens to collect its
    garbage: else those of all batches lie there together."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


#: Called with the step ("data", "state") that is written, and the batch.
BatchStep = Callable[[str, int], None]


class LedgerSync:
    """One view synced from a folder of Parquet files to a sink folder.

    ``view`` makes the view's rows from a batch of source rows (a
    row-preserving view: joins on unique keys, no window) and keeps their
    column ``__mid``, the place in the batch."""

    def __init__(self, spark: SparkSession, view_name: str, source_dir: str, root: str,
                 files_per_trigger: int = 1, schema_version: str = "unknown",
                 view: Callable[[DataFrame], DataFrame] | None = None, own_source: bool = False):
        self.spark = spark
        self.view_name = view_name
        self.source_dir = source_dir
        self.sink_dir = f"{root}/sink"
        self.state_dir = f"{root}/state"
        self.checkpoint_dir = f"{root}/checkpoint"
        self.files_per_trigger = files_per_trigger
        self.schema_version = schema_version
        self.view = view or (lambda batch: batch)
        self.own_source = own_source  # a copy made for this sync: its files go once their batch is committed

    def _previous_cursor(self, batch_id: int) -> int:
        """The cursor stored with the batch before this one; a failed read is an error."""
        if batch_id == 0:
            return 0
        return self.spark.read.parquet(f"{self.state_dir}/batch_id={batch_id - 1}").first()["cursor"]

    def process_batch(self, batch: DataFrame, batch_id: int, done: BatchStep = lambda step, batch_id: None) -> None:
        """foreachBatch body; running it again for the same id changes nothing."""
        col = resolve_cursor_column(batch)
        before = self._previous_cursor(batch_id)
        part = f"batch_id={batch_id}"
        # the source rows are put in order, before the view makes them wide
        if col:
            batch = batch.repartitionByRange(F.col(col)).sortWithinPartitions(col)
        # the place inside the batch, up to an offset per partition
        rows = normalize_records(self.view(batch.withColumn("__mid", F.monotonically_increasing_id())))
        col = resolve_cursor_column(rows)
        rows.write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{self.sink_dir}/{part}")
        done("data", batch_id)
        written = self.spark.read.schema(rows.schema).parquet(f"{self.sink_dir}/{part}")
        # one row per partition, and the batch's count and last cursor with it
        parts = written.groupBy(F.shiftright("__mid", 33).alias("part")).agg(
            F.count(F.lit(1)).alias("n"), (F.max(col) if col else F.lit(0)).cast("long").alias("c"))
        state = parts.agg(F.sum("n").alias("row_count"), F.max("c").alias("watermark_max"),
                          F.collect_list(F.struct("part", "n")).alias("parts"))
        state.select(
            F.lit(self.view_name).alias("view_name"), F.lit("INCREMENTAL" if col else "FULL").alias("sync_mode"),
            F.lit(before).cast("long").alias("watermark_min"), "watermark_max", F.coalesce("row_count", F.lit(0)).alias("row_count"),
            # the cursor is stored after the data, and only moves up
            F.greatest(F.lit(before).cast("long"), F.coalesce("watermark_max", F.lit(0))).alias("cursor"),
            "parts").coalesce(1).write.mode("overwrite").parquet(f"{self.state_dir}/{part}")
        done("state", batch_id)

    def run(self, schema, done: BatchStep = lambda step, batch_id: None) -> None:
        """Run the stream from its checkpoint to the end of the available files.

        ``done`` is called with "data" or "state" and the batch once that is written; what it
        raises ends the query, and the next ``run`` begins with the batch that was in flight."""
        stream = (self.spark.readStream.schema(schema).option("maxFilesPerTrigger", self.files_per_trigger)
                  .option("cleanSource", "delete" if self.own_source else "off").parquet(self.source_dir))
        with shuffle_files_go(self.spark):
            q = (stream.writeStream.foreachBatch(lambda batch, batch_id: self.process_batch(batch, batch_id, done))
                 .option("checkpointLocation", self.checkpoint_dir)
                 .trigger(availableNow=True).start())
            q.awaitTermination()

    def run_through(self, schema, failures: list[tuple[str, int]]) -> int:
        """``run`` until it ends by itself, where the query fails once after each of the
        ``failures`` (step, batch) and is started again; the number of starts."""
        left, starts = set(failures), 0

        def fail(step: str, batch_id: int) -> None:
            if (step, batch_id) in left:
                left.discard((step, batch_id))
                raise RuntimeError(f"batch {batch_id} ends after its {step}")

        while True:
            starts, before = starts + 1, len(left)
            try:
                self.run(schema, fail)
                return starts
            except StreamingQueryException:
                if len(left) == before:
                    raise

    def state(self) -> DataFrame:
        return self.spark.read.parquet(self.state_dir)

    def synced(self) -> DataFrame:
        """All rows with ``batch_id``, ``chunk_index`` and ``chunk_pos`` (chunks of ``PAGE_SIZE``, in cursor order)."""
        w = Window.partitionBy("batch_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = self.state().select("batch_id", F.explode("parts").alias("p")).select(
            F.col("batch_id").alias("__b"), F.col("p.part").alias("part"), F.col("p.n").alias("n"), F.col("batch_id"))
        offsets = offsets.select("__b", F.col("part").alias("__part"), F.coalesce(F.sum("n").over(w), F.lit(0)).alias("__off"))
        rows = self.spark.read.parquet(self.sink_dir)
        # a row per partition of a batch: broadcast, so that the records stay where they are
        offsets = F.broadcast(offsets)
        at = F.col("__off") + F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))
        joined = rows.join(offsets, (rows["batch_id"] == offsets["__b"]) & (F.shiftright("__mid", 33) == F.col("__part")))
        return joined.withColumns({"chunk_index": F.floor(at / PAGE_SIZE), "chunk_pos": at % PAGE_SIZE}).drop(
            "__mid", "__b", "__part", "__off")

    def envelopes(self) -> DataFrame:
        """One row per chunk of every batch; the batch's last cursor on its last chunk only."""
        last = F.floor((F.col("row_count") - 1) / PAGE_SIZE)
        return self.state().filter("row_count > 0").withColumn(
            "chunk_index", F.explode(F.sequence(F.lit(0).cast("long"), last))).select(
            "batch_id", "view_name", "sync_mode", "chunk_index", "watermark_min",
            F.when(F.col("chunk_index") == last, F.col("watermark_max")).alias("watermark_max"),
            F.least(F.lit(PAGE_SIZE).cast("long"), F.col("row_count") - F.col("chunk_index") * PAGE_SIZE).alias("row_count"),
            F.lit(self.schema_version).alias("schema_version"))


def export_source(df: DataFrame, path: str, files: int, cursor_col: str) -> None:
    """Write a table as ``files`` Parquet files, each holding one cursor
    range, so a file-by-file stream progresses in cursor order."""
    df.repartitionByRange(files, F.col(cursor_col)).sortWithinPartitions(cursor_col) \
      .write.mode("overwrite").parquet(path)


def _sync_root(spark: SparkSession, tag: str) -> str:
    # a fresh folder under the shared checkpoint folder for every run
    return scratch_path(spark, f"{tag}-{uuid.uuid4().hex}")


def _ledger_sync(spark: SparkSession, sf_dir: str, tag: str, batches: int) -> tuple[LedgerSync, DataFrame]:
    """A sync of the general-ledger view from a folder of ledger files.

    A stored ledger (materialised ERP tables) is streamed as it is;
    otherwise the derived ledger is first exported as files of cursor ranges."""
    from ..plans.ledger import general_ledger
    from ..registry import tables
    from ..sources.adapter import AS_OF
    t = tables(spark, sf_dir)
    root = _sync_root(spark, tag)
    if t.stored_dir:
        src = f"{t.stored_dir}/f_ecriturec"
    else:
        src = f"{root}/source"
        # files of a task's size, several to a batch
        files = max(batches, int(spark.conf.get("spark.sql.shuffle.partitions")))
        with shuffle_files_go(spark):
            t.ledger_by_cursor(files).write.option("compression", COMPRESSION).parquet(src)
    source = spark.read.parquet(src)
    files = -(-len(source.inputFiles()) // batches)
    return LedgerSync(spark, "VW_GRAND_LIVRE_GENERAL", src, root, files_per_trigger=max(1, files),
                      view=lambda batch: general_ledger(t, AS_OF, ledger=batch, keep=("__mid",)), own_source=not t.stored_dir), source


@register("stream_ledger_sync", oracle=NORMALIZED_LEDGER_SQL, raw=True)
def stream_ledger_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source files -> general-ledger view -> normalised records -> chunks -> sink -> cursor,
    in about 8 micro-batches; the records as the sink holds them."""
    job, source = _ledger_sync(spark, sf_dir, "ledger-sync", 8)
    job.run(source.schema)
    return job.synced().drop("batch_id", "chunk_index", "chunk_pos")


@register("stream_watermark_replay", raw=True, oracle="""
SELECT count(*) AS rows_synced, 0::BIGINT AS duplicates, max(cbmarq) AS cursor, true AS state_follows_batches FROM f_ecriturec
""")
def stream_watermark_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sync whose query fails between a batch's data and its state, and in a later batch after its state,
    and is restarted from its checkpoint each time: rows, duplicates and the final cursor equal a single delivery."""
    job, source = _ledger_sync(spark, sf_dir, "ledger-replay", 4)
    last = -(-len(source.inputFiles()) // job.files_per_trigger) - 1
    job.run_through(source.schema, [("data", 0), ("state", last)])
    rows = job.synced().agg(F.count(F.lit(1)).alias("rows_synced"),
                            (F.count(F.lit(1)) - F.count_distinct("id_ecriture")).alias("duplicates"))
    state = job.state().agg(F.max("cursor").alias("cursor"),
                            (F.max_by("cursor", "batch_id") == F.max("watermark_max")).alias("state_follows_batches"))
    return rows.select("rows_synced", "duplicates", state.select("cursor").scalar().alias("cursor"),
                       state.select("state_follows_batches").scalar().alias("state_follows_batches"))


def heartbeat_session_stream(spark: SparkSession, source_dir: str, schema, sink_dir: str, checkpoint_dir: str,
                             limit: str = "12 hours", agent: str = "user_id", ts: str = "ts"):
    """I12 as a stream: sessions of beats per agent; with the event-time
    watermark a session is emitted once it is closed (the agent went silent
    for ``limit``); beats later than the watermark are dropped."""
    beats = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source_dir)
    # event-time watermarks need TIMESTAMP (session time zone is UTC)
    beats = beats.withColumn(ts, F.col(ts).cast("timestamp"))
    sessions = (beats.withWatermark(ts, limit)
                .groupBy(F.col(agent).alias("agent_id"), F.session_window(F.col(ts), limit).alias("s"))
                .agg(F.count(F.lit(1)).alias("n_beats"))
                .select("agent_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                        "n_beats"))
    q = (sessions.writeStream.outputMode("append").format("parquet").option("path", sink_dir)
         .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink_dir)


@register("ledger_source", """
SELECT ec_no, ec_piece, ec_date, cg_num, ct_num, jo_num, ec_intitule, CAST(ec_montant AS DOUBLE) AS ec_montant,
    CAST(ec_sens AS INTEGER) AS ec_sens, ec_lettrage, ec_refpiece, ec_echeance, cbcreateur, cbcreation, cbmodification,
    cbmarq
FROM f_ecriturec
""")
def ledger_source(t, as_of: str) -> DataFrame:
    """S1 + adapter: the ledger table derived from the driver tables."""
    ec = t.f_ecriturec
    return ec.withColumns({"ec_montant": ec["ec_montant"].cast("double"), "ec_sens": ec["ec_sens"].cast("int")})

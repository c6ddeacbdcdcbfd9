"""Exact deduplication as a stateful stream with disk-backed keyed state.

The state holds, per content digest and without expiry, the stable identifier
of the row that stays, the locator of its content (file and row number within
the intake) and the number of copies.  It is a streaming aggregation in the
RocksDB state store, so it survives restarts and is not bounded by memory;
copies are combined before they are shuffled, so a hot group costs each task
one row.  Every hit (a digest seen more than once) is checked on its full
bytes against the row that stays; rows that only share a digest are grouped by
their bytes instead.

Only DataFrame and SQL operations run here.

Null texts count as empty.  Of equal texts the row with the largest ``doc_id``
stays (a null identifier is smaller than any); among repeated rows with that
identifier one stays.  Tables without rows give no rows.  Other columns,
whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .textops import scratch, stored

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SHA256: Callable[[Column], Column] = lambda text: F.sha2(text, 256)
STATE = [("digest", "string"), ("keep", "struct<doc_id:bigint,row:bigint,file:string>"), ("group_size", "bigint"),
         ("batch", "bigint")]


def state_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` whose streams keep their state in RocksDB."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # files grow as they fill: with many state partitions reserved blocks would be most of the disk used
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", "256")
    # state rows are narrow: an eighth of the partitions that texts need, and as many fewer small files a batch
    own.conf.set("spark.sql.shuffle.partitions", str(max(4, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)))
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return own


def intake(docs: DataFrame, digest: Callable[[Column], Column] = SHA256) -> DataFrame:
    """``doc_id, row, file, digest`` of every row: what the stream reads instead of the texts."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       F.input_file_name().alias("file"), digest(F.coalesce("text", F.lit(""))).alias("digest"))


def dedup_stream(headers: DataFrame, state: str, checkpoint: str):
    """Start a stream over ``headers`` (as of ``intake``) that runs until its input is
    used up; every batch appends the digests it changed to the folder ``state``.

    Starting it again with the same folders takes up new files only.
    """
    changed = headers.groupBy("digest").agg(
        F.max(F.struct("doc_id", "row", "file")).alias("keep"), F.count(F.lit(1)).alias("group_size"))

    def write(batch: DataFrame, number: int) -> None:
        # a batch that is repeated after a failure replaces its own folder
        batch.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{state}/batch={number}")

    return (changed.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .foreachBatch(write).trigger(availableNow=True).start())


def latest_state(spark: SparkSession, state: str) -> DataFrame:
    """``digest, keep, group_size``: the last version of every digest."""
    rows = spark.read.schema(", ".join(f"{name} {kind}" for name, kind in STATE)).parquet(f"{state}/batch=*")
    last = rows.groupBy("digest").agg(F.max(F.struct("batch", "keep", "group_size")).alias("s"))
    return last.select("digest", "s.keep", "s.group_size")


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = SHA256, files_per_batch: int = 32) -> DataFrame:
    """``doc_id, row, digest, keep_id, group_size, kept`` of every row of ``docs``.

    ``digest`` may be any function of a text column; equality is decided on
    the bytes.  ``files_per_batch`` intake files make one micro-batch.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "dedup")
    intake(docs, digest).write.parquet(f"{folder}/intake")
    own = state_session(spark)
    headers = spark.read.parquet(f"{folder}/intake")
    stream = own.readStream.schema(headers.schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{folder}/intake")
    spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in STATE]).write.parquet(
        f"{folder}/state/batch=-1")  # an intake without rows makes no batch
    dedup_stream(stream, f"{folder}/state", f"{folder}/stream").awaitTermination()
    state = stored(latest_state(spark, f"{folder}/state"), "dedup-state")

    # full bytes of every hit against those of the row that stays
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("digest", digest(F.col("text")))
    hits = stored(texts.join(state.where("group_size > 1").select("digest", F.col("keep.doc_id").alias("keep_id")), "digest"),
                  "dedup-hits")
    # (written, so that the join has its own exchange and a text with very many copies can be split)
    stays = stored(hits.where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
                   .groupBy("digest").agg(F.min("text").alias("keep_text")), "dedup-stays")
    shared = stored(hits.join(stays, "digest").where(F.col("text") != F.col("keep_text")).select("digest"), "dedup-shared")

    grouped = headers.join(state, "digest").select(
        "doc_id", "row", "digest", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"))
    if shared.isEmpty():
        return grouped
    # texts that only share a digest: one group per (digest, bytes), the row number decides among repeated rows
    numbered = stored(hits.join(shared, "digest", "left_semi").select("doc_id", "digest", "text")
                      .withColumn("row", F.monotonically_increasing_id()), "dedup-differ")
    groups = numbered.groupBy("digest", "text").agg(F.max(F.struct("doc_id", "row")).alias("keep"),
                                                    F.count(F.lit(1)).alias("group_size"))
    apart = numbered.join(groups, ["digest", "text"]).select(
        "doc_id", "row", "digest", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"))
    return grouped.join(shared, "digest", "left_anti").select(apart.columns).unionByName(apart)


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns unchanged.

    The row that stays is chosen by ``exact_dedup``; repeated rows (same
    identifier and text) leave one.
    """
    ids = exact_dedup(docs).where("kept").select(F.col("doc_id").alias("id"), "digest")
    keyed = docs.select(F.struct("*").alias("r"), F.col("doc_id").cast("long").alias("d"),
                        SHA256(F.coalesce("text", F.lit(""))).alias("h"))
    stay = keyed.join(ids, F.col("d").eqNullSafe(F.col("id")) & (F.col("h") == F.col("digest")), "left_semi")
    if not docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").isEmpty():
        stay = stay.dropDuplicates(["d", "h"])
    return stay.select("r.*")

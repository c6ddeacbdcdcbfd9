"""What a streaming sync leaves on disk while it runs."""

import glob
import os

from test_wide_numbers import LINES, _write

from ledgerflow.streaming.stream import SHUFFLE_CLEANUP, LedgerSync


def test_ledger_by_cursor_is_the_ledger_in_ranges(spark, scratch):
    from pyspark.sql import functions as F

    from ledgerflow.sources.adapter import ErpTables
    _write(spark, scratch, LINES + [(None, 5, 6), (1, 6, 6)])
    t = ErpTables(spark, str(scratch))
    dealt = t.ledger_by_cursor(5)
    assert dealt.columns == t.f_ecriturec.columns and dealt.count() == t.f_ecriturec.count() and dealt.exceptAll(t.f_ecriturec).isEmpty()
    ends = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min("cbmarq").alias("lo"), F.max("cbmarq").alias("hi")).dropna().orderBy("lo").collect()
    assert len(ends) > 1 and all(a["hi"] < b["lo"] for a, b in zip(ends, ends[1:]))


def _sync(spark, scratch, own):
    src = f"{scratch}/source"
    spark.range(0, 4000, 1, 4).selectExpr("id + 1 as cbmarq", "id % 7 as k").write.parquet(src)
    return src, LedgerSync(spark, "V", src, f"{scratch}/sync", own_source=own)


def test_own_source_files_go_after_their_batch_only(spark, scratch):
    src, job = _sync(spark, scratch, own=True)
    source = spark.read.parquet(src)
    starts = job.run_through(source.schema, [("data", 0), ("state", 3)])
    left = glob.glob(f"{src}/*.parquet")
    got = job.synced().select("cbmarq").collect()
    assert starts == 3 and sorted(r["cbmarq"] for r in got) == list(range(1, 4001))
    assert len(left) < 4


def test_a_given_source_stays(spark, scratch):
    src, job = _sync(spark, scratch, own=False)
    job.run(spark.read.parquet(src).schema)
    assert len(glob.glob(f"{src}/*.parquet")) == 4 and job.synced().count() == 4000


def _shuffle_files(spark):
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {os.path.basename(f) for d in local for f in glob.glob(f"{d.getPath()}/*/shuffle_*")}


def test_batches_leave_no_shuffle_files(spark, scratch):
    src, job = _sync(spark, scratch, own=False)
    schema, before = spark.read.parquet(src).schema, _shuffle_files(spark)
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None
    during = []
    job.run(schema, lambda step, batch: during.append(len(_shuffle_files(spark) - before)))
    # without the removal half of the steps see six files, the others three
    assert len(during) == 8 and sum(during) <= 12 and len(_shuffle_files(spark) - before) < 6
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None

import hashlib
from collections import defaultdict

from llm_cases import awkward_rows, prose, table
from pyspark.sql import functions as F

from ledgerflow.llm.dedup import dedup_stream, exact_dedup, intake, latest_state, state_session, without_copies


def _check(rows, got):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    assert len(got) == len(rows)
    seen = defaultdict(list)
    for r in got:
        seen[r["digest"]].append(r)
    by = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    assert set(seen) == set(by)
    low = lambda ids: max((i for i in ids if i is not None), default=None)
    for d, members in seen.items():
        assert {r["keep_id"] for r in members} == {low(by[d])}
        assert {r["group_size"] for r in members} == {len(by[d])}
        kept = [r for r in members if r["kept"]]
        assert len(kept) == 1 and kept[0]["doc_id"] == low(by[d])


def test_awkward_rows(spark):
    _check(awkward_rows(), exact_dedup(table(spark, awkward_rows(), clashes=True)).collect())
    assert exact_dedup(table(spark, awkward_rows()).limit(0)).count() == 0


def test_several_batches_and_a_hot_group(spark):
    rows = [(i, prose(0 if i % 3 == 0 else i % 40 + 1, 30), "en", "s", 0) for i in range(300)]
    _check(rows, exact_dedup(table(spark, rows).repartition(7), files_per_batch=2).collect())


def test_texts_that_share_a_digest_are_told_apart(spark):
    weak = lambda text: F.length(text).cast("string")
    rows = [(1, "aa", None, None, 0), (2, "bb", None, None, 0), (3, "aa", None, None, 0), (4, "c", None, None, 0),
            (5, "bb", None, None, 0), (6, "dddd", None, None, 0), (7, "dddd", None, None, 0)]
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup(table(spark, rows), digest=weak).collect()}
    assert got == {1: (3, 2, False), 3: (3, 2, True), 2: (5, 2, False), 5: (5, 2, True), 4: (4, 1, True), 6: (7, 2, False), 7: (7, 2, True)}


def test_state_outlives_a_restart(spark, scratch):
    own = state_session(spark)
    for part in (0, 1):
        rows = table(spark, [(10 * part + i, prose(i, 5), None, None, 0) for i in range(5 + part)])
        intake(rows).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        schema = spark.read.parquet(f"{scratch}/in").schema
        dedup_stream(own.readStream.schema(schema).parquet(f"{scratch}/in"), f"{scratch}/state", f"{scratch}/ck").awaitTermination()
    got = sorted((r["keep"]["doc_id"], r["group_size"]) for r in latest_state(spark, f"{scratch}/state").collect())
    assert got == [(10, 2), (11, 2), (12, 2), (13, 2), (14, 2), (15, 1)]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != own.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_without_copies_keeps_columns(spark):
    rows = table(spark, awkward_rows(), clashes=True)
    kept = without_copies(rows)
    assert kept.columns == rows.columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert sorted(texts) == sorted({r[1] or "" for r in awkward_rows()})

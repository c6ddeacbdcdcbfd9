import numpy as np
import pytest
from llm_cases import awkward_rows, table
from pyspark.sql import functions as F

from ledgerflow.llm import langid
from ledgerflow.llm.langid import accepted, codewords, fit, identify
from ledgerflow.llm.queries import QUERIES, held_out


@pytest.mark.parametrize("k", [2, 3, 4, 7, 8, 20])
def test_codewords_are_apart(k):
    code = codewords(k)
    apart = [(code[i] != code[j]).sum() for i in range(k) for j in range(i)]
    assert min(apart) >= max(1, code.shape[1] // 4)
    assert all(abs(code[:, b].sum()) < k for b in range(code.shape[1]))


def test_held_out_accuracy_and_inputs(spark):
    rows = QUERIES["op1_language_id"](spark, "/root/testdata/sf0.01").alias("p")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = rows.join(docs, "doc_id").collect()
    assert len(got) == docs.count()
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_labels_of_held_out_rows_and_other_columns_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    other = docs.withColumn("lang", F.when(held_out(), "zz").otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    a, b = (sorted(identify(x, fit(x, ~held_out())).collect(), key=lambda r: r["doc_id"]) for x in (docs, other))
    assert a == b


def test_few_tasks_read_the_written_sample_only(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    count, files = langid._ngram_counts, []
    monkeypatch.setattr(langid, "_ngram_counts", lambda rows, *a: files.extend(rows.inputFiles()) or count(rows, *a))
    fit(docs, ~held_out())
    assert files and all("/langid-sample" in f for f in files)


def test_awkward_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = fit(docs, ~held_out(), per_language=50)
    rows = table(spark, awkward_rows(), clashes=True)
    got = identify(rows, model).collect()
    assert len(got) == len(awkward_rows())
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    for i in (3, 4, 5, 12):
        assert (by[i]["lang_pred"], by[i]["score"], by[i]["ambiguous"]) == ("und", 0.0, False)
    assert by[14]["lang_pred"] != "und" and by[11]["lang_pred"] != "und"
    kept = accepted(rows, model)
    assert kept.columns == rows.columns and {3, 4, 5, 12}.isdisjoint(r["doc_id"] for r in kept.collect())


def test_few_or_no_languages(spark):
    rows = table(spark, awkward_rows())
    none = identify(rows, fit(rows.withColumn("lang", F.lit(None).cast("string")), F.lit(True)))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}
    one = identify(rows, fit(rows.withColumn("lang", F.lit("en")), F.lit(True)))
    assert {r["lang_pred"] for r in one.collect()} == {"und", "en"}
    assert identify(rows.limit(0), fit(rows.limit(0), F.lit(True))).count() == 0

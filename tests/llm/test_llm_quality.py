from fractions import Fraction
from math import comb

import pytest
from llm_cases import WORD, awkward_rows, prose, table
from pyspark.sql import functions as F

from ledgerflow.llm.quality import apply_cutoffs, binomial_tail, calibrate, judge, measures
from ledgerflow.llm.queries import QUERIES


def _measure(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    grams = list(zip(words, words[1:], words[2:]))
    often = {g for g in grams if grams.count(g) > 1} if len(grams) < 3000 else {g for g in set(grams) if grams.count(g) > 1}
    covered = {j for i, g in enumerate(grams) if g in often for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_measures_against_brute_force(spark):
    rows = awkward_rows() + [(100 + i, "\n".join(["a # b*$", prose(i % 3, 20), "a # b*$", " "] * 3), "en", "s", 0) for i in range(6)]
    rows += [(r["doc_id"] + 1000, r["text"], "en", "s", 0) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = sorted((str(r["doc_id"]), tuple(r[c] for c in COLUMNS)) for r in measures(table(spark, rows).select("doc_id", "text")).collect())
    assert got == sorted((str(r[0]), _measure(r[1])) for r in rows)


@pytest.mark.parametrize("n,k,p", [(10, 0, 0.1), (10, 3, 0.1), (200, 1, 0.02), (500, 0, 0.01), (2000, 30, 0.02), (5000, 60, 0.004), (50, 50, 0.5), (2850, 150, 0.004), (2850, 90, 0.004), (3000, 300, 0.02)])
def test_binomial_tail_is_exact(spark, n, k, p):
    q = Fraction(p)
    want = float(sum(comb(n, i) * q ** i * (1 - q) ** (n - i) for i in range(k + 1)))
    got = spark.range(1).select(binomial_tail(F.lit(k), F.lit(n), p)).first()[0]
    assert got == pytest.approx(want, rel=1e-8)


def _labelled(n, strata=("en", None)):
    docs, labels = [], []
    for s, lang in enumerate(strata):
        for i in range(n):
            bad = i % 4 == 0
            words = prose(1000 * s + i, 60).split()
            docs.append((10_000 * s + i, " ".join(w + "#$" if bad else w for w in words), lang, "s", 0))
            labels.append((10_000 * s + i, 0 if bad else 1, 0))
    return docs, labels


def test_cutoffs_reject_bad_rows_per_stratum(spark):
    docs, labels = _labelled(2000)
    labels_df = spark.createDataFrame(labels + labels[:5], "doc_id long, quality int, toxic int")
    frame = table(spark, docs, clashes=True)
    rows = judge(frame, labels_df, alpha=0.05)
    kept = {r["doc_id"]: r["kept"] for r in rows.collect()}
    assert len(kept) == len(docs) and all(kept[i] == bool(q) for i, q, _ in labels)


def test_too_few_labels_reject_nothing(spark):
    docs, labels = _labelled(40)
    rows = judge(table(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert all(r["kept"] for r in rows.collect())


def test_limit_on_false_rejection_holds(spark):
    # symbols say nothing about quality here: a cutoff may lose alpha of the good rows at most
    docs, labels = [], []
    for i in range(3000):
        docs.append((i, " ".join(w + ("#" if i % 10 == 0 else "") for w in prose(i, 60).split()), "en", "s", 0))
        labels.append((i, int(i % 20 != 0), 0))
    m = measures(table(spark, docs).select("doc_id", "text", "lang")).cache()
    cuts = calibrate(m, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), alpha=0.02, price=0.0001)
    got = apply_cutoffs(m, cuts).collect()
    good = {i for i, q, _ in labels if q}
    lost = sum(r["doc_id"] in good and not r["kept"] and not r["base_failed"] for r in got)
    assert lost <= 0.02 * len(good)
    for r in cuts.collect():
        assert r["p_value"] <= 0.05 / 5 and r["lost"] / r["good"] < 0.02 / 5
    m.unpersist()


def test_awkward_rows_and_empty_tables(spark):
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0), (6, 1, 1)], "doc_id long, quality int, toxic int")
    rows = judge(table(spark, awkward_rows(), clashes=True), labels)
    assert rows.count() == len(awkward_rows()) and all(r["kept"] != r["base_failed"] for r in rows.collect())
    assert judge(table(spark, awkward_rows()).limit(0), labels).count() == 0
    assert judge(table(spark, awkward_rows()), labels.limit(0)).where("kept = base_failed").count() == 0


def test_query_on_whole_table(spark):
    rows = QUERIES["op3_quality_rules"](spark, "/root/testdata/sf0.01")
    assert rows.count() == spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()
    assert rows.where("base_failed and kept").count() == 0


def test_plan_is_native(spark):
    m = measures(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang"))
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert plan.count("split(") <= 4, plan

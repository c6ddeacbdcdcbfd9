"""Executors need numpy, pyarrow and the tokenizer files, not this package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})  # for this process only: workers start without it
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.checkpoint.dir", {scratch!r}).getOrCreate())

def lacks(batches):
    import importlib.util
    import pyarrow as pa
    for _ in batches:
        yield pa.RecordBatch.from_pydict({{"found": [importlib.util.find_spec("ledgerflow") is not None]}})

assert [r[0] for r in spark.range(1).mapInArrow(lacks, "found boolean").collect()] == [False]
import corpus_pipeline
from ledgerflow.llm.queries import QUERIES
docs = spark.read.parquet("{sf}/documents.parquet")
for name in ("op1_language_id", "op8_main_text", "op11_byte_bpe", "op12_merkle_manifest", "op13_spelling_variants"):
    print(name, QUERIES[name](spark, "{sf}").count())
print("language_id", corpus_pipeline.language_id(spark, docs, "{sf}").count())
print("near_dedup", corpus_pipeline.near_dedup(spark, docs, "{sf}").count())
"""


def test_workers_run_without_the_package(scratch, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = SCRIPT.format(root=ROOT, scratch=scratch, sf="/root/testdata/sf0.001")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert len(done.stdout.strip().splitlines()) == 7

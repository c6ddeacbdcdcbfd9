"""Queries of the operators, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .oracles import JACCARD, MERKLE, REPEATS, REVISITS, SPELLING, WORDS, quality_sql
from .quality import CUTOFFS

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .pack import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), special_ids=True)


def held_out() -> object:
    """True for the rows that no classifier may learn from."""
    from pyspark.sql import functions as F

    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import fit, identify

    docs = _table(spark, sf_dir, "documents")
    found = identify(docs, fit(docs, ~held_out()))
    return found.withColumn("held_out", held_out())


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .dedup import exact_dedup

    rows = exact_dedup(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", rows["digest"].alias("text_sha256"))


ORACLE["op4_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .quality import judge

    rows = judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


ORACLE["op3_quality_rules"] = quality_sql(CUTOFFS)


@query
def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import round_trip

    return round_trip(_table(spark, sf_dir, "pages"), min_bytes=0).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op6_warc_revisits"] = REVISITS


@query
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mainext import extract

    return extract(_table(spark, sf_dir, "pages"))


@query
def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import ngram_components

    return ngram_components(_table(spark, sf_dir, "documents"), k=3, num=90, den=100)


ORACLE["op5_ngram_jaccard"] = JACCARD


@query
def op10_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repeats import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents"), length=50)


ORACLE["op10_repeated_spans"] = REPEATS


@query
def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan_licenses

    return scan_licenses(_table(spark, sf_dir, "documents"))


#: Weights of the mix that op7 and the pipeline's mixing stage use.
DOMAIN_WEIGHTS = {"web": 50, "books": 30, "code": 20}
LANGUAGE_WEIGHTS = {"en": 40, "de": 20, "es": 20, "fr": 20}
MIX_WEIGHTS = {"domain": DOMAIN_WEIGHTS, "lang": LANGUAGE_WEIGHTS}


@query
def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .mixing import mix_sources, source_domain

    mixed = mix_sources(_table(spark, sf_dir, "documents"), MIX_WEIGHTS, source_domain(F.col("source")), share=0.6, epochs=2, seed=7)
    return mixed.select("r.doc_id", "domain", "r.lang", "r.source", "n_tokens", "copies")


def _weight_sql(weights: dict[str, int], name: str) -> str:
    return f"CASE {name} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 0 END"


def _fill_sql(level: str, parents: str, path: str, weight: str, above: str) -> str:
    """One level of the budget tree: capacities, water level, shares."""
    part = f"PARTITION BY {parents}" if parents else ""
    return f"""
  {level}_c AS (SELECT {path}, sum(usable) AS capacity, any_value(share) AS budget,
                       ({weight})::DOUBLE AS weight FROM {above} GROUP BY {path}),
  {level}_r AS (SELECT *, CASE WHEN weight > 0 THEN capacity / weight ELSE 'inf'::DOUBLE END AS ratio FROM {level}_c),
  {level}_l AS (SELECT *, row_number() OVER ({part} ORDER BY ratio, {path.split(',')[-1]}) AS place,
                  (budget - coalesce(sum(capacity) OVER ({part} ORDER BY ratio, {path.split(',')[-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                  / nullif(sum(weight) OVER ({part} ORDER BY ratio, {path.split(',')[-1]} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS lvl
                FROM {level}_r),
  {level}_w AS (SELECT *, arg_min(lvl, CASE WHEN lvl <= ratio THEN place END) OVER ({part}) AS water FROM {level}_l),
  {level} AS (SELECT t.* EXCLUDE (share), CASE WHEN weight <= 0 THEN 0 WHEN water IS NULL THEN capacity ELSE least(capacity, weight * water) END AS share
              FROM {above} t JOIN {level}_w w USING ({path}))"""


ORACLE["op7_source_mixing"] = f"""
WITH rows_ AS (
    SELECT doc_id, lang, source, len({WORDS}) AS n_tokens, coalesce(lang, '') AS l, coalesce(source, '') AS s,
           CASE regexp_extract(coalesce(source, ''), '(\\d+)', 1) WHEN '' THEN 'web' ELSE
             ['web', 'books', 'code'][right(regexp_extract(coalesce(source, ''), '(\\d+)', 1), 9)::INT % 3 + 1] END AS d FROM documents),
  top AS (SELECT d, l, s, sum(n_tokens)::BIGINT AS supply, floor(sum(sum(n_tokens)) OVER () * 0.6)::DOUBLE AS share,
                 CASE WHEN least({_weight_sql(DOMAIN_WEIGHTS, 'd')}, {_weight_sql(LANGUAGE_WEIGHTS, 'l')}) > 0
                      THEN sum(n_tokens) * 2 ELSE 0 END AS usable FROM rows_ GROUP BY d, l, s),
  {_fill_sql('lv1', '', 'd', _weight_sql(DOMAIN_WEIGHTS, 'd'), 'top')},
  {_fill_sql('lv2', 'd', 'd, l', _weight_sql(LANGUAGE_WEIGHTS, 'l'), 'lv1')},
  {_fill_sql('lv3', 'd, l', 'd, l, s', '1', 'lv2')},
  spend AS (SELECT *, floor(share + 1e-6)::BIGINT AS tokens FROM lv3),
  cut AS (SELECT d, l, s, CASE WHEN supply > 0 THEN tokens // supply ELSE 0 END AS whole,
                 tokens - CASE WHEN supply > 0 THEN tokens // supply ELSE 0 END * supply AS rest FROM spend),
  placed AS (SELECT r.*, whole, rest, sum(n_tokens) OVER (PARTITION BY d, l, s ORDER BY
               ('0x' || substr(md5('7:' || whole || ':' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT, doc_id, n_tokens) AS upto
             FROM rows_ r JOIN cut USING (d, l, s))
SELECT doc_id, d AS domain, lang, source, n_tokens::BIGINT AS n_tokens,
       whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS copies FROM placed
"""


@query
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from pyspark.sql import functions as F

    from .bpe import decode_documents, encode_documents

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = decode_documents(encode_documents(_table(spark, sf_dir, "documents"), path), path)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("data", 256).alias("decoded_sha256"))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .merkle import fold, leaf_digest, manifest, proof_digest

    docs = _table(spark, sf_dir, "documents")
    fields, text = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], F.col("text")
    tampered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaves = docs.select("doc_id", "lang", leaf_digest(*fields, text).alias("leaf"),
                         F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, leaf_digest(*fields, tampered)).alias("changed"))
    rows = manifest(leaves, "lang", "doc_id", "leaf", keep=("changed",))
    rows = rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                       fold(F.coalesce("changed", "leaf"), F.col("proof")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


ORACLE["op12_merkle_manifest"] = MERKLE


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spelling import spelling_forms

    return spelling_forms(_table(spark, sf_dir, "documents"))


ORACLE["op13_spelling_variants"] = SPELLING

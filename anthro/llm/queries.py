"""Registered queries of this subpackage: thin, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from anthro.llm import (bloom_lm, common, decontam, divergence, jaccard, langid, licenses, line_rules, mincut_html, oracle, packing, pii, simhash, spelling,
                        toxicity)
from anthro.llm.common import hash_share, small_batches


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return common.read_table(spark, sf_dir, name)


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    share = hash_share(F.col("doc_id"), 7)
    return bloom_lm.train_and_score(docs, share != 2, share == 2)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read_table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return mincut_html.extract(pages, mincut_html.train(pages)).withColumn("n_chars", F.length("text").cast("long"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


PII_KEY = "surrogates of this corpus"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read_table(spark, sf_dir, "documents"))


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.anonymise(read_table(spark, sf_dir, "documents"), PII_KEY).select("doc_id", "text", "n_private")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.train(docs.where(hash_share(F.col("doc_id"), 5) != 0))
    out = langid.identify(docs, model)
    return out.select("doc_id", F.coalesce(hash_share(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_report(read_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, read_table(spark, sf_dir, "labels")))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.verdicts(read_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"), noise_modulus=97)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_pii_surrogates": op2_pii_surrogates,
    "op3_language_id": op3_language_id,
    "op4_fingerprints": op4_fingerprints,
    "op5_toxicity": op5_toxicity,
    "op6_packing": op6_packing,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_html_extraction": op9_html_extraction,
    "op10_decontamination": op10_decontamination,
    "op11_source_divergence": op11_source_divergence,
    "op12_quality_rules": op12_quality_rules,
    "op13_spelling_variants": op13_spelling_variants,
    "pipeline": corpus_pipeline.run,
}

#: Models, hashes, tokenisers and groups by reachability have no SQL form; tests/llm holds those queries against brute force.
ORACLE_SQL: dict[str, str] = {
    "op11_source_divergence": oracle.OP11_SOURCE_DIVERGENCE,
    "op12_quality_rules": oracle.OP12_QUALITY_RULES,
    "op13_spelling_variants": oracle.OP13_SPELLING_VARIANTS,
}

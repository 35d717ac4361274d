"""Training-data pipeline: clean, deduplicated, decontaminated, anonymised documents, packed into sequences.

Each stage takes all that its predecessor kept and returns the columns of
``documents``; the last returns packed pieces.  ``run`` chains them, with every
stage's result written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anthro.llm import decontam, jaccard, packing, pii, toxicity
from anthro.llm.common import read_table, small_batches, stage

PII_KEY = "surrogates of this corpus"
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is likelier toxic than not go; the model learns from the corpus's labels."""
    small_batches(spark)
    model = toxicity.learn(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by five-word shingle similarity of 0.8 or more, the least id stays.

    Documents without words are in no group and stay.
    """
    small_batches(spark)
    return jaccard.keep_one(docs, shingle=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more are words of benchmark windows go."""
    small_batches(spark)
    return decontam.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes surrogates; ``n_chars`` follows the new text."""
    small_batches(spark)
    out = pii.anonymise(docs.select(*COLUMNS), PII_KEY)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 2048-token sequences."""
    small_batches(spark)
    pieces = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("pii_surrogates", replace_private),
    ("packing", pack),
]

#: Trained models and dynamic programming have no SQL form; tests/llm/test_corpus_pipeline.py holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

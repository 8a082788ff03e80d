"""The corpus pipeline: documents in, token ids of clean and distinct documents out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rollcall.llm import bpe, decontaminate, exact, simhash, toxicity
from rollcall.llm.common import materialise, table
from rollcall.llm.sampling import in_fold

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that score 0.5 or more; learns from the labels outside fold 0 of 5."""
    return toxicity.drop_toxic(docs, docs, table(spark, sf_dir, "labels").where(~in_fold("doc_id", 5, 0)))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of equal texts."""
    return exact.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that fingerprints link."""
    return simhash.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which one word in twenty or more is a benchmark's."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds n_tokens, ids (little-endian unsigned 32-bit integers) and the hash of the text decoded from them."""
    return bpe.encode_documents(docs, TOKENIZER, outputs=("n_tokens", "ids", "decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("bpe", encode),
]

#: Neither the classifier nor XXH64 fingerprints can be put in SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
